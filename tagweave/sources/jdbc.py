"""JDBC sink for the wide table (e.g. an analytical database ordered by uid)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

# Writer settings of the export: rows per batch insert, no transaction
# around a partition's batches, and at most this many concurrent writers.
JDBC_BATCH_SIZE = 1000
JDBC_ISOLATION_LEVEL = "NONE"
JDBC_NUM_PARTITIONS = 4
# What a target that needs an engine and an order gets by default.
MERGE_TREE_BY_UID = "ENGINE = MergeTree() ORDER BY uid"


def jdbc_options(
    url: str,
    table: str,
    driver: str | None = None,
    batch_size: int = JDBC_BATCH_SIZE,
    isolation_level: str = JDBC_ISOLATION_LEVEL,
    num_partitions: int = JDBC_NUM_PARTITIONS,
    create_table_options: str | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    opts = {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_size),
        "isolationLevel": isolation_level,
        "numPartitions": str(num_partitions),
    }
    if driver:
        opts["driver"] = driver
    if create_table_options is None and url.startswith("jdbc:clickhouse:"):
        create_table_options = MERGE_TREE_BY_UID
    if create_table_options:
        # e.g. "ENGINE = MergeTree() ORDER BY uid" for the target's DDL
        opts["createTableOptions"] = create_table_options
    opts.update(extra or {})
    return opts


def write_jdbc(df: DataFrame, mode: str = "overwrite", **options) -> None:
    """Write ``df`` to a JDBC table.

    ``overwrite`` drops and recreates the table before the insert, so a
    rerun of the export gives the same table; ``append`` adds rows. Spark
    coalesces to ``numPartitions`` writers. Without a transaction a retried
    task may repeat its rows, as with any non-transactional JDBC append.
    """
    df.write.format("jdbc").options(**jdbc_options(**options)).mode(mode).save()
