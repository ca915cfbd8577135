"""Warehouse access: where a tag SQL resolves its unqualified table names."""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import SparkSession

# Tables of the sample warehouse shipped as one parquet file / folder each.
SAMPLE_TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def _exists(spark: SparkSession, path: str) -> bool:
    """Existence on the cluster's file system (HDFS, S3, local...)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return bool(hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath))


def register_parquet_views(
    spark: SparkSession, root: str, tables: Iterable[str] = SAMPLE_TABLES
) -> list[str]:
    """Expose ``<root>/<name>.parquet`` (or ``<root>/<name>``) as temp views.

    The views are lazy scans: column pruning and filter pushdown of each tag
    SQL reach the parquet reader. A table that is absent has no view: one left
    from another folder is dropped, so no SQL reads the wrong warehouse.
    """
    registered = []
    for name in tables:
        for path in (os.path.join(root, f"{name}.parquet"), os.path.join(root, name)):
            if _exists(spark, path):
                spark.read.parquet(path).createOrReplaceTempView(name)
                registered.append(name)
                break
        else:
            spark.catalog.dropTempView(name)
    return registered


def use_database(spark: SparkSession, database: str) -> None:
    """Resolve unqualified names in a catalog database (a Hive-style warehouse)."""
    spark.catalog.setCurrentDatabase(database)
