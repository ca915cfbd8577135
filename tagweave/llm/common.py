"""Reading, writing and joining helpers of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.session import scratch_dir
from tagweave.sources.manifest import filesystem

#: Removes the shuffle files of a query when it ends; else they stay until the driver happens to collect garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: A side is broadcast only if a count shows at most this many narrow rows.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str, settings: dict[str, str] | None = None) -> DataFrame:
    """Write below the shared checkpoint folder and read back: cuts the lineage,
    and a lost executor costs no recomputation. The shuffle files of the write go when it ends.
    ``settings`` of the session hold for the write alone."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    settings = (settings or {}) | {CLEANUP: "true"}
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        df.write.parquet(path)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    return spark.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete tables that :func:`written` made; no frame still to be computed may read them."""
    for frame in frames:
        jvm = frame.sparkSession.sparkContext._jvm
        folders = {jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)).getParent().toString() for f in frame.inputFiles()}
        for folder in folders:
            fs, path = filesystem(frame.sparkSession, folder)
            fs.delete(path, True)


def semi_join(big: DataFrame, keys: DataFrame, on: str, how: str = "left_semi") -> DataFrame:
    """Rows of ``big`` whose ``on`` is in ``keys``, or with ``how="left_anti"`` is not.

    ``keys`` is a written, narrow table of distinct keys, counted first: few
    enough and they are broadcast, so ``big`` is not shuffled; beyond that
    Spark's shuffled join takes over.
    """
    keys = keys.select(on)
    if keys.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    return big.join(keys, on, how).select(big.columns)


def keyed(docs: DataFrame, label: str) -> tuple[DataFrame, DataFrame | None]:
    """(doc_id, text) with a doc_id of its own for every row, and the table (key, id) back to the given ids.

    Unique ids stay as they are and need no table. Where an id is repeated or null (one
    count of the ids shows it), rows are numbered by (doc_id, text's hash), null ids last, so
    the numbers order rows as the ids do. Numbers come from a range partitioning.
    """
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if text.groupBy("doc_id").agg(F.count("*").alias("k")).where("k > 1 or doc_id is null").isEmpty():
        return text, None
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.asc_nulls_last("doc_id"), F.asc("_hash")]
    # The number of a row in its partition is below 2^33; partitions are in order.
    rows = text.withColumn("_hash", F.xxhash64("text")).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    rows = written(rows.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").alias("id"), "text"), f"{label}-keyed")
    return rows.select(F.col("key").alias("doc_id"), "text"), rows.select("key", "id")


def given_ids(found: DataFrame, ids: DataFrame | None, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``found`` with the keys of :func:`keyed` in ``columns`` replaced by the ids given."""
    if ids is None:
        return found
    for c in columns:
        back = ids.select(F.col("key").alias(c), F.col("id").alias("_id"))
        found = found.join(back, c, "left").select(*[F.col("_id").alias(c) if x == c else F.col(x) for x in found.columns])
    return found
