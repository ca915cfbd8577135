"""Contiguous shards of near equal bytes from global prefix sums. DataFrame only.

Rows are put in one global order, by a hash of the text and then by a hash of
the id, so equal texts stand together. The order is cut into cells that are
contiguous in it: a range of text hashes, or, for a text whose copies hold more
than a hundredth of a shard's bytes, a range of id hashes among its copies.
There are at most ``BUCKETS + HOT_PARTS * 100 * n_shards`` cells, whatever the
input, so the prefix sum over cell totals is small; within a cell a window
adds up the rows. Cuts are at equal byte targets. Copies of a text that is no
hot group stay in one shard; a hot group is cut where the target is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagweave.llm.common import written

N_SHARDS = 40
#: Bytes counted for each row on top of its text.
ROW_BYTES = 16
BUCKET_BITS = 12
HOT_PART_BITS = 5


def shard_by_bytes(docs: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row.

    size: UTF-8 bytes of the text plus 16; null text counts as empty. slot: the
    row's place in its shard, from 0 without gaps. law is ``bytes``;
    grown_shard is null, as adding a shard moves the cuts. Fewer bytes than
    shards leave shards empty. Only doc_id and text are read; repeated rows
    are all placed; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = written(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("h"),
            F.xxhash64(F.col("doc_id")).alias("u"),
        ),
        "shard-rows",
    )
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("total"))
    # A hot text holds more than 1 / (100 n_shards) of all bytes: there are fewer than 100 n_shards.
    hot = (
        rows.groupBy("h").agg(F.sum("size").alias("bytes"))
        .join(F.broadcast(total), F.col("bytes") * 100 * n_shards > F.col("total"))
        .select("h", F.lit(True).alias("hot"))
    )
    is_hot = F.coalesce("hot", F.lit(False))
    rows = rows.join(F.broadcast(hot), "h", "left").select(
        "doc_id", "size", "text_crc32", "h", "u",
        is_hot.alias("hot"),
        F.shiftrightunsigned("h", 64 - BUCKET_BITS).alias("bucket"),
        F.when(is_hot, F.col("h")).otherwise(0).alias("hot_h"),
        F.when(is_hot, F.shiftrightunsigned("u", 64 - HOT_PART_BITS)).otherwise(0).alias("part"),
    )
    cell = ["bucket", "hot", "hot_h", "part"]
    before = Window.orderBy(*cell).rowsBetween(Window.unboundedPreceding, -1)
    cells = (
        rows.groupBy(*cell).agg(F.sum("size").alias("b"), F.count("*").alias("k"))
        .select(
            *cell,
            F.coalesce(F.sum("b").over(before), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("k").over(before), F.lit(0)).alias("rows_before"),
        )
    )
    own = Window.partitionBy(*cell).orderBy("h", "u", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    copies = Window.partitionBy(*cell, "h")
    placed = (
        rows.withColumn("start", F.sum("size").over(own) - F.col("size"))
        .withColumn("rank", F.count(F.lit(1)).over(own) - 1)
        .withColumn("group_start", F.min("start").over(copies))
        .withColumn("group_bytes", F.sum("size").over(copies))
        .join(F.broadcast(cells), cell)
        .join(F.broadcast(total))
        .withColumn("first", F.when(F.col("hot"), F.col("start")).otherwise(F.col("group_start")))
        .withColumn("long", F.when(F.col("hot"), F.col("size")).otherwise(F.col("group_bytes")))
        .select(
            "doc_id", "size", "text_crc32",
            F.expr(f"cast((2 * (bytes_before + first) + long) * {n_shards} div (2 * total) as int)").alias("shard"),
            (F.col("rows_before") + F.col("rank")).alias("rank"),
        )
    )
    placed = written(placed, "shard-placed")
    begins = placed.groupBy("shard").agg(F.min("rank").alias("begin"))
    return placed.join(F.broadcast(begins), "shard").select(
        "doc_id", "size", "text_crc32",
        F.lit("bytes").alias("law"), "shard", (F.col("rank") - F.col("begin")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
