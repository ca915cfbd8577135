"""Importance resampling towards a target set by hashed word n-gram features.

Texts are cut into lines at line feeds, which no word crosses. A line that many
documents share (a licence, a menu) is read once: distinct lines' feature buckets are
computed and stored once and count as often as the line occurs; the few n-grams that
run over a line's end are taken per document and added separately.

1. Every document gives its lines as 128-bit digests and the buckets of its
   cross-line n-grams; its row number is stored with them.
2. Distinct lines (aggregated before the shuffle) give their buckets.
3. Bucket counts of both tables give a gain per bucket: one row a bucket.
4. A distinct line's gains are summed once; documents fetch the sums of their lines.
   A line with more than 1/``HOT_SHARE`` of all occurrences is in a broadcast table,
   which so holds at most ``HOT_SHARE`` rows; the others meet in a shuffled join.
5. Scores are integers, so the lowest drawn one comes from a histogram; drawn rows are
   range partitioned by (score, doc_id), and their ranks are prefix sums over partitions.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagweave.llm.common import written

BUCKETS = 10_000
#: Words an n-gram has at most.
MAX_WORDS = 2
MIN_WORDS = 20
SHARE_PERCENT = 25
SEED = 7
#: A line is hot beyond this part of all line occurrences.
HOT_SHARE = 10_000
#: Lines or documents are handled in blocks of about this many bytes.
BLOCK = 1 << 20
_ROW_BITS = 33  # of monotonically_increasing_id: the row's number in its partition

# A-Z to a-z; letters, digits and bytes from 0x80 on stay; all other bytes but the line feed become spaces.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b == 0x0A else 0x20 for b in range(256)
)
_EDGE = re.compile(rb"[^ \n]+")


def ngram_buckets(words: list[bytes], buckets: int) -> np.ndarray:
    """Buckets of all runs of one and two words (joined by a space), crc32 modulo ``buckets``."""
    one = list(map(zlib.crc32, words))
    two = map(zlib.crc32, [b" " + w for w in words[1:]], one)  # crc32 goes on from the first word's
    return (np.fromiter((*one, *two), np.uint32, max(0, 2 * len(words) - 1)) % buckets).astype(np.int32)


def cross_buckets(text: bytes, buckets: int) -> np.ndarray:
    """Buckets of the two-word runs over line ends (lines without words are skipped)."""
    lines = [x for x in text.translate(_FOLD).split(b"\n") if _EDGE.search(x)]
    pairs = [a.rsplit(None, 1)[-1] + b" " + _EDGE.search(b).group() for a, b in zip(lines, lines[1:], strict=False)]
    return (np.fromiter(map(zlib.crc32, pairs), np.uint32, len(pairs)) % buckets).astype(np.int32)


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows) if rows else np.empty(0, np.int32)))


def _blocks(batch: pa.RecordBatch, column: str):
    """Slices of about ``BLOCK`` characters."""
    sizes = np.array([len(t or "") for t in batch.column(column).to_pylist()], dtype=np.int64)
    ends = np.cumsum(sizes)
    a = 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] - sizes[a] + BLOCK, side="right")))
        yield batch.slice(a, b - a)
        a = b


def _append(column: str, name: str, features):
    """Replace the text ``column`` by the list ``name`` of what ``features`` finds in it."""

    def run(batches):
        for batch in batches:
            for part in _blocks(batch, column):
                found = _lists([features((t or "").encode()) for t in part.column(column).to_pylist()])
                kept = [n for n in part.schema.names if n != column]
                yield pa.RecordBatch.from_arrays([*[part.column(n) for n in kept], found], names=[*kept, name])

    return run


def _digests(line: Column) -> Column:
    """128 bits that stand for a line."""
    return F.struct(F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(SEED), line).alias("h2"))


_DOCS = "row long, doc_id long, lines array<struct<h1:bigint,h2:bigint>>, cross array<int>"
_LINES = "h1 long, h2 long, k long, buckets array<int>"


def _cut_lines(docs: DataFrame, buckets: int, label: str) -> tuple[DataFrame, DataFrame]:
    """(documents with line digests and cross-line buckets, distinct lines with occurrences and buckets), both written."""
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    numbered = kept.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "text",
        F.transform(F.split("text", "\n"), _digests).alias("lines"),
    ).select("row", "doc_id", "lines", "text")
    by_doc = written(numbered.mapInArrow(_append("text", "cross", lambda t: cross_buckets(t, buckets)), _DOCS), f"{label}-documents")
    lines = kept.select(F.explode(F.split("text", "\n")).alias("line")).where("line <> ''").groupBy("line").agg(F.count("*").alias("k"))
    digested = lines.select(_digests(F.col("line")).alias("d"), "k", "line").select("d.h1", "d.h2", "k", "line")
    words = _append("line", "buckets", lambda t: ngram_buckets(t.translate(_FOLD).split(), buckets))
    return by_doc, written(digested.mapInArrow(words, _LINES), f"{label}-lines")


def _histogram(column: str, weight: str | None, buckets: int):
    """(bucket, n) of a task's rows, each list counted ``weight`` times; ``buckets`` rows at most."""

    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            lists = batch.column(column)
            values = lists.flatten().to_numpy()
            if weight is None:
                total += np.bincount(values, minlength=buckets)
            else:
                times = np.repeat(batch.column(weight).to_numpy(), lists.value_lengths().to_numpy())
                np.add.at(total, values, times)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    return run


def bucket_counts(by_doc: DataFrame, lines: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n) over all features of a table: distinct lines times occurrences, and cross-line ones."""
    inside = lines.select("buckets", "k").mapInArrow(_histogram("buckets", "k", buckets), "bucket int, n long")
    across = by_doc.select("cross").mapInArrow(_histogram("cross", None, buckets), "bucket int, n long")
    return inside.unionByName(across).groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """floor(1000 * log importance) of every bucket: one row a bucket comes to the driver."""
    spark = source.sparkSession
    one = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = (
        one.join(source.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left")
        .select("bucket", F.coalesce("s", F.lit(0)).cast("double").alias("s"), F.coalesce("t", F.lit(0)).cast("double").alias("t"))
    )
    sums = written(both, "resample-counts")
    total = sums.agg(F.sum("s").alias("s_all"), F.sum("t").alias("t_all"))  # one row
    ratio = (F.col("t") + 1) * (F.col("s_all") + buckets) / ((F.col("s") + 1) * (F.col("t_all") + buckets))
    rows = sums.crossJoin(F.broadcast(total)).select("bucket", F.floor(1000 * F.log(ratio)).alias("gain")).collect()
    gains = np.zeros(buckets, dtype=np.int64)
    for r in rows:
        gains[r["bucket"]] = r["gain"]
    return gains


def _sums(column: str, gains):
    """Replace a list of buckets by how many it holds and their gains' sum."""

    def run(batches):
        table = gains.value
        for batch in batches:
            lists = batch.column(column)
            n = lists.value_lengths().to_numpy().astype(np.int64)
            before = np.concatenate([[0], np.cumsum(table[lists.flatten().to_numpy()])])
            ends = np.cumsum(n)
            kept = [c for c in batch.schema.names if c != column]
            columns = [*[batch.column(c) for c in kept], pa.array(n), pa.array(before[ends] - before[ends - n])]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "n", "gain"])

    return run


def _document_sums(by_doc: DataFrame, lines: DataFrame, gains: np.ndarray) -> DataFrame:
    """row, doc_id, n_features and the sum of gains of every document."""
    shared = by_doc.sparkSession.sparkContext.broadcast(gains)
    per_line = written(lines.mapInArrow(_sums("buckets", shared), "h1 long, h2 long, k long, n long, gain long").where("n > 0"), "resample-sums")
    said = by_doc.select("row", F.explode("lines").alias("d")).select("row", "d.h1", "d.h2")
    limit = per_line.agg(F.sum("k").alias("k")).first()["k"] or 0
    hot = F.col("k") > limit // HOT_SHARE
    # At most HOT_SHARE lines can each have more than that part of all occurrences.
    often = F.broadcast(per_line.where(hot).select("h1", "h2", "n", "gain"))
    seldom = per_line.where(~hot).select("h1", "h2", "n", "gain")
    marked = said.join(often, ["h1", "h2"], "left")
    known = marked.where("n is not null").select("row", "n", "gain")
    looked_up = marked.where("n is null").select("row", "h1", "h2").join(seldom, ["h1", "h2"]).select("row", "n", "gain")
    none = F.lit(None).cast("long").alias("doc_id")
    across = by_doc.select("row", "doc_id", "cross").mapInArrow(_sums("cross", shared), "row long, doc_id long, n long, gain long")
    parts = across.unionByName(known.unionByName(looked_up).select("row", none, "n", "gain"))
    return parts.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.sum("n").alias("n_features"), F.sum("gain").alias("gain"))


def _ranks(scored: DataFrame, percent: int, min_words: int) -> DataFrame:
    """(row, rank) of the drawn rows."""
    spark = scored.sparkSession
    able = scored.where(f"n_features >= {MAX_WORDS * min_words - 1}")  # n words have 2n - 1 features
    by_score = written(able.groupBy("score").agg(F.count("*").alias("k")), "resample-scores")  # integers in a narrow range
    drawn = (by_score.agg(F.sum("k").alias("k")).first()["k"] or 0) * percent // 100
    down = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)  # a row a score
    lowest = by_score.withColumn("above", F.coalesce(F.sum("k").over(down), F.lit(0))).where(F.col("above") < drawn).agg(F.min("score")).first()[0]
    order = [F.desc("score"), F.asc("doc_id"), F.asc("row")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = written(
        able.where(F.col("score") >= F.lit(lowest)).select("row", "doc_id", "score")
        .repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()),
        "resample-drawn",
    ).withColumn("_part", F.shiftright("_at", _ROW_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    runs = placed.groupBy("_part").agg(F.count("*").alias("_k")).select("_part", F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_base"))
    rank = F.col("_base") + F.col("_at") - F.shiftleft("_part", _ROW_BITS) + 1
    return placed.join(F.broadcast(runs), "_part").select("row", rank.alias("rank")).where(F.col("rank") <= drawn)


def resample(
    docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, percent: int = SHARE_PERCENT, min_words: int = MIN_WORDS, seed: int = SEED
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of ``docs``.

    Features are all runs of one and two words of the whole text, repeats counted; ``weight`` is the floored
    mean of their buckets' gains towards ``target`` (its column text), ``score`` adds Gumbel noise
    drawn from the doc_id. Of the N rows with at least ``min_words`` words the
    floor(percent * N / 100) highest scores get ranks 1, 2, 3..., ties to the smaller doc_id; all others' rank is
    null. Null or wordless texts have no features and weight 0. Every row is a document, repeated ids
    included (equal ones are ranked in an unspecified order); a row without doc_id has the noise of an empty id. Columns
    other than doc_id and text are not read. An empty table gives no rows; an empty target is one without counts.
    """
    by_doc, lines = _cut_lines(docs, buckets, "resample")
    wanted = target.select(F.lit(0).alias("doc_id"), "text")
    aims = bucket_counts(*_cut_lines(wanted, buckets, "resample-target"), buckets)
    gains = bucket_gains(bucket_counts(by_doc, lines, buckets), aims, buckets)
    sums = _document_sums(by_doc, lines, gains)
    # Integer division that goes down.
    weight = F.when(F.col("n_features") > 0, F.expr("(gain - pmod(gain, n_features)) div n_features")).otherwise(0)
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    uniform = (F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    noise = F.floor(-1000 * F.log(-F.log(uniform)))
    scored = written(
        sums.withColumn("weight", weight.cast("long")).select("row", "doc_id", "n_features", "weight", (F.col("weight") + noise).alias("score")),
        "resample-scored",
    )
    return scored.join(_ranks(scored, percent, min_words), "row", "left").select("doc_id", "n_features", "weight", "score", "rank")
