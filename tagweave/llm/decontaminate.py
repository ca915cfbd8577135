"""Benchmark decontamination by spaced-seed hashing. DataFrame only.

A spaced seed is a fixed mask over consecutive tokens; tokens under a 0 are
ignored, so a substitution there does not hide a hit. The seeds of the
benchmark are joined with the seeds of the documents; each hit names an
alignment of an item with a document, and the alignment is verified token by
token: some window of ``WINDOW`` aligned tokens must agree in ``MIN_SAME``.
The three masks are chosen so that any window with up to two substitutions
holds a hit (checked in the tests), so the seeds lose nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.llm.chunk_dedup import UNSPACED
from tagweave.llm.common import BROADCAST_ROWS, semi_join, written

#: Tokens under a 1 are hashed.
MASKS = ("101001111", "1100110101", "111110001")
WINDOW = 12
MIN_SAME = 10
#: Items with fewer tokens are no evidence; those between this and WINDOW must occur whole.
MIN_ITEM = 6
_UNSPACED = "[" + "".join(f"\\x{{{lo:X}}}-\\x{{{hi:X}}}" for lo, hi in UNSPACED) + "]"
#: What separates tokens: anything but letters and digits; a code point of a script without spaces is a token of its own.
SEPARATOR = f"[^\\p{{L}}\\p{{N}}]+|(?={_UNSPACED})|(?<={_UNSPACED})"


def token_hashes(text: Column) -> Column:
    """Hashes of the lower-cased letter and digit runs of a text (null: none), those of scripts without spaces by code point."""
    tokens = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATOR), "")
    return F.transform(tokens, lambda x: F.xxhash64(x))


def _seed(number: int, mask: str) -> Column:
    """Seed of one mask at a place whose tokens are z.s0, z.s1, ...; null if the mask reaches past the end."""
    tokens = [F.col(f"z.s{j}") for j, on in enumerate(mask) if on == "1"]
    return F.when(F.col(f"z.s{len(mask) - 1}").isNotNull(), F.xxhash64(F.lit(number), *tokens))


def _places(df: DataFrame, key: str, masks: list[str], place: str) -> DataFrame:
    """(key, place, seed) for every seed of the token hashes ``w``.

    A place's tokens come from shifted copies of ``w`` zipped together, so the
    seeds are hashed in generated code.
    """
    shifted = [F.slice("w", j + 1, F.size("w")).alias(f"s{j}") for j in range(max(map(len, masks)))]
    places = df.select(key, F.posexplode(F.arrays_zip(*shifted)).alias(place, "z"))
    seeds = F.explode(F.array(*[_seed(m, mask) for m, mask in enumerate(masks)])).alias("seed")
    return places.select(key, place, seeds).where("seed is not null")


def find_overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, shift, same) for every verified alignment.

    shift: document token minus item token; same: agreeing tokens in the best
    window. Equal item texts are one item, the smallest id. Items of under
    ``MIN_ITEM`` tokens match nothing; items shorter than ``WINDOW`` match only
    as a whole, without substitutions. Null or empty texts match nothing; only
    doc_id, item_id and text are read.
    """
    items = benchmark.select("item_id", token_hashes(F.col("text")).alias("w")).where(F.size("w") >= MIN_ITEM)
    items = written(items.groupBy("w").agg(F.min("item_id").alias("item_id")).select("item_id", "w"), "decon-items")
    lengths = [r["k"] for r in items.select(F.size("w").alias("k")).where(F.col("k") < WINDOW).distinct().collect()]
    masks = [*MASKS, *("1" * k for k in sorted(lengths))]
    # An item shorter than the window has one mask of its own length beside the others.
    item_seeds = written(_places(items, "item_id", masks, "item_at"), "decon-seeds")
    seeds = F.broadcast(item_seeds) if item_seeds.count() <= BROADCAST_ROWS else item_seeds
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    hits = _places(text.select("doc_id", token_hashes(F.col("text")).alias("w")), "doc_id", masks, "doc_at").join(seeds, "seed")
    alignments = written(
        hits.select("doc_id", "item_id", (F.col("doc_at") - F.col("item_at")).alias("shift")).distinct(), "decon-hits"
    )
    hit_docs = written(alignments.select("doc_id").distinct(), "decon-docs")
    full = semi_join(text, hit_docs, "doc_id").select("doc_id", token_hashes(F.col("text")).alias("w"))
    item_words = items.select("item_id", F.col("w").alias("item_w"))
    lo, hi = "greatest(0, -shift)", "least(size(item_w), size(w) - shift)"
    window = f"least({WINDOW}, size(item_w))"
    same = (
        full.join(alignments, "doc_id").join(item_words, "item_id")
        .withColumn("eq", F.expr(
            f"if({hi} > {lo}, transform(sequence({lo}, {hi} - 1), p -> cast(item_w[p] = w[p + shift] as int)), cast(array() as array<int>))"
        ))
        .withColumn("same", F.expr(
            f"if(size(eq) < {window}, 0, array_max(transform(sequence(1, size(eq) - {window} + 1),"
            f" s -> aggregate(slice(eq, s, {window}), 0, (a, x) -> a + x))))"
        ))
    )
    need = F.expr(f"if(size(item_w) < {WINDOW}, size(item_w), {MIN_SAME})")
    return same.where(F.col("same") >= need).select("doc_id", "item_id", "shift", "same")


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, shift, same): one row per contaminated document and item, its best alignment."""
    best = F.max(F.struct("same", (-F.col("shift")).alias("back"))).alias("b")  # ties: the smallest shift
    return find_overlaps(docs, benchmark).groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", (-F.col("b.back")).alias("shift"), F.col("b.same").alias("same")
    )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, contaminated, n_items, item_id (smallest), best_same."""
    found = find_overlaps(docs, benchmark).groupBy("doc_id").agg(
        F.countDistinct("item_id").alias("n_items"), F.min("item_id").alias("item_id"), F.max("same").alias("best_same")
    )
    return docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(found, "doc_id", "left").select(
        "doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        "item_id", F.coalesce("best_same", F.lit(0)).alias("best_same"),
    )
