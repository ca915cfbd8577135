"""N-gram Jaccard self-join by prefix filters under several global token orders.

Two documents link when the Jaccard similarity of their word-shingle sets is
at least ``percent`` / 100. Under any total order of the shingles, two linked
sets share a token within their prefixes (the first n - ceil(t n) + 1 tokens).
Three orders are used:

* order A, by hash: decides which documents can have a partner at all. With a
  prefix longer by l tokens, linked sets share l of them, so a document of
  whose longer prefix too few tokens occur elsewhere is out. Token counts are
  pre-aggregated, so a very common shingle is no hot group.
* order B, by document frequency among the remaining documents: makes the
  candidates (rare shingles first; shared boilerplate stays out of prefixes).
* order C, by a second hash: candidates must share a prefix token under A and
  C too before they are verified.

A candidate must also leave room for enough common tokens after its first
common one. No group is expanded to all its pairs: documents with equal sets
are one class from the start; in each star round a set is verified against one
candidate only, from the first component of the token groups it shares most
with, and components are built from the links found. The last round takes every
candidate pair whose two sides are still in different components, so no link
that matters to a component is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagweave.llm.common import discard, given_ids, keyed, semi_join, written
from tagweave.llm.components import connected_components
from tagweave.llm.hashing import ORDER_VALUES, chunks, mix, shingles, words

WIDTH = 5
PERCENT = 75
#: Extra prefix tokens under order A, as a share of the set's size.
EXTRA = 0.15
#: Rounds of one candidate per set before all candidates across components.
STAR_ROUNDS = 2


def _distinct(chunk, width: int):
    """(row, sorted distinct shingle hashes) for every text of a chunk."""
    hashes, offsets = shingles(words(chunk), width)
    for i, row in enumerate(chunk.rows):
        yield row, np.unique(hashes[offsets[i] : offsets[i + 1]])


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def _heads(width: int, percent: int):
    def run(batches):
        for batch in batches:
            keys = batch.column(0)
            for chunk in chunks(batch.column(1)):
                sizes, one, two, heads = [], [], [], []
                for _, tokens in _distinct(chunk, width):
                    n = len(tokens)
                    head = n - (-(-percent * n // 100)) + max(1, int(EXTRA * n))
                    sizes.append(n)
                    one.append(tokens.sum(dtype=np.uint64))
                    two.append(mix(tokens ^ ORDER_VALUES[7]).sum(dtype=np.uint64))
                    heads.append(tokens[:head])
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.slice(chunk.rows[0], len(chunk.rows)),
                        pa.array(sizes, pa.int64()),
                        pa.array(np.array(one, np.uint64).view(np.int64)),
                        pa.array(np.array(two, np.uint64).view(np.int64)),
                        _lists(heads),
                    ],
                    names=["doc_id", "n", "d1", "d2", "head"],
                )

    return run


def _sets(width: int):
    def run(batches):
        for batch in batches:
            keys = batch.column(0)
            for chunk in chunks(batch.column(1)):
                parts = [tokens for _, tokens in _distinct(chunk, width)]
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(chunk.rows[0], len(chunk.rows)), pa.array([len(x) for x in parts], pa.int64()), _lists(parts)],
                    names=["doc_id", "n", "tokens"],
                )

    return run


def _prefix_length(percent: int):
    """n - ceil(t n) + 1 as an integer column expression of ``n``."""
    return F.expr(f"cast(n - ceil({percent} * n / 100.0d) + 1 as int)")


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among (a, b): the filters of orders A and C, then the exact similarity."""

    def side(name: str) -> DataFrame:
        c = F.slice(F.col("by_c"), 1, _prefix_length(percent))
        head = F.slice(F.col("tokens"), 1, _prefix_length(percent))
        return sets.select(
            F.col("doc_id").alias(name), F.col("n").alias(f"n_{name}"), F.col("tokens").alias(f"t_{name}"),
            head.alias(f"pa_{name}"), c.alias(f"pc_{name}"),
        )

    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    same = F.size(F.array_intersect("t_a", "t_b")).cast("long")
    return (
        joined.where(F.arrays_overlap("pa_a", "pa_b"))
        .where(F.arrays_overlap("pc_a", "pc_b"))
        .withColumn("same", same)
        .where(100 * F.col("same") >= percent * (F.col("n_a") + F.col("n_b") - F.col("same")))
        .select("a", "b")
    )


def _labelled(index: DataFrame, found: DataFrame | None) -> DataFrame:
    """The index with each set's component so far (its own id before the first round)."""
    if found is None:
        return index.withColumn("component", F.col("doc_id"))
    label = found.select(F.col("node").alias("doc_id"), "component")
    return index.join(label, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))


def jaccard_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text).

    component_id: the smallest doc_id reachable by links, the document's own
    included. Null or empty text, or white space only: an empty set, linked
    with nothing. Fewer than ``width`` words: the whole sequence is the one
    shingle. Only doc_id and text are read, so other columns and their names
    do not matter; an empty table gives no rows. Every row is a document, so rows
    of one doc_id may be in different components; a null doc_id is greater than any other.
    """
    text, ids = keyed(docs, "jaccard")
    sets = written(
        text.mapInArrow(_heads(width, percent), "doc_id long, n long, d1 long, d2 long, head array<long>"), "jaccard-heads"
    )
    members = written(sets.select("doc_id", "n", "d1", "d2"), "jaccard-members")
    classes = written(members.where("n > 0").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("rep")), "jaccard-classes")

    # Order A: documents of whose longer prefix enough tokens occur elsewhere.
    rows = sets.select("doc_id", "n", F.explode("head").alias("token"))
    repeated = rows.groupBy("token").agg(F.count("*").alias("k")).where("k > 1").select("token")
    need = F.greatest(F.lit(1), F.floor(F.greatest(F.lit(1), F.floor(F.col("n") * EXTRA)) * percent / 100 - 1e-9))
    able = rows.join(repeated, "token").groupBy("doc_id", "n").agg(F.count("*").alias("hits")).where(F.col("hits") >= need)
    able = written(able.select("doc_id").join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi"), "jaccard-able")
    discard(sets)
    full = semi_join(text, able, "doc_id").mapInArrow(_sets(width), "doc_id long, n long, tokens array<long>")
    by_c = F.array_sort(F.transform("tokens", lambda x: F.struct(F.xxhash64(x).alias("h"), x.alias("x"))))
    full = written(
        full.withColumn("by_c", F.transform(by_c, lambda s: s["x"])), "jaccard-sets"
    )

    # Order B: by document frequency, hash breaking ties; single tokens come first and index nothing.
    tokens = full.select("doc_id", "n", F.explode("tokens").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    ordered = (
        tokens.join(shared, "token")
        .groupBy("doc_id", "n")
        .agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("order_b"))
    )
    single = F.col("n") - F.size("order_b")
    keep = F.greatest(F.lit(0), (_prefix_length(percent) - single).cast("int"))
    index = written(
        ordered.select("doc_id", "n", single.alias("single"), F.posexplode(F.slice("order_b", 1, keep)).alias("i", "x")).select(
            "doc_id", "n", F.col("x.token").alias("token"), (F.col("n") - F.col("single") - F.col("i")).alias("rest")
        ),
        "jaccard-index",
    )
    # A pair is looked for at its first common token: no more than the tokens from there on can be common.
    possible = F.expr(f"{100 + percent} * least(rest, rest_a) >= {percent} * (n + n_a)")

    # Star rounds: each set against one member of another component that it shares most prefix tokens with.
    links, found = None, None
    for _ in range(STAR_ROUNDS):
        labelled = _labelled(index, found)
        first = labelled.groupBy("token").agg(F.min(F.struct("component", "doc_id", "n", "rest")).alias("c")).select(
            "token", F.col("c.doc_id").alias("a"), F.col("c.n").alias("n_a"), F.col("c.rest").alias("rest_a"),
            F.col("c.component").alias("c_a"),
        )
        shares = (
            labelled.join(first, "token").where((F.col("component") != F.col("c_a")) & possible)
            .groupBy(F.col("doc_id").alias("b"), "a").agg(F.count("*").alias("k"))
        )
        best = Window.partitionBy("b").orderBy(F.desc("k"), "a")
        pairs = shares.withColumn("r", F.row_number().over(best)).where("r = 1").select("a", "b")
        new = written(_verify(pairs, full, percent), "jaccard-links")
        links = new if links is None else links.unionByName(new)
        found = connected_components(links)

    # Last round: every candidate whose sides are still in different components.
    labelled = _labelled(index, found)
    mixed = labelled.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    open_index = written(labelled.join(mixed.select("token"), "token", "left_semi"), "jaccard-open")
    discard(index)
    left = open_index.select(
        "token", F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("rest").alias("rest_a"), F.col("component").alias("c_a")
    )
    right = open_index.select("token", F.col("doc_id").alias("b"), "n", "rest", "component")
    cross = left.join(right, "token").where((F.col("a") < F.col("b")) & (F.col("c_a") != F.col("component")) & possible)
    more = _verify(cross.select("a", "b").distinct(), full, percent)
    found = connected_components(links.unionByName(more))
    discard(full, open_index, links, able)

    by_class = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "n", "d1", "d2", F.coalesce("component", "rep").alias("c")
    )
    labelled = members.join(by_class, ["n", "d1", "d2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("c", "doc_id").alias("component_id")
    )
    return given_ids(labelled, ids, ("doc_id", "component_id"))
