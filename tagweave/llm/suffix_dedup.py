"""Exact removal of repeated 100-byte strings with a logarithmic family of suffix arrays.

A byte goes if a ``LENGTH``-byte string covering it also starts earlier. Only
suffixes that can have an earlier equal are indexed:

1. Every window of ``LENGTH`` bytes names its anchor, the ``GRAM``-byte string in
   it with the smallest hash. Equal windows have equal anchors at equal places, so
   windows fall into runs that share an anchor, about one per 43 bytes, and a run
   whose anchor occurs once in the corpus is done. Anchors are counted with
   aggregation before the shuffle.
2. Runs that are equal as byte strings (exact copies) are settled by their
   smallest place: all windows of the others are repeats.
3. The distinct runs that share an anchor go to index groups by anchor. A group
   takes its runs in corpus order in batches: a batch gets its suffix array (its
   window starts in byte order), is merge-scanned against the levels of the
   family for matches of the full length, and what is new becomes a level; levels
   of equal size merge, so each suffix is merged O(log batches) times.
4. An anchor with very many distinct runs (the edge of a passage that a large
   part of the corpus shares) would make one large group; its windows are
   compared one by one instead, by 128-bit hash and aggregated minimum.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import discard, given_ids, keyed, written
from tagweave.llm.hashing import BYTE_VALUES, ORDER_VALUES, chunks, mix, prefix_hash, range_hash

LENGTH = 100
GRAM = 16
#: Texts are cut into runs in blocks of about this many bytes.
BLOCK = 1 << 18
#: Distinct runs of one anchor beyond which windows are compared one by one.
HOT_RUNS = 50_000
#: Distinct runs in an index group, on average, and windows in a batch of the family.
GROUP_RUNS = 4_000
BATCH_WINDOWS = 16_384
_PLACE_BITS = np.uint64(24)


def runs_of(data: np.ndarray, offsets: np.ndarray):
    """(text, start in text, windows, anchor hash, run hash) of the runs of several texts laid end to end."""
    n, span = len(data), LENGTH - GRAM + 1
    windows = n - LENGTH + 1
    if windows <= 0:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2
    prefix = prefix_hash(data)
    at = np.arange(n - GRAM + 1)
    grams = mix(range_hash(prefix, at, at + GRAM))
    low = ((grams >> _PLACE_BITS) << _PLACE_BITS) | at.astype(np.uint64)
    have = 1
    while have * 2 <= span:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < span:
        low = np.minimum(low[: len(low) - (span - have)], low[span - have :])
    anchor = (low & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:windows]
    valid = np.arange(windows) + LENGTH <= offsets[text + 1]
    change = np.empty(windows, dtype=bool)
    change[0] = True
    change[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    start = np.flatnonzero(valid & change)
    size = np.diff(np.append(start, windows))
    # A text's last run ends with its last valid window.
    size = np.minimum(size, offsets[text[start] + 1] - LENGTH + 1 - start)
    whole = mix(range_hash(prefix, start, start + size + LENGTH - 1) + size.astype(np.uint64))
    return text[start], start - offsets[text[start]], size, grams[anchor[start]], whole


def _blocks(chunk):
    """(first text, shift, data, offsets): a long text in overlapping blocks, each window in one."""
    if len(chunk.data) <= 4 * BLOCK:
        yield 0, 0, chunk.data, chunk.offsets
        return
    for i in range(len(chunk.rows)):
        a, b = chunk.offsets[i], chunk.offsets[i + 1]
        for lo in range(a, max(a + 1, b - LENGTH + 1), 4 * BLOCK):
            part = chunk.data[lo : min(b, lo + 4 * BLOCK + LENGTH - 1)]
            yield i, lo - a, part, np.array([0, len(part)])


def _runs(batches):
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for chunk in chunks(batch.column(1), BLOCK):
            for first, shift, data, offsets in _blocks(chunk):
                text, start, size, anchor, whole = runs_of(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[chunk.rows[0] + first + text]), pa.array((start + shift).astype(np.int32)),
                        pa.array(size.astype(np.int32)), pa.array(anchor.view(np.int64)), pa.array(whole.view(np.int64)),
                    ],
                    names=["doc_id", "start", "n", "anchor", "run"],
                )


def _compress(batches):
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        z = [pack.compress((t.as_py() or "").encode()) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(z, pa.binary())], names=["doc_id", "z"])


def _slices(batches, rows: int = 500):
    """Smaller batches, so that a batch's Python objects stay few."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _extract(batches):
    """The bytes of the listed runs of every document."""
    unpack = zstandard.ZstdDecompressor()
    for batch in _slices(batches):
        ids, starts, sizes, anchors, texts = [], [], [], [], []
        for doc_id, z, wanted in zip(batch["doc_id"].to_pylist(), batch["z"], batch["runs"], strict=True):
            data = unpack.decompress(z.as_py())
            for r in wanted.as_py():
                ids.append(doc_id)
                starts.append(r["start"])
                sizes.append(r["n"])
                anchors.append(r["anchor"])
                texts.append(data[r["start"] : r["start"] + r["n"] + LENGTH - 1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(starts, pa.int32()), pa.array(sizes, pa.int32()), pa.array(anchors, pa.int64()),
             pa.array(texts, pa.binary())],
            names=["doc_id", "start", "n", "anchor", "bytes"],
        )


class SuffixFamily:
    """Levels of sorted distinct ``LENGTH``-byte suffixes, of geometrically growing size."""

    def __init__(self):
        self.levels: list[np.ndarray] = []

    def add(self, keys: np.ndarray) -> np.ndarray:
        """Take a batch of suffixes in corpus order; True where an equal one came before."""
        order = np.argsort(keys, kind="stable")  # the batch's suffix array
        ranked = keys[order]
        repeat = np.zeros(len(keys), dtype=bool)
        repeat[1:] = ranked[1:] == ranked[:-1]
        for level in self.levels:  # merge scan: both sides are in byte order
            at = np.minimum(np.searchsorted(level, ranked), len(level) - 1)
            repeat |= level[at] == ranked
        new = ranked[~repeat]
        if len(new):
            self.levels.append(new)
        while len(self.levels) > 1 and len(self.levels[-1]) * 2 > len(self.levels[-2]):
            a, b = self.levels.pop(), self.levels.pop()
            self.levels.append(np.sort(np.concatenate([b, a]), kind="stable"))
        out = np.empty(len(keys), dtype=bool)
        out[order] = repeat
        return out


def _spans(flags: np.ndarray, doc: np.ndarray, at: np.ndarray):
    """Byte spans (doc, lo, hi) of repeated windows; windows of a run are consecutive rows."""
    hit = np.flatnonzero(flags)
    if not len(hit):
        return doc[:0], at[:0], at[:0]
    new = np.empty(len(hit), dtype=bool)
    new[0] = True
    new[1:] = (np.diff(hit) != 1) | (doc[hit[1:]] != doc[hit[:-1]]) | (np.diff(at[hit]) != 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(hit)) - 1
    return doc[hit[first]], at[hit[first]], at[hit[last]] + LENGTH


def _scan_group(table: pa.Table) -> pa.Table:
    """Repeated spans among the runs of one index group."""
    table = table.combine_chunks().sort_by([("doc_id", "ascending"), ("start", "ascending")])
    doc, start, size = (table[c].to_numpy() for c in ("doc_id", "start", "n"))
    found = []
    family = SuffixFamily()
    ends = np.cumsum(size)
    a = 0
    while a < len(doc):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] - size[a] + BATCH_WINDOWS, side="right")))
        data = np.frombuffer(b"".join(table["bytes"][a:b].to_pylist()), dtype=np.uint8) + np.uint8(1)  # no zero bytes
        lengths = size[a:b] + LENGTH - 1
        inside = np.arange(size[a:b].sum()) - np.repeat(np.cumsum(size[a:b]) - size[a:b], size[a:b])
        place = inside + np.repeat(np.cumsum(lengths) - lengths, size[a:b])
        suffixes = np.lib.stride_tricks.as_strided(data.view("S1"), shape=(len(data) - LENGTH + 1, LENGTH), strides=(1, 1))
        keys = suffixes[place].view(f"S{LENGTH}").ravel()
        found.append(_spans(family.add(keys), np.repeat(doc[a:b], size[a:b]), np.repeat(start[a:b], size[a:b]) + inside))
        a = b
    columns = [np.concatenate(x) for x in zip(*found, strict=True)]
    return pa.table({"doc_id": columns[0], "lo": columns[1].astype(np.int64), "hi": columns[2].astype(np.int64)})


def _window_hashes(batches):
    """(doc_id, at, h1, h2) of every window of the runs."""
    for batch in batches:
        for doc_id, start, n, raw in zip(*(batch[c].to_pylist() for c in ("doc_id", "start", "n", "bytes")), strict=True):
            data = np.frombuffer(raw, dtype=np.uint8)
            at = np.arange(n)
            h1 = mix(range_hash(prefix_hash(data), at, at + LENGTH))
            other = (mix(BYTE_VALUES * ORDER_VALUES[9]) & np.uint64(255)).astype(np.uint8)
            h2 = mix(range_hash(prefix_hash(data ^ other[data[::1]]), at, at + LENGTH) ^ ORDER_VALUES[8])
            yield pa.RecordBatch.from_arrays(
                [pa.array([doc_id] * n, pa.int64()), pa.array((at + start).astype(np.int64)), pa.array(h1.view(np.int64)),
                 pa.array(h2.view(np.int64))],
                names=["doc_id", "at", "h1", "h2"],
            )


def _finish(batches):
    """Counts and digest of what is left of every document."""
    unpack = zstandard.ZstdDecompressor()
    for batch in _slices(batches):
        rows = []
        for doc_id, z, spans in zip(batch["doc_id"].to_pylist(), batch["z"], batch["spans"], strict=True):
            data = unpack.decompress(z.as_py())
            merged: list[list[int]] = []
            for s in sorted((s["lo"], s["hi"]) for s in spans.as_py() or ()):
                if merged and s[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s[1])
                else:
                    merged.append([*s])
            digest, at = hashlib.sha256(), 0
            for lo, hi in merged:
                digest.update(data[at:lo])
                at = hi
            digest.update(data[at:])
            rows.append((doc_id, len(data), sum(hi - lo for lo, hi in merged), len(merged), digest.hexdigest(), merged))
        kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.list_(pa.int64()))]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"]
        columns = zip(*rows, strict=True) if rows else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)


def remove_repeated_strings(docs: DataFrame, hot_runs: int = HOT_RUNS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed) for every document.

    removed: the maximal removed runs, [start, end) in UTF-8 bytes. Earlier means
    a smaller doc_id, or the same document and an earlier start; overlapping
    repeats count. Null text is empty; texts under ``LENGTH`` bytes lose nothing.
    Every row is a document: of rows with one doc_id (ordered among themselves by their texts' hash) and
    one text the first keeps it, rows with a null doc_id come after all others.
    Only doc_id and text are read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    text, ids = keyed(docs, "suffix")
    runs = written(text.mapInArrow(_runs, "doc_id long, start int, n int, anchor long, run long"), "suffix-runs")
    common = written(runs.groupBy("anchor").agg(F.count("*").alias("k")).where("k > 1").select("anchor"), "suffix-anchors")
    shared = written(runs.join(common, "anchor"), "suffix-shared")
    discard(runs, common)
    place = F.struct("doc_id", "start")
    first = shared.groupBy("run").agg(F.min(place).alias("first"))
    known = written(shared.join(first, "run").select("doc_id", "start", "n", "anchor", (place == F.col("first")).alias("is_first")), "suffix-known")
    discard(shared)
    copies = known.where("not is_first").select(
        "doc_id", F.col("start").cast("long").alias("lo"), (F.col("start") + F.col("n") + LENGTH - 1).cast("long").alias("hi")
    )
    distinct = known.where("is_first").select("doc_id", "start", "n", "anchor")
    several = distinct.groupBy("anchor").agg(F.count("*").alias("k")).where("k > 1")
    indexed = written(distinct.join(several, "anchor"), "suffix-indexed")
    hot_row = indexed.agg(F.count("*").alias("n"), F.max("k").alias("k")).first()
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (hot_row["n"] or 0) // GROUP_RUNS)

    packed = text.mapInArrow(_compress, "doc_id long, z binary")

    def extract(rows: DataFrame) -> DataFrame:
        wanted = rows.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n", "anchor")).alias("runs"))
        return packed.join(wanted, "doc_id").mapInArrow(_extract, "doc_id long, start int, n int, anchor long, bytes binary")

    group = F.pmod(F.xxhash64("anchor"), F.lit(groups)).alias("g")
    found = (
        extract(indexed.where(F.col("k") <= hot_runs)).select("doc_id", "start", "n", "bytes", group)
        .groupBy("g").applyInArrow(_scan_group, "doc_id long, lo long, hi long")
    )
    spans, windows = copies.unionByName(found), None
    if (hot_row["k"] or 0) > hot_runs:
        windows = written(
            extract(indexed.where(F.col("k") > hot_runs)).mapInArrow(_window_hashes, "doc_id long, at long, h1 long, h2 long"),
            "suffix-windows",
        )
        earliest = windows.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "at")).alias("first"))
        again = windows.join(earliest, ["h1", "h2"]).where(F.struct("doc_id", "at") != F.col("first"))
        spans = spans.unionByName(again.select("doc_id", F.col("at").alias("lo"), (F.col("at") + LENGTH).alias("hi")))
    per_doc = written(spans.groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")), "suffix-spans")
    discard(known, indexed, *([] if windows is None else [windows]))
    finished = packed.join(per_doc, "doc_id", "left").mapInArrow(
        _finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<array<long>>"
    )
    return given_ids(finished, ids)
