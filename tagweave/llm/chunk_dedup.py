"""Substring dedup by content-defined chunks and a gear rolling hash.

A chunk ends before a word when the gear hash of the 16 bytes before that word
is small, or the smallest (ties included) among the ``AROUND`` words on either
side, so text that repeats one word or line is cut at least once a period. Cuts
depend on nearby bytes only (no minimum or maximum length that would carry over
from the last cut), so an insertion moves no cut a few words beyond it and a
passage is cut alike wherever it stands. Two neighbouring chunks are
a link (a chunk of ``MIN_WORDS`` words is one alone), compared by 64-bit digest
of its bytes; the first occurrence, by (doc_id, place), stays. Later links that
share a chunk make a run, which goes if it has at least ``MIN_WORDS`` words. So
short phrases seen here and there remove nothing: every step from one chunk of
a run to the next was seen before. In a script written without spaces
(``UNSPACED``) a chunk may end before any code point, and ``CODE_POINTS`` of
them count as a word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tagweave.llm.common import discard, written
from tagweave.llm.hashing import BYTE_VALUES, SPACE, Chunk, chunks, mix, prefix_hash, range_hash

#: Mean words in a chunk.
MEAN_WORDS = 4
#: Shortest run of repeated chunks that is removed.
MIN_WORDS = 20
#: Bytes that the gear hash covers.
WINDOW = 16
#: Code points of a script written without spaces that count as a word.
CODE_POINTS = 2
#: Such scripts: Thai to Myanmar, Khmer, kana to ideographs, further ideographs, those beyond 16 bits.
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x9FFF),
            (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF))
#: Words on either side among which the smallest gear hash cuts.
AROUND = 8
_GEAR = (BYTE_VALUES >> np.uint64(32)).astype(np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """Gear hash h[i] = (h[i-1] << 1) + G[byte], over the 16 bytes up to each place."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8):
        if len(h) > step:
            h[step:] = h[step:] + (h[:-step] << np.uint32(step))
    return h


def _unspaced(data: np.ndarray) -> np.ndarray:
    """Places where a code point of a script written without spaces starts."""
    # Three bytes from 0xE0 on, four from 0xF0 on.
    at = np.flatnonzero(data >= 0xE0)
    b = [data[np.minimum(at + j, len(data) - 1)].astype(np.uint32) & 63 for j in range(4)]
    three = (b[0] & 15) << 12 | b[1] << 6 | b[2]
    point = np.where(data[at] < 0xF0, three, (b[0] & 7) << 18 | b[1] << 12 | b[2] << 6 | b[3])
    found = np.zeros(len(at), dtype=bool)
    for lo, hi in UNSPACED:
        found |= (point >= lo) & (point <= hi)
    return at[found]


def _lowest(h: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Whether h[i] is the smallest, ties included, of the ``AROUND`` values on either side in its text."""
    if not len(h):
        return np.zeros(0, dtype=bool)
    # Gaps between the texts, so that no window reaches another text's values.
    at = np.arange(len(h)) + AROUND * (1 + np.concatenate([[0], np.cumsum(np.diff(text) > 0)]))
    spread = np.full(at[-1] + AROUND + 1, np.iinfo(h.dtype).max, dtype=h.dtype)
    spread[at] = h
    return h == sliding_window_view(spread, 2 * AROUND + 1).min(axis=1)[at - AROUND]


def cut(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, weight, first chunk of each text) of the pieces of every text.

    Pieces tile each text; an empty text has none. Weight: ``CODE_POINTS`` for each
    word, 1 for each code point of a script written without spaces.
    """
    data, offsets = chunk.data, chunk.offsets
    n = len(data)
    word = ~SPACE[data]
    word[1:] &= SPACE[data[:-1]]
    text_start = np.zeros(n + 1, dtype=bool)
    text_start[offsets] = True
    word |= text_start[:n] & ~SPACE[data]
    weight = word * np.uint8(CODE_POINTS)
    weight[_unspaced(data)] = 1
    places = np.flatnonzero(weight[1:]) + 1
    # No cut in a text's first bytes, where the window would reach into the text before.
    text = np.searchsorted(offsets, places, side="right") - 1
    inside = places - offsets[text] >= WINDOW
    places, text = places[inside], text[inside]
    h = gear(data)[places - 1]
    cuts = text_start
    bound = ((1 << 32) // (MEAN_WORDS * CODE_POINTS) * weight[places].astype(np.int64)).astype(np.uint32)
    cuts[places[(h < bound) | _lowest(h, text)]] = True
    start = np.flatnonzero(cuts[:n])
    end = np.append(start[1:], n)
    counts = np.concatenate([[0], np.cumsum(weight, dtype=np.int64)])
    return start, end, counts[end] - counts[start], np.searchsorted(start, offsets)


def _links(chunk: Chunk, start: np.ndarray, end: np.ndarray, weight: np.ndarray, first: np.ndarray):
    """(first piece, last piece, digest, seen before in its text, first of each text) of every link.

    A link is two neighbouring pieces of a text, or one piece of ``MIN_WORDS`` words.
    """
    text = np.searchsorted(first, np.arange(len(start)), side="right") - 1
    pair = np.flatnonzero(text[1:] == text[:-1])
    whole = np.flatnonzero(weight >= MIN_WORDS * CODE_POINTS)
    a, b = np.concatenate([pair, whole]), np.concatenate([pair + 1, whole])
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    h = mix(range_hash(prefix_hash(chunk.data), start[a], end[b]) + (end[b] - start[a]).astype(np.uint64))
    order = np.lexsort((h, text[a]))
    again = np.zeros(len(h), dtype=bool)
    again[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (text[a[order[1:]]] == text[a[order[:-1]]])
    return a, b, h.view(np.int64), again, np.searchsorted(a, first)


def _digests(batches):
    """The distinct digests of every text's links."""
    for batch in batches:
        keys = batch.column(0)
        for chunk in chunks(batch.column(1)):
            *_, h, again, first = _links(chunk, *cut(chunk))
            new = np.concatenate([[0], np.cumsum(~again)])[first]
            lists = pa.ListArray.from_arrays(pa.array(new.astype(np.int32)), pa.array(h[~again]))
            yield pa.RecordBatch.from_arrays([keys.slice(chunk.rows[0], len(chunk.rows)), lists], names=["doc_id", "h"])


def _runs(one: np.ndarray, two: np.ndarray, weight: np.ndarray) -> list[tuple[int, int]]:
    """Runs [a, b) of pieces joined by the repeated links (one, two) with enough words."""
    if not len(one):
        return []
    # Links are in order of their first piece; one that begins at the last piece of the run so far goes on with it.
    last = np.maximum.accumulate(two)
    new = np.concatenate([[True], one[1:] > last[:-1]])
    total = np.concatenate([[0], np.cumsum(weight)])
    runs = zip(one[new], last[np.append(np.flatnonzero(new)[1:] - 1, len(one) - 1)] + 1, strict=True)
    return [(a, b) for a, b in runs if total[b] - total[a] >= MIN_WORDS * CODE_POINTS]


def _remove(batches):
    """Column 0: digests that earlier documents hold; column 1: the text; appends the counts and the kept text."""
    for batch in batches:
        repeated = batch.column(0)
        n_bytes, n_removed, n_spans, kept = [], [], [], []
        for chunk in chunks(batch.column(1)):
            start, end, weight, first = cut(chunk)
            one, two, h, again, link = _links(chunk, start, end, weight, first)
            for i, row in enumerate(chunk.rows):
                text = chunk.text(i)
                a, b = first[i], first[i + 1]
                mine = slice(link[i], link[i + 1])
                hit = again[mine]
                if repeated[row].is_valid:
                    hit = hit | np.isin(h[mine], repeated[row].values.to_numpy())
                begin = chunk.offsets[i]
                runs = _runs(one[mine][hit] - a, two[mine][hit] - a, weight[a:b])
                runs = [(start[a + x] - begin, end[a + y - 1] - begin) for x, y in runs]
                rest, at = [], 0
                for x, y in runs:
                    rest.append(text[at:x])
                    at = y
                rest.append(text[at:])
                n_bytes.append(len(text))
                n_removed.append(sum(y - x for x, y in runs))
                n_spans.append(len(runs))
                kept.append(b"".join(rest))
        names = batch.schema.names
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[2:],
                pa.array(n_bytes, pa.int64()),
                pa.array(n_removed, pa.int64()),
                pa.array(n_spans, pa.int32()),
                pa.array([x.decode() for x in kept], pa.string()),
            ],
            names=[*names[2:], "_n_bytes", "_n_removed", "_n_spans", "_kept"],
        )


def _later_links(pieces: DataFrame) -> DataFrame:
    """(doc_id, h) of the links that an earlier document holds.

    Both sides of the join read one shuffle of the links, so the filter on doc_id comes before it.
    """
    rows = pieces.where("doc_id is not null").select("doc_id", F.explode("h").alias("h")).repartition("h")
    firsts = (
        rows.groupBy("h").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last").select("h", "first")
    )
    return rows.join(firsts, "h").where(F.col("doc_id") > F.col("first")).select("doc_id", "h")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with _n_bytes, _n_removed, _n_spans and _kept (the text left).

    Places are UTF-8 bytes; cuts are at words, so the text left is valid UTF-8.
    Null text counts as empty. doc_id is the key: rows that repeat one count
    as one document's and lose only what an earlier document or they themselves hold. Other columns pass through whatever their names (but the four
    added ones). An empty table gives no rows.
    """
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = written(text.mapInArrow(_digests, "doc_id long, h array<long>"), "chunks")
    marks = _later_links(pieces).groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set("h").alias("_marks"))
    marks = written(marks, "chunk-marks")
    discard(pieces)
    joined = docs.join(marks, docs["doc_id"].cast("long") == marks["_id"], "left").select(
        F.col("_marks"), docs["text"].alias("_text"), *[docs[c] for c in docs.columns]
    )
    schema = StructType(
        docs.schema.fields
        + [
            StructField("_n_bytes", LongType()), StructField("_n_removed", LongType()),
            StructField("_n_spans", IntegerType()), StructField("_kept", StringType()),
        ]
    )
    return joined.mapInArrow(_remove, schema)


def dedup_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, text) per document; text: what is left."""
    return remove_repeats(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).select(
        "doc_id", F.col("_n_bytes").alias("n_bytes"), F.col("_n_removed").alias("n_removed"),
        F.col("_n_spans").alias("n_spans"), F.col("_kept").alias("text"),
    )
