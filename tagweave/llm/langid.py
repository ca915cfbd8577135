"""Language identification by prediction by partial matching (PPM).

One byte context tree per language, of orders 4 to 0, holds how often each byte
followed each context in a training sample. A text's code length under a
language is exact under these frozen statistics: a byte seen after the longest
context costs -log2(c / (n + d)) (c: its count, n: the context's total, d: its
distinct bytes); otherwise an escape, -log2(d / (n + d)), is paid and the next
shorter context tried, down to 8 bits for any byte. A context never seen costs
no escape. The language with the shortest code wins.

Training takes a bounded sample, ``SAMPLE_DOCS`` whole labelled texts per
language (those with the smallest id hashes); its n-grams are counted on the
executors. All languages share one table of n-grams with a code length per
language, so a byte usually costs one lookup.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagweave.llm.hashing import LOWER, chunks

ORDER = 4
#: Labelled documents per language that the trees are learned from.
SAMPLE_DOCS = 300
UNKNOWN = "und"
#: Bytes scored at once.
BLOCK = 1 << 19
_START = np.full(ORDER, 0x0A, dtype=np.uint8)  # context before a text's first byte
_U64 = np.uint64


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus == remainder


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    """Key of the ``size`` bytes that end at each place from ORDER on; keys differ between sizes."""
    n = len(data) - ORDER
    key = np.full(n, size, dtype=np.uint64)
    for back in range(size - 1, -1, -1):
        key = (key << _U64(8)) | data[ORDER - back : ORDER - back + n].astype(np.uint64)
    return key


def _count(batches):
    """(lang, key, k): n-gram counts of every batch."""
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for chunk in chunks(batch.column(1), BLOCK):
            by_lang: dict[str, list[np.ndarray]] = {}
            for i, row in enumerate(chunk.rows):
                data = LOWER[chunk.data[chunk.offsets[i] : chunk.offsets[i + 1]]]
                data = np.concatenate([_START, data])
                by_lang.setdefault(langs[row], []).extend(_grams(data, size) for size in range(1, ORDER + 2))
            for lang, parts in by_lang.items():
                keys, k = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(k, pa.int64())], names=["lang", "key", "k"]
                )


@dataclass
class Model:
    langs: list[str]
    slots: np.ndarray  # open-addressed hash table: gram number + 1, 0 if free
    keys: np.ndarray
    cost: np.ndarray  # (grams, languages) bits of the gram's last byte after the bytes before
    escape: np.ndarray  # (grams, languages) bits of leaving the gram as a context
    floor: np.ndarray  # bits of a byte never seen at order 0


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys * _U64(0x9E3779B97F4A7C15)) >> _U64(64 - bits)).astype(np.int64)


def build_model(langs: np.ndarray, keys: np.ndarray, k: np.ndarray) -> Model:
    """Code lengths of every gram from (language, key, count) rows."""
    names = sorted(set(langs.tolist()))
    # The start bytes are contexts though no gram ends in them: every context is a gram here.
    sizes = [keys[(keys >> _U64(8 * s)) == s] for s in range(2, ORDER + 2)]
    contexts = [((x >> _U64(8)) & ((_U64(1) << _U64(8 * s - 8)) - _U64(1))) | (_U64(s - 1) << _U64(8 * s - 8)) for s, x in enumerate(sizes, 2)]
    uniq = np.unique(np.concatenate([keys, *contexts]))
    counts = np.zeros((len(uniq), len(names)))
    np.add.at(counts, (np.searchsorted(uniq, keys), np.searchsorted(names, langs)), k)
    cost = np.zeros_like(counts)
    escape = np.zeros_like(counts)
    floor = np.full(len(names), 8.0)
    for size in range(1, ORDER + 2):
        tag = _U64(size) << _U64(8 * size)
        here = np.flatnonzero((uniq >= tag) & (uniq < tag + (_U64(1) << _U64(8 * size))))
        low = (_U64(1) << _U64(8 * (size - 1))) - _U64(1)
        context = ((uniq[here] >> _U64(8)) & low) | (_U64(size - 1) << _U64(8 * (size - 1)))
        contexts, ci = np.unique(context, return_inverse=True)
        n = np.zeros((len(contexts), len(names)))
        d = np.zeros_like(n)
        np.add.at(n, ci, counts[here])
        np.add.at(d, ci, counts[here] > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            esc = np.where(n > 0, np.log2((n + d) / d), 0.0)
            seen = np.log2((n + d)[ci] / counts[here])
        if size == 1:
            floor = esc[0] + 8.0 if len(here) else floor
            lower = np.broadcast_to(np.full(len(names), 8.0), (len(here), len(names)))
        else:
            shorter = (uniq[here] & ((_U64(1) << _U64(8 * (size - 1))) - _U64(1))) | (_U64(size - 1) << _U64(8 * (size - 1)))
            lower = cost[np.searchsorted(uniq, shorter)]
            escape[np.searchsorted(uniq, contexts)] = esc
        cost[here] = np.where(counts[here] > 0, seen, esc[ci] + lower)
    bits = max(4, int(np.ceil(np.log2(max(1, len(uniq)) * 3))))
    slots = np.zeros(1 << bits, dtype=np.int32)
    todo, place = np.arange(len(uniq)), _slot(uniq, bits)
    while len(todo):
        free = slots[place] == 0
        slots[place[free]] = todo[free] + 1  # the last writer of a slot stays
        lost = slots[place] != todo + 1
        todo, place = todo[lost], (place[lost] + 1) & ((1 << bits) - 1)
    return Model(names, slots, uniq, cost.astype(np.float32), escape.astype(np.float32), floor.astype(np.float32))


def _find(model: Model, keys: np.ndarray) -> np.ndarray:
    """Gram number of each key, -1 if none."""
    mask = len(model.slots) - 1
    place = _slot(keys, mask.bit_length())
    found = model.slots[place] - 1
    todo = np.flatnonzero((found >= 0) & (model.keys[found] != keys))
    place = place[todo]
    while len(todo):
        place = (place + 1) & mask
        got = model.slots[place] - 1
        found[todo] = got
        again = (got >= 0) & (model.keys[got] != keys[todo])
        todo, place = todo[again], place[again]
    return found


def code_lengths(model: Model, data: np.ndarray) -> np.ndarray:
    """Bits of each byte from ORDER on, per language; the bytes before are context."""
    if not len(model.keys):
        return np.full((len(data) - ORDER, len(model.langs)), 8.0, dtype=np.float32)
    found = _find(model, _grams(data, ORDER + 1))
    bits = model.cost[found]
    missed = np.flatnonzero(found < 0)
    bits[missed] = 0
    for size in range(ORDER, 0, -1):  # leave the context of this size, then try the gram of this size
        if not len(missed):
            return bits
        grams = _grams(data, size)
        before = np.concatenate([[0], grams[:-1]])[missed].astype(np.uint64)
        context = _find(model, before)
        bits[missed] += np.where((context >= 0)[:, None], model.escape[context], 0)
        found = _find(model, grams[missed])
        bits[missed[found >= 0]] += model.cost[found[found >= 0]]
        missed = missed[found < 0]
    bits[missed] += model.floor
    return bits


def score_texts(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Total bits of every text under every language."""
    total = np.zeros((len(offsets) - 1, len(model.langs)))
    padded = np.concatenate([np.concatenate([_START, data[a:b]]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
    padded = LOWER[padded]
    own = np.diff(offsets) + ORDER
    start = np.concatenate([[0], np.cumsum(own)])
    for a in range(ORDER, len(padded), BLOCK):
        b = min(a + BLOCK, len(padded))
        bits = code_lengths(model, padded[a - ORDER : b]).astype(np.float64)
        sums = np.concatenate([np.zeros((1, bits.shape[1])), np.cumsum(bits, axis=0)])
        first, last = np.searchsorted(start, a, side="right") - 1, np.searchsorted(start, b, side="left")
        lo = np.clip(start[first:last] + ORDER, a, b) - a
        hi = np.clip(start[first + 1 : last + 1], a, b) - a
        total[first:last] += sums[np.maximum(lo, hi)] - sums[lo]
    return total


def train(labelled: DataFrame) -> Model:
    """Trees from (doc_id, text, lang) rows: a bounded sample per language."""
    h = F.xxhash64("doc_id")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    chosen = usable.select("doc_id", "lang", h.alias("h")).withColumn("r", rank).where(F.col("r") <= SAMPLE_DOCS)
    sample = usable.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi").select("lang", "text")
    counts = sample.mapInArrow(_count, "lang string, key long, k long").groupBy("lang", "key").agg(F.sum("k").alias("k"))
    rows = counts.toArrow()
    langs = np.array(rows["lang"].to_pylist(), dtype=object)
    return build_model(langs, rows["key"].to_numpy().view(np.uint64), rows["k"].to_numpy())


def _predict(model):
    def run(batches):
        m = model.value
        for batch in batches:
            keys = batch.column(0)
            for chunk in chunks(batch.column(1), BLOCK):
                total = score_texts(m, chunk.data, chunk.offsets)
                size = np.diff(chunk.offsets)
                low = LOWER[chunk.data]
                latin = np.concatenate([[0], np.cumsum((low >= ord("a")) & (low <= ord("z")))])
                letters = np.diff(latin[chunk.offsets]) > 0
                for i in np.flatnonzero(~letters & (size > 0)):
                    letters[i] = any(c.isalpha() for c in chunk.text(i).decode())
                letters &= bool(m.langs)
                if m.langs:
                    best = total.argmin(axis=1)
                    least = total.min(axis=1)
                    score = 1 / np.exp2(np.maximum(least[:, None] - total, -1000)).sum(axis=1)
                else:
                    best, least, score = np.zeros(len(size), int), np.zeros(len(size)), np.zeros(len(size))
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.slice(chunk.rows[0], len(chunk.rows)),
                        pa.array([m.langs[b] if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)], pa.string()),
                        pa.array(np.where(letters, score, 0.0)),
                        pa.array(np.where(letters, least / np.maximum(size, 1), 0.0)),
                    ],
                    names=["doc_id", "lang_pred", "score", "bits_per_byte"],
                )

    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, bits_per_byte) from doc_id and text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return text.mapInArrow(_predict(shared), "doc_id long, lang_pred string, score double, bits_per_byte double")


def identify(docs: DataFrame, modulus: int = 3, remainder: int = 1) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, bits_per_byte) for every row of ``docs``.

    Learns from rows with text and lang whose crc32(doc_id as text) mod
    ``modulus`` is not ``remainder``. score: the chosen language's share of
    2^-bits over all languages. Null text or text without a letter: ``und`` with
    score 0, as is every row when there is nothing to learn from; ties go to the
    first language name. Only doc_id, text and lang are read; repeated rows are
    scored alike; an empty table gives no rows.
    """
    key = F.col("doc_id").cast("long").alias("doc_id")
    labelled = docs.where(~held_out(F.col("doc_id"), modulus, remainder)).select(key, "text", "lang")
    return predict(docs, train(labelled)).select(
        "doc_id", held_out(F.col("doc_id"), modulus, remainder).alias("held_out"), "lang_pred", "score", "bits_per_byte"
    )
