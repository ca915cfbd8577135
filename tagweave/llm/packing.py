"""Best-fit packing of token pieces after Martello-Toth dominance reduction.

Sequences hold ``capacity`` tokens. Lengths are integers up to the capacity, so
an instance is a histogram of at most ``capacity`` rows however many documents
there are; the driver solves that histogram and the executors look up places.

Reduction, largest length first, on the remaining histogram (each step fixes
sequences that are as good as any that hold the same largest piece):

* it fits with no other piece: alone;
* a partner fills the sequence exactly: that pair;
* only one partner can fit (two of the smallest do not): with the largest that does;
* no three can join it, and the largest partner is at least as long as the best
  two that fit: with that one.

The rest is packed best-fit decreasing: pieces of a length go to the open
sequences with the least room that still takes them. Sequences that look alike
are handled together as one pattern, so the work is by patterns, not by pieces.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagweave.llm.common import written

CAPACITY = 2048
#: Id put after each document's ids.
SEPARATOR = 0
#: Ranks within a length are counted in this many parts (a length may hold most pieces).
PARTS = 64
#: Words whose ids a Python worker keeps, in each of two generations (some 100 MB each).
CACHE_WORDS = 600_000
#: New words encoded as one text.
JOINED_WORDS = 64
#: Documents whose new words are encoded together.
ENCODE_ROWS = 256


# ------------------------------------------------------------- tokenizing --
_ENCODERS: dict[str, Encoder] = {}  # kept between the tasks of a Python worker


class Encoder:
    """Little-endian 32-bit ids of texts, word by word with a cache.

    The tokenizers meant here never merge across a space, line feed or tab, so
    a text's ids are its words' ids in order; words seen before cost a lookup.
    New words are encoded many at a time, as one text with a digit between
    them that none of them holds; its id says where one word's ids end.
    When the newer generation of the cache is full it becomes the older one, and
    words still in use move back from there.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self._check()
        self.marks = self._marks()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _marks(self) -> list[tuple[str, int]]:
        """Two digits that are one token of their own between words, with their ids."""
        found = []
        for digit in "79":
            alone, between = self._ids(digit), self._ids(f"a {digit} b")
            if len(alone) == 1 and between == self._ids("a") + alone + self._ids("b"):
                found.append((digit, alone[0]))
        return found

    def _check(self) -> None:
        """Raise if the file's tokenizer lets a token reach over white space."""
        whole, words = self._ids("one two  three\tfour\nfive "), [self._ids(w) for w in ("one", "two", "three", "four", "five")]
        if whole != [i for w in words for i in w] or self._ids(" \t\n"):
            raise ValueError("this tokenizer's ids depend on white space: word by word encoding would be wrong")

    def encode(self, texts: list[str]) -> list[bytes]:
        parts = [t.replace("\n", " ").replace("\t", " ").split(" ") for t in texts]
        if len(self.known) > CACHE_WORDS:
            self.known, self.older = {}, self.known
        new = []
        for w in set().union(*parts).difference(self.known):
            ids = self.older.get(w)
            if ids is None:
                new.append(w)
            else:
                self.known[w] = ids
        self._learn(new)
        ids = self.known.__getitem__
        return [b"".join(map(ids, p)) for p in parts]

    def _learn(self, words: list[str]) -> None:
        """Put the words' ids into the cache."""
        left = words
        for digit, mark in self.marks:
            joined, left = [w for w in left if digit not in w], [w for w in left if digit in w]
            blocks = [joined[i : i + JOINED_WORDS] for i in range(0, len(joined), JOINED_WORDS)]
            for block, ids in zip(blocks, self._batch([f" {digit} ".join(b) for b in blocks]), strict=True):
                at = np.flatnonzero(ids == mark).tolist()
                if len(at) != len(block) - 1:  # a word gave the digit after all
                    left += block
                    continue
                raw = ids.tobytes()
                for w, a, b in zip(block, [0, *[4 * i + 4 for i in at]], [*[4 * i for i in at], len(raw)], strict=True):
                    self.known[w] = raw[a:b]
        for w, ids in zip(left, self._batch(left), strict=True):
            self.known[w] = ids.tobytes()

    def _batch(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of every text, little-endian."""
        for i in range(0, len(texts), 4096):
            for e in self.tokenizer.encode_batch_fast(texts[i : i + 4096], add_special_tokens=False):
                yield np.array(e.ids, dtype="<u4")


def _encoder(tokenizer_file: str) -> Encoder:
    if tokenizer_file not in _ENCODERS:
        _ENCODERS[tokenizer_file] = Encoder(tokenizer_file)
    return _ENCODERS[tokenizer_file]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(tokenizer_file: str, capacity: int, with_ids: bool):
    end = np.array([SEPARATOR], dtype="<u4").tobytes()

    def run(batches):
        encoder = _encoder(tokenizer_file)
        for batch in (b.slice(at, ENCODE_ROWS) for b in batches for at in range(0, b.num_rows, ENCODE_ROWS)):
            out: list[list] = [[] for _ in range(6)]
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts), strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    row = (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part), part)
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            take = 6 if with_ids else 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out[:take], kinds, strict=False)], names=names[:take])

    return run


# ---------------------------------------------------------------- packing --
class _Histogram:
    """Counts by length with the ordered list of lengths that still have pieces."""

    def __init__(self, counts: dict[int, int]):
        self.count = {k: n for k, n in counts.items() if n}
        self.keys = sorted(self.count)

    def take(self, length: int, n: int) -> None:
        self.count[length] -= n
        if not self.count[length]:
            del self.count[length]
            self.keys.pop(bisect_left(self.keys, length))

    def largest(self, room: int, held: int = 0) -> int:
        """Largest length <= room with a piece left beside one piece of ``held``; 0 if none."""
        i = bisect_left(self.keys, room + 1) - 1
        if i >= 0 and self.keys[i] == held and self.count[held] < 2:
            i -= 1
        return self.keys[i] if i >= 0 else 0

    def smallest(self, n: int, held: int) -> int:
        """Sum of the n smallest pieces beside one of ``held``; huge if there are not n."""
        got: list[int] = []
        for k in self.keys[: n + 1]:
            got += [k] * min(n, self.count[k] - (k == held))
            if len(got) >= n:
                return sum(got[:n])
        return 1 << 60

    def best_two(self, room: int, held: int) -> int:
        """Largest sum <= room of two pieces beside one of ``held``; 0 if none."""
        free = {k: self.count[k] - (k == held) for k in self.keys if k < room}
        keys = [k for k, n in free.items() if n]
        best, lo, hi = 0, 0, len(keys) - 1
        while lo <= hi:
            a, b = keys[lo], keys[hi]
            if a + b > room:
                hi -= 1
                continue
            if a != b or free[a] >= 2:
                best = max(best, a + b)
            lo += 1
        return best


def reduce_instance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Fixed sequences as (lengths, how many), and the histogram that is left."""
    h, fixed = _Histogram(counts), []
    for j in sorted(counts, reverse=True):
        while n := h.count.get(j, 0):
            room = capacity - j
            partner = h.largest(room, j)
            if not partner:
                fixed.append(((j,), n))
                h.take(j, n)
                continue
            alone = partner == room or h.smallest(2, j) > room
            if not alone and (h.smallest(3, j) <= room or partner < h.best_two(room, j)):
                break
            # The same partner stays right until it runs out: fewer pieces only take choices away.
            m = n // 2 if partner == j else min(n, h.count[partner])
            fixed.append(((j, partner), m))
            h.take(j, m)
            h.take(partner, m)
    return fixed, dict(h.count)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over a histogram: sequences as (lengths, how many)."""
    open_by_room: dict[int, list[list]] = defaultdict(list)  # room -> [pattern, how many]
    rooms: list[int] = []
    done: list[tuple[tuple[int, ...], int]] = []

    def put(pattern: tuple[int, ...], room: int, n: int) -> None:
        if room == 0:
            done.append((pattern, n))
            return
        if not open_by_room[room]:
            insort(rooms, room)
        open_by_room[room].append([pattern, n])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            i = bisect_left(rooms, length)
            if i == len(rooms):  # nothing open takes it: new sequences, as full of this length as they get
                each = min(left, capacity // length)
                n = left // each
                put((length,) * each, capacity - each * length, n)
                left -= n * each
                continue
            room = rooms[i]
            group = open_by_room[room][-1]
            each = room // length  # best fit stays with a sequence it has made tighter while pieces fit
            each = min(each, left)
            n = min(group[1], left // each)
            group[1] -= n
            if not group[1]:
                open_by_room[room].pop()
                if not open_by_room[room]:
                    rooms.pop(i)
            put(group[0] + (length,) * each, room - each * length, n)
            left -= n * each
    for room in rooms:
        done += [(pattern, n) for pattern, n in open_by_room[room]]
    return done


def pack(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """All sequences of an instance as (lengths in order, how many such sequences)."""
    fixed, rest = reduce_instance(counts, capacity)
    return fixed + best_fit(rest, capacity)


def _places(patterns) -> dict[int, np.ndarray]:
    """Per length, rows (first rank, first sequence id, offset) by rank."""
    out, used, sequence = defaultdict(list), defaultdict(int), 0
    for lengths, n in patterns:
        offset = 0
        for length in lengths:
            out[length].append((used[length], sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    return {k: np.array(v, dtype=np.int64) for k, v in out.items()}


def _place(places):
    def run(batches):
        table = places.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for k in np.unique(length):
                at = np.flatnonzero(length == k)
                rows = table[int(k)]
                i = np.searchsorted(rows[:, 0], rank[at], side="right") - 1
                sequence[at] = rows[i, 1] + rank[at] - rows[i, 0]
                offset[at] = rows[i, 2]
            kept = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in kept] + [pa.array(sequence), pa.array(offset)], names=[*kept, "sequence_id", "offset"]
            )

    return run


def pack_documents(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its text's ids (null text: none) and one separator; only a
    document longer than the capacity is cut, into pieces of the capacity and a
    last shorter one. ``with_ids`` adds the piece's ids (little-endian 32 bit).
    Every row is a document, repeated ids included; only doc_id and text are
    read; an empty table gives no rows. The tokenizer file must be readable at
    the same path on every executor.
    """
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = PIECES + (", ids binary" if with_ids else "")
    pieces = written(text.mapInArrow(_pieces(tokenizer_file, capacity, with_ids), schema), "pack-pieces")
    # Ranks within a length: by part of a hash, then within the part.
    part = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(PARTS)).cast("int").alias("part")
    pieces = pieces.select("*", part)
    cells = pieces.groupBy("length", "part").agg(F.count("*").alias("k"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    cells = written(cells.withColumn("base", F.coalesce(F.sum("k").over(before), F.lit(0))), "pack-cells")
    # At most `capacity` rows, whatever the input.
    counts = {r["length"]: r["k"] for r in cells.groupBy("length").agg(F.sum("k").alias("k")).collect()}
    places = docs.sparkSession.sparkContext.broadcast(_places(pack(counts, capacity)))
    own = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        pieces.withColumn("r", F.row_number().over(own) - 1)
        .join(F.broadcast(cells.select("length", "part", "base")), ["length", "part"])
        .withColumn("rank", F.col("base") + F.col("r"))
        .select(*[c for c in pieces.columns if c != "part"], "rank")
    )
    return ranked.mapInArrow(_place(places), schema + ", sequence_id long, offset long")
