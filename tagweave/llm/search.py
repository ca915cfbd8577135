"""Exact BM25 top-k over an inverted index, with block-max pruning per shard.

Shards are built where the documents are read: each task turns its rows into
inverted indexes of at most ``SHARD_DOCS`` documents and ``SHARD_POSTINGS``
postings (one document's may be more). A task deals its documents out by kind (``Kinds``: like
ones share frequent terms), so that full shards hold one kind; their documents are ordered by kind
and length and split into blocks of ``BLOCK_DOCS``. The collection's counts come from the shards. A query carries the global statistics (idf, mean length), so
scores are equal in every shard and the best k of the shards' best k are the
exact result. A task searches several shards and returns one best k a query.

Within a shard a query's rare terms are read in full; they are few postings.
Its frequent terms (in more than 1 / ``FREQUENT`` of the shard's documents) hold
a maximum per block. Rare scores plus block maxima bound every block. The best-bounded
blocks give a query its first threshold, the k-th best score there (if no earlier
shard of the task gave one); blocks are then opened a slab of neighbours at a time, those that exceed a threshold by most first, for the queries
whose bound there still reaches their threshold, which rises with every slab and
goes on to the task's next shard.
Queries of like size are evaluated together, one matrix product a slab; as many
at a time as ``BATCH_CELLS`` allows, their rare postings ``BATCH_POSTINGS`` at a time,
so a batch of long queries needs no more memory than one of short ones.

Pruning uses 32-bit floats, with a margin for their rounding that grows with the
query's terms; the scores of the last candidates are summed again in 64 bits, in
one order of terms, so ties are exact and go to the smaller doc_id.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagweave.llm.common import written
from tagweave.llm.hashing import chunks, words

K = 10
K1, B = 1.2, 0.75
SHARD_DOCS = 16_384
SHARD_POSTINGS = 1_000_000
BLOCK_DOCS = 32
#: Kinds of documents that get shards of their own, rounds that find them, and postings (of a task's first documents) they are learned from.
KINDS, KIND_ROUNDS, KIND_POSTINGS = 8, 5, 1_000_000
#: Neighbouring blocks opened at a time.
SLAB = 16
FREQUENT = 16
#: Query terms held by one broadcast.
BLOCK_TERMS = 2_000_000
#: Queries held by one broadcast (a task keeps k scores and ids of each).
BLOCK_QUERIES = 100_000
#: Queries evaluated together in a shard.
QUERY_BATCH = 2048
#: Scores (of a query and a document) held by a batch of queries.
BATCH_CELLS = 1 << 22
#: Postings of rare terms, and documents scored by them, held at a time (one query may have more).
BATCH_POSTINGS = 65_536
#: Queries a task writes at a time.
OUT_QUERIES = 10_000
#: Shards are rows of several MB: they are stored in small row groups (sizes are looked at after every
#: row, not after the usual hundred) and read, and handed to Python, one by one, however many a task has.
SHARDS_WRITTEN = {"parquet.block.size": str(16 << 20), "parquet.page.size.row.check.min": "1"}
SHARDS_READ = {"spark.sql.parquet.columnarReaderBatchSize": "1", "spark.sql.execution.arrow.maxRecordsPerBatch": "1"}
#: Texts are handed over a few MB at a time, not tens.
TEXTS_READ = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}
#: Stands for a null id.
NO_ID = -(1 << 63)
#: Unit roundoff of 32-bit floats.
_ROUND = 2.0**-24
#: Which half of a 64-bit word is the low one.
_LOW = 0 if sys.byteorder == "little" else 1


def _by_16_bits(x: np.ndarray, n: int) -> np.ndarray:
    """Stable order of numbers below ``n``: keys of 16 bits are sorted by counting."""
    return np.lexsort([(x >> at).astype(np.uint16) for at in range(0, max(1, n.bit_length()), 16)])


def _counts(chunk):
    """(text, term hash, tf) of a chunk's distinct terms, by text and hash, and words per text."""
    w = words(chunk)
    size = np.diff(w.offsets)
    text = np.repeat(np.arange(len(size)), size)
    order = np.argsort(w.hashes)
    order = order[_by_16_bits(text[order], len(size))]
    h, text = w.hashes[order], text[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    return text[first], h[first], np.diff(np.append(first, len(h))), size


def _statistics(batches):
    """(h, df) of every shard, and one row without h that counts its documents (df) and words."""
    for batch in batches:
        for length, terms, df in zip(*batch.columns, strict=True):
            length, h, df = np.frombuffer(length.as_buffer(), np.int32), np.frombuffer(terms.as_buffer(), np.int64), np.frombuffer(df.as_buffer(), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([pa.array(h), pa.array([None], pa.int64())]),
                    pa.array(np.append(df, len(length))),
                    pa.array(np.append(np.zeros(len(h), np.int64), length.sum(dtype=np.int64))),
                ],
                names=["h", "df", "words"],
            )


def _ids(column: pa.Array) -> np.ndarray:
    """Ids as 64-bit integers, null as ``NO_ID`` (floats would round them)."""
    return column.fill_null(NO_ID).to_numpy(zero_copy_only=False)


def _id_or_null(name: str):
    return F.when(F.col(name) != NO_ID, F.col(name))


def _terms(batches):
    """(q, h) rows: the distinct terms of every query."""
    for batch in batches:
        q = _ids(batch.column(0))
        for chunk in chunks(batch.column(1)):
            text, h, _, _ = _counts(chunk)
            yield pa.RecordBatch.from_arrays([pa.array(q[chunk.rows[0] + text]), pa.array(h.view(np.int64))], names=["q", "h"])


class Kinds:
    """Documents that share frequent terms, told apart by spherical k-means over some of them.

    Only decides which documents share a shard and a block: like ones keep a maximum near their scores.
    """

    def __init__(self, text: np.ndarray, h: np.ndarray, n: int):
        terms, df = np.unique(h, return_counts=True)
        self.terms = terms[df * FREQUENT > n]
        has = self._has(text, h, n)
        has /= np.sqrt(np.maximum(1, has.sum(axis=1)))[:, None]
        self.centre = has[np.linspace(0, n - 1, KINDS).astype(np.int64)]
        for _ in range(KIND_ROUNDS):
            kind = (has @ self.centre.T).argmax(axis=1)
            self.centre = (kind == np.arange(KINDS)[:, None]).astype(np.float32) @ has
            self.centre /= np.maximum(1e-9, np.sqrt((self.centre * self.centre).sum(axis=1)))[:, None]

    def _has(self, text: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
        has = np.zeros((n, len(self.terms)), np.float32)
        if len(self.terms):
            at = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
            some = np.flatnonzero(self.terms[at] == h)
            has[text[some], at[some]] = 1
        return has

    def of(self, text: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
        """The kind of each of ``n`` texts."""
        return (self._has(text, h, n) @ self.centre.T).argmax(axis=1)


INDEX = "ids binary, length binary, terms binary, df binary, post binary, tf binary"


class Filling:
    """A shard that takes documents until it is full."""

    def __init__(self):
        self.docs, self.postings, self.n, self.held = [], [], 0, 0

    def add(self, ids: np.ndarray, kind: np.ndarray, size: np.ndarray, text: np.ndarray, h: np.ndarray, tf: np.ndarray):
        """Take documents and their postings (by text); yields every shard that they fill."""
        ends = np.searchsorted(text, np.arange(len(ids)), side="right")  # postings up to each text
        a = 0
        while a < len(ids):
            lo = int(ends[a - 1]) if a else 0
            fit = int(np.searchsorted(ends, lo + SHARD_POSTINGS - self.held, side="right"))
            b = min(len(ids), a + SHARD_DOCS - self.n, fit)
            if b <= a:
                if self.n:
                    yield self.taken()
                    continue
                b = a + 1
            hi = int(ends[b - 1])
            self.docs.append((ids[a:b], kind[a:b], size[a:b]))
            tf_type = np.min_scalar_type(int(tf[lo:hi].max(initial=0)))
            self.postings.append(((text[lo:hi] - a + self.n).astype(np.uint16), h[lo:hi].copy(), tf[lo:hi].astype(tf_type)))
            self.n, self.held, a = self.n + b - a, self.held + hi - lo, b

    def given_back(self) -> tuple[np.ndarray, ...]:
        """What was taken, as :meth:`add` takes it; nothing is left."""
        found = tuple(np.concatenate(x) for part in (self.docs, self.postings) for x in zip(*part, strict=True))
        self.__init__()
        return found

    def taken(self) -> pa.RecordBatch:
        """One row of packed arrays, its documents by kind and length; nothing is left."""
        ids, kind, size, text, h, tf = self.given_back()
        order = np.argsort(h)
        new = np.diff(h[order], prepend=~h[order][:1]) != 0
        first = np.flatnonzero(new)
        terms, term = h[order][first], np.empty(len(h), np.int64)
        term[order] = np.cumsum(new) - 1
        in_order = np.lexsort((size, kind))
        place = np.empty(len(ids), np.int64)
        place[in_order] = np.arange(len(ids))
        doc = place[text].astype(np.uint16)
        order = np.argsort(doc, kind="stable")
        order = order[_by_16_bits(term[order], len(first))]
        arrays = (
            ids[in_order], size[in_order].astype(np.int32), terms, np.diff(np.append(first, len(h))),
            doc[order], tf[order],
        )
        return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in arrays], names=[c.split()[0] for c in INDEX.split(", ")])


def _index(batches):
    """One row of packed arrays per shard, full ones of one kind of documents each.

    The kinds are learned from the first documents; what is left of all kinds in the end shares shards.
    """
    kinds, waiting, held = None, [], 0
    shards = [Filling() for _ in range(KINDS)]

    def dealt():
        nonlocal kinds, held
        if kinds is None:
            first = np.append(0, np.cumsum([len(ids) for ids, *_ in waiting]))
            kinds = Kinds(np.concatenate([x[2] + a for x, a in zip(waiting, first[:-1], strict=True)]), np.concatenate([x[3] for x in waiting]), int(first[-1]))
        for ids, size, text, h, tf in waiting:
            kind = kinds.of(text, h, len(ids))
            for i in np.unique(kind).tolist():
                some = kind == i
                own = some[text]
                yield from shards[i].add(ids[some], kind[some], size[some], (np.cumsum(some) - 1)[text[own]], h[own], tf[own])
        waiting.clear()
        held = 0

    for batch in batches:
        keys = _ids(batch.column(0))
        for chunk in chunks(batch.column(1)):
            text, h, tf, size = _counts(chunk)
            waiting.append((keys[chunk.rows], size, text, h, tf))
            held += len(h) + len(size)
            if kinds or held > KIND_POSTINGS:
                yield from dealt()
    if waiting:
        yield from dealt()
    last = Filling()
    for shard in shards:
        if shard.n:
            yield from last.add(*shard.given_back())
    if last.n:
        yield last.taken()


def _spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of several spans, one after another."""
    end = np.cumsum(size)
    out = np.repeat(start - end + size, size)
    out += np.arange(len(out))
    return out


def _block_max(x: np.ndarray) -> np.ndarray:
    """The maximum of every block of documents, for each of several rows of all documents."""
    most, left = x.ravel(), BLOCK_DOCS
    while left % 2 == 0:  # pairs in long runs: faster than a reduction of short rows
        most, left = np.maximum(most[::2], most[1::2]), left // 2
    return most.reshape(len(x), x.shape[1] // BLOCK_DOCS, left).max(axis=2)


class Shard:
    """One shard's index, opened for queries; ``row``: its arrays' bytes or buffers, by column."""

    def __init__(self, row: dict, mean: float):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.terms, self.df = np.frombuffer(row["terms"], np.uint64), np.frombuffer(row["df"], np.int64)
        self.ptr = np.append(0, np.cumsum(self.df))
        self.post = post = np.frombuffer(row["post"], np.uint16)
        tf = np.frombuffer(row["tf"], f"u{max(1, 2 * len(row['tf']) // max(1, len(row['post'])))}")  # as wide as its largest count needs
        self.norm = K1 * (1 - B + B * np.frombuffer(row["length"], np.int32) / max(mean, 1e-9))
        impact = (tf * (K1 + 1) / (tf + self.norm[post])).astype(np.float32)
        self.postings = (post.astype(np.int64) << 32) + impact.view(np.uint32)  # both in one word: looked up at once
        n = len(self.ids)
        self.blocks = -(-n // BLOCK_DOCS)
        frequent = np.flatnonzero(self.df * FREQUENT > n)
        self.dense_row = np.full(len(self.terms), -1)
        self.dense_row[frequent] = np.arange(len(frequent))
        self.dense = np.zeros((self.blocks * BLOCK_DOCS, len(frequent)), np.float32)
        place = _spans(self.ptr[frequent], self.df[frequent])
        self.dense[post[place], np.repeat(np.arange(len(frequent)), self.df[frequent])] = impact[place]
        self.blocked = self.dense.reshape(self.blocks, BLOCK_DOCS, len(frequent))
        self.block_max = np.ascontiguousarray(self.blocked.max(axis=1).T)
        by_doc = np.argsort(post, kind="stable")  # a document's terms, by hash
        self.doc_ptr = np.append(0, np.cumsum(np.bincount(post, minlength=n)))
        self.doc_term = np.repeat(np.arange(len(self.terms), dtype=np.int32), self.df)[by_doc]
        self.doc_tf = tf[by_doc]

    def find(self, h: np.ndarray) -> np.ndarray:
        """Place of every one of distinct, ascending terms (hashes) in the shard's terms, -1 if it has none."""
        place = np.full(len(h), -1, np.int32)
        if len(h):
            at = np.minimum(np.searchsorted(h, self.terms), len(h) - 1)
            known = np.flatnonzero(h[at] == self.terms)
            place[at[known]] = known
        return place

    def top(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, floors: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """(doc_id, score) of the best k for each of a few queries (hashes ascending, idf)."""
        if not queries:
            return []
        ptr = np.append(0, np.cumsum([len(h) for h, _ in queries])).astype(np.int64)
        place, idf = np.concatenate([self.find(h) for h, _ in queries]), np.concatenate([idf for _, idf in queries])
        q, ids, score = self.best(place, idf, np.arange(len(place)), ptr, k, floors)
        order = np.lexsort((ids, -score, q))
        ends = np.searchsorted(q[order], np.arange(len(queries) + 1))
        return [(ids[one], score[one]) for one in (order[a:b][:k] for a, b in zip(ends[:-1], ends[1:], strict=True))]

    def best(
        self, place: np.ndarray, idf: np.ndarray, term: np.ndarray, ptr: np.ndarray, k: int, floors: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, doc_id, score) of all documents that can be among the best k of their query, in no order.

        Terms have a place here (-1: none) and a weight; query i has the terms numbered ``term[ptr[i]:ptr[i + 1]]``, by
        hash ascending. ``floors``: scores below which a document of this shard cannot be among a query's
        best k, as k documents of other shards reach them; such documents may be left out.
        """
        n = len(ptr) - 1
        floors = np.zeros(n) if floors is None else floors
        scratch = np.zeros(len(self.terms), bool), np.zeros(len(self.terms))  # the terms of the query at hand, and their weights
        self.opened, out = 0.0, [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        step = max(1, min(QUERY_BATCH, BATCH_CELLS // max(1, self.blocks * BLOCK_DOCS)))
        for a in range(0, n, step):
            b = min(a + step, n)
            some = term[ptr[a] : ptr[b]]
            at = place[some]
            here = np.flatnonzero(at >= 0)
            if len(here):
                ends = np.searchsorted(here, ptr[a : b + 1] - ptr[a])
                q, ids, score = self._batch(at[here], idf[some[here]], ends, k, floors[a:b], scratch)
                out.append((a + q, ids, score))
        self.opened /= max(1, n)  # share of a query's blocks that were opened for it
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def _rare(self, t: np.ndarray, w: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
        """Scores of all documents by the rare terms ``t`` of ``n`` queries, term i being of query ``of[i]``."""
        wide = self.blocks * BLOCK_DOCS
        score = np.zeros(n * wide, np.float32)
        size = self.df[t]
        ends = np.searchsorted(of, np.arange(n + 1))
        held = np.append(0, np.cumsum(size))[ends] + wide * np.arange(n + 1)
        a = 0
        while a < n:  # so many queries that their postings stay in the processor's cache
            b = max(a + 1, int(np.searchsorted(held, held[a] + BATCH_POSTINGS, side="right")) - 1)
            some = slice(ends[a], ends[b])
            each = size[some]
            postings = self.postings[_spans(self.ptr[t[some]], each)]
            value = np.repeat(w[some], each)
            value *= postings.view(np.float32)[_LOW::2]
            postings >>= 32
            postings += np.repeat(of[some] * wide, each)
            np.add.at(score, postings, value)
            a = b
        return score.reshape(n, wide)

    def _exact(self, q: np.ndarray, docs: np.ndarray, t: np.ndarray, w: np.ndarray, ends: np.ndarray, scratch: tuple) -> np.ndarray:
        """64-bit scores of a few documents (of ascending queries), each summed term by term in hash order."""
        asked, weight_of = scratch
        first = np.flatnonzero(np.diff(q, prepend=-1))
        begin, end = self.doc_ptr[docs].tolist(), self.doc_ptr[docs + 1].tolist()
        places, weights = [], []
        for i, lo, hi in zip(q[first].tolist(), first.tolist(), np.append(first[1:], len(q)).tolist(), strict=True):
            own = t[ends[i] : ends[i + 1]]
            asked[own], weight_of[own] = True, w[ends[i] : ends[i + 1]]
            for one in range(lo, hi):
                term = self.doc_term[begin[one] : end[one]]
                here = np.flatnonzero(asked[term])
                weights.append(weight_of[term[here]])
                here += begin[one]
                places.append(here)
            asked[own] = False
        if not places:
            return np.zeros(0)
        of = np.repeat(np.arange(len(docs)), [len(x) for x in places])
        tf, norm = self.doc_tf[np.concatenate(places)].astype(np.float64), self.norm[docs][of]
        return np.bincount(of, weights=np.concatenate(weights) * (tf * (K1 + 1) / (tf + norm)), minlength=len(docs))

    def _batch(self, t: np.ndarray, w: np.ndarray, ends: np.ndarray, k: int, floors: np.ndarray, scratch: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """:meth:`best` of a few queries, with the places ``t`` of the terms known here; their ends are ``ends``."""
        n, wide = len(floors), self.blocks * BLOCK_DOCS
        row, of, narrow = self.dense_row[t], np.repeat(np.arange(n), np.diff(ends)), w.astype(np.float32)
        weights = np.zeros((n, self.dense.shape[1]), np.float32)
        common, rare = np.flatnonzero(row >= 0), np.flatnonzero(row < 0)
        weights[of[common], row[common]] = narrow[common]
        score = self._rare(t[rare], narrow[rare], of[rare], n)
        bound = _block_max(score) + weights @ self.block_max
        # A sum of n rounded positive products is off by at most (n + 4) roundoffs of itself; two sums are compared.
        slack = 1 - 4 * _ROUND * (8 + np.diff(ends))
        # The best-bounded blocks of a query without a threshold: its k-th score there is the least that counts.
        first = min(self.blocks, -(-k // BLOCK_DOCS) + 3)
        least = floors.copy()
        for i in np.flatnonzero(floors <= 0):  # else k documents of other shards
            blocks = np.argpartition(-bound[i], first - 1)[:first]
            found = score[i].reshape(self.blocks, BLOCK_DOCS)[blocks] + self.blocked[blocks] @ weights[i]
            if k <= found.size:
                least[i] = max(least[i], np.partition(found.ravel(), found.size - k)[found.size - k])
        top = np.zeros((n, k), np.float32)  # best scores of the opened blocks
        chosen = []
        slabs = np.arange(0, self.blocks, SLAB)  # neighbours are alike: much the same queries need them
        above = np.maximum.reduceat((bound - least[:, None]).max(axis=0), slabs)
        for slab in slabs[np.argsort(-above, kind="stable")].tolist():
            some = bound[:, slab : slab + SLAB]
            need = (some > 0) & (some >= (least * slack)[:, None])
            who, blocks = np.flatnonzero(need.any(axis=1)), slab + np.flatnonzero(need.any(axis=0))
            if not len(who):
                continue
            self.opened += len(who) * len(blocks) / self.blocks
            docs = slice(blocks[0] * BLOCK_DOCS, blocks[-1] * BLOCK_DOCS + BLOCK_DOCS)
            if len(blocks) * BLOCK_DOCS < docs.stop - docs.start:
                docs = (blocks[:, None] * BLOCK_DOCS + np.arange(BLOCK_DOCS)).ravel()
            found = weights[who] @ self.dense[docs].T
            found += score[who, docs] if isinstance(docs, slice) else score[who[:, None], docs]
            hit = np.flatnonzero(found >= (least * slack)[who, None].astype(np.float32))
            if not len(hit):
                continue
            one, doc = np.divmod(hit, found.shape[1])
            some = np.flatnonzero(np.bincount(one, minlength=len(who)))
            both = np.concatenate([top[who[some]], found[some]], axis=1)
            top[who[some]] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
            least = np.maximum(least, top.min(axis=1))
            value = found.ravel()[hit]
            keep = np.flatnonzero((value > 0) & (value >= (least * slack)[who[one]]))
            doc = doc[keep] + docs.start if isinstance(docs, slice) else docs[doc[keep]]
            chosen.append((who[one[keep]], doc, value[keep]))
        if not chosen:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        q, doc, value = (np.concatenate(x) for x in zip(*chosen, strict=True))
        keep = np.flatnonzero(value >= (least * slack)[q])
        keep = keep[np.argsort(q[keep], kind="stable")]
        q, doc = q[keep], doc[keep]
        return q, self.ids[doc], self._exact(q, doc, t, w, ends, scratch)


def _merge(best: np.ndarray, ids: np.ndarray, q: np.ndarray, doc: np.ndarray, score: np.ndarray) -> None:
    """Put (query, doc_id, score) rows into every query's best, a row of ``best`` and ``ids`` each."""
    k = best.shape[1]
    hit = np.unique(q)
    q = np.concatenate([np.repeat(hit, k), q])
    score, doc = np.concatenate([best[hit].ravel(), score]), np.concatenate([ids[hit].ravel(), doc])
    order = np.lexsort((doc, -score, q))
    order = order[np.searchsorted(q[order], hit)[:, None] + np.arange(k)]
    best[hit], ids[hit] = score[order], doc[order]


def _search(queries, mean: float, k: int):
    def run(batches):
        q, ptr, terms, idf, term = queries.value
        best, ids = np.zeros((len(q), k)), np.zeros((len(q), k), np.int64)  # every query's best in the task's shards so far
        for batch in batches:
            for at in range(batch.num_rows):
                shard = None  # gone before the next is opened
                shard = Shard({name: column[at].as_buffer() for name, column in zip(batch.schema.names, batch.columns, strict=True)}, mean)
                place = shard.find(terms)  # a term is looked up once, however many queries have it
                _merge(best, ids, *shard.best(place, idf, term, ptr, k, best.min(axis=1)))
        for a in range(0, len(q), OUT_QUERIES):  # a row per task, query and rank, however many shards the task had
            some = slice(a, a + OUT_QUERIES)
            row, column = np.nonzero(best[some] > 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(q[some][row]), pa.array(ids[some][row, column]), pa.array(best[some][row, column])],
                names=["q", "doc_id", "score"],
            )

    return run


def search(queries: DataFrame, docs: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, doc_id, score): the k best documents of every query.

    ``queries``: query_id, text. A query is the set of its words. Score: BM25
    with idf ln(1 + (N - df + 0.5) / (df + 0.5)); a document without a word of
    the query is no result, so a null or empty query or text finds or is
    nothing. Ties go to the smaller doc_id; repeated rows are documents of
    their own. A null id (of a query or document) is null in the result and comes before
    all others; -2^63 stands for it inside and is no id. Only the named columns and docs' doc_id and text are read.
    """
    spark = docs.sparkSession
    cores = spark.sparkContext.defaultParallelism
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    few = text.withColumn("part", F.spark_partition_id()).coalesce(cores)  # a task a core: its shards are full; a column more, or it would undo a coalesce of docs
    index = written(few.mapInArrow(_index, INDEX), "search-index", SHARDS_WRITTEN | TEXTS_READ)
    counts = written(
        index.select("length", "terms", "df").mapInArrow(_statistics, "h long, df long, words long").groupBy("h").agg(F.sum("df").alias("df"), F.sum("words").alias("words")),
        "search-statistics",
        SHARDS_READ,
    )
    corpus = counts.where("h is null").first()
    n, mean = (corpus["df"], corpus["words"] / corpus["df"]) if corpus else (0, 0.0)
    terms = queries.select(F.col("query_id").cast("long").alias("q"), "text").mapInArrow(_terms, "q long, h long").distinct()
    weighted = written(
        terms.join(counts.where("h is not null"), "h").select("q", "h", F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf")),
        "search-queries",
    )
    asked = weighted.agg(F.count("*").alias("terms"), F.count_distinct("q").alias("queries")).first()
    parts = max(1, -(-asked["terms"] // BLOCK_TERMS), -(-asked["queries"] // BLOCK_QUERIES))
    found = None
    for part in range(parts):  # each part's terms fit one broadcast; a task a core: its shards share thresholds and one result
        rows = weighted.where(F.pmod(F.xxhash64("q"), F.lit(parts)) == part).toArrow()
        if not len(rows) and (found is not None or part + 1 < parts):
            continue
        q, h, idf = rows["q"].to_numpy(), rows["h"].to_numpy().view(np.uint64), rows["idf"].to_numpy()
        _, size_of, size = np.unique(q, return_inverse=True, return_counts=True)
        order = np.lexsort((h, q, size[size_of]))  # queries of like size stand together
        new = np.flatnonzero(np.diff(q[order], prepend=q[order][:1] - 1))
        distinct, first, term = np.unique(h, return_index=True, return_inverse=True)
        shared = spark.sparkContext.broadcast((q[order][new], np.append(new, len(q)), distinct, idf[first], term[order].astype(np.int32)))
        best = written(index.coalesce(cores).mapInArrow(_search(shared, mean, k), "q long, doc_id long, score double"), "search-best", SHARDS_READ)
        found = best if found is None else found.unionByName(best)
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "doc_id"))
    ranked = found.select(_id_or_null("q").alias("query_id"), rank.alias("rank"), _id_or_null("doc_id").alias("doc_id"), "score")
    return ranked.where(F.col("rank") <= k)
