"""Scores of texts under a hashed maximum-entropy language model.

The probability of a token is factored by class: p(class | history) times
p(token | class). Classes: the end of a text, the ``TOP_CLASSES`` most frequent
words, one class each, and ``SUFFIX_CLASSES`` hashes of a word's last two bytes
for all others. Classes stand in groups of ``GROUP``, and p(class | history) is
p(group | history) times p(class | group, history), each a softmax over hashed features of the
history: the word before, the word before that (skip), and both (n-gram). So a
token takes two softmaxes of ``GROUP`` values instead of one over all classes.
p(token | class) comes from the counts of all training words, (c + 1) /
(N_class + V_class + 1), so a class keeps the mass of one unseen word.

Counting covers every training text. The softmax weights start at the class
frequencies and are trained by distributed gradient updates: in each round
every task runs mini-batch AdaGrad over all its texts from the shared weights,
and each weight row is averaged over tasks by how often it was used, as a tree of
``FAN_IN`` tasks a node. (So scores depend a little on how rows fall into tasks.) The counts of the ``HEAD`` most frequent words
and the weights are broadcast (bounded by these parameters); counts of rarer
words are joined, which no frequent word can skew.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import written
from tagweave.llm.hashing import LOWER, chunks, mix, words
from tagweave.llm.langid import held_out

HEAD = 65_536
TOP_CLASSES = 23
SUFFIX_CLASSES = 40
CLASSES = 1 + TOP_CLASSES + SUFFIX_CLASSES
#: Classes in a group, and groups.
GROUP = 8
#: Logits of a feature: those of the groups, then those of each group's classes.
SLOTS = 1 + CLASSES // GROUP
#: Hash buckets of the three feature groups; the last row is the bias.
ROWS = (4096, 4096, 8192)
BIAS = sum(ROWS)
ROUNDS = 1
#: Share of positions, chosen by hash, that a round takes gradients of (1: all).
GRADIENT_SHARE = 1.0
MINI_BATCH = 4096
RATE = 0.1
#: Hash of the token that ends every text.
END = np.uint64(0x5851F42D4C957F2D)
_U64 = np.uint64
_BLOCKS = 64
#: Tasks whose weights are averaged together.
FAN_IN = 32


@dataclass
class Tokens:
    hashes: np.ndarray
    suffix: np.ndarray  # suffix class, -1 for the end
    offsets: np.ndarray  # tokens per text, ends included


def tokens(chunk) -> Tokens:
    """Words of every text and one end."""
    w = words(chunk)
    low = LOWER[chunk.data]
    n, texts = len(w.hashes), len(chunk.rows)
    last = low[w.end - 1].astype(np.uint64)
    before = np.where(w.end - w.start > 1, low[np.maximum(w.end - 2, 0)], 0).astype(np.uint64)
    suffix = (mix(last * _U64(256) + before + _U64(1)) % _U64(SUFFIX_CLASSES)).astype(np.int64)
    offsets = w.offsets + np.arange(texts + 1)
    hashes, classes = np.full(n + texts, END), np.full(n + texts, -1)
    at = np.arange(n) + np.repeat(np.arange(texts), np.diff(w.offsets))
    hashes[at], classes[at] = w.hashes, suffix
    return Tokens(hashes, classes, offsets)


def _count(batches):
    """(h, s, c): token counts of every batch."""
    for batch in batches:
        parts = [tokens(chunk) for chunk in chunks(batch.column(0))]
        if not parts:
            continue
        h, first, c = np.unique(np.concatenate([p.hashes for p in parts]), return_index=True, return_counts=True)
        s = np.concatenate([p.suffix for p in parts])[first]
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(s, pa.int32()), pa.array(c, pa.int64())], names=["h", "s", "c"])


@dataclass
class Model:
    head: np.ndarray  # sorted hashes of the most frequent tokens
    head_log: np.ndarray  # log10(count + 1) of each
    top: np.ndarray  # hashes of the words with a class of their own
    class_log: np.ndarray  # log10(N_class + V_class + 1)
    weights: np.ndarray  # ((BIAS + 1) * SLOTS, GROUP) float32

    def classes(self, t: Tokens) -> np.ndarray:
        out = np.where(t.suffix < 0, 0, t.suffix + 1 + TOP_CLASSES)
        if len(self.top):
            order = np.argsort(self.top)
            at = order[np.minimum(np.searchsorted(self.top[order], t.hashes), len(order) - 1)]
            own = self.top[at] == t.hashes
            out[own & (t.suffix >= 0)] = 1 + at[own & (t.suffix >= 0)]
        return out


def features(t: Tokens) -> np.ndarray:
    """(tokens, 3) weight rows: word before, word before that, both."""
    n = len(t.hashes)
    one, two = np.full(n, END), np.full(n, END)
    one[1:], two[2:] = t.hashes[:-1], t.hashes[:-2]
    first = t.offsets[:-1]
    one[first] = END
    two[first] = END
    second = first + 1
    two[second[second < t.offsets[1:]]] = END
    out = np.empty((n, 3), dtype=np.int64)
    out[:, 0] = (mix(one) % _U64(ROWS[0])).astype(np.int64)
    out[:, 1] = (mix(two + _U64(1)) % _U64(ROWS[1])).astype(np.int64) + ROWS[0]
    out[:, 2] = (mix(one * _U64(3) + mix(two)) % _U64(ROWS[2])).astype(np.int64) + ROWS[0] + ROWS[1]
    return out


def weight_rows(f: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, bias rows, targets) of the two decisions of every token: first all groups, then all classes in their group."""
    slot = np.concatenate([np.zeros(len(y), np.int64), 1 + y // GROUP])
    rows = np.concatenate([f, f]) * SLOTS + slot[:, None]
    return rows, BIAS * SLOTS + slot, np.concatenate([y // GROUP, y % GROUP])


def _softmax_parts(weights: np.ndarray, rows: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(logits less their maximum, sum of their exponentials)."""
    z = weights[rows[:, 0]]
    z += weights[rows[:, 1]]
    z += weights[rows[:, 2]]
    z += weights[bias]
    z -= z.max(axis=1, keepdims=True)
    return z, np.exp(z).sum(axis=1)


def class_log(weights: np.ndarray, f: np.ndarray, y: np.ndarray) -> np.ndarray:
    """ln p(class | history) of every token's class."""
    rows, bias, target = weight_rows(f, y)
    z, total = _softmax_parts(weights, rows, bias)
    both = z[np.arange(len(target)), target] - np.log(total)
    return both[: len(y)] + both[len(y) :]


_COLUMNS = np.arange(GROUP)


def gradient_step(weights: np.ndarray, squares: np.ndarray, used: np.ndarray, f: np.ndarray, y: np.ndarray) -> None:
    """One AdaGrad step on a mini-batch, in place; the step size is kept per weight row."""
    rows, bias, target = weight_rows(f, y)
    z, total = _softmax_parts(weights, rows, bias)
    g = np.exp(z) / total[:, None]
    g[np.arange(len(target)), target] -= 1
    for j in range(3):
        own, at, k = np.unique(rows[:, j], return_inverse=True, return_counts=True)
        summed = np.bincount((at[:, None] * GROUP + _COLUMNS).ravel(), g.ravel(), len(own) * GROUP).reshape(-1, GROUP)
        squares[own] += (summed * summed).mean(axis=1)
        weights[own] -= RATE * summed / np.sqrt(squares[own] + 1e-6)[:, None]
        used[own] += k


def _train(model, share: float):
    """(block, part, used, weights): one task's weights after its texts, in blocks of rows; part: the task's number."""
    limit = _U64(round(share * (1 << 32)))

    def run(batches):
        m = model.value
        weights = m.weights.copy()
        squares = np.full(len(weights), 0.01, dtype=np.float32)
        used = np.zeros(len(weights), dtype=np.float64)
        seen = 0
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                t = tokens(chunk)
                f, y = features(t), m.classes(t)
                place = np.arange(len(y), dtype=np.uint64)
                pick = np.flatnonzero((mix(t.hashes + place * _U64(7919)) >> _U64(32)) < limit)
                for a in range(0, len(pick), MINI_BATCH):
                    at = pick[a : a + MINI_BATCH]
                    gradient_step(weights, squares, used, f[at], y[at])
                seen += len(pick)
        if not seen:
            return
        part = TaskContext.get().partitionId()
        for b, rows in enumerate(_row_blocks()):
            yield pa.RecordBatch.from_arrays(
                [pa.array([b], pa.int32()), pa.array([part], pa.int32()), pa.array([used[rows].tobytes()], pa.binary()),
                 pa.array([weights[rows].tobytes()], pa.binary())],
                names=["block", "part", "used", "weights"],
            )

    return run


def _row_blocks() -> list[slice]:
    """The trained rows (all but the bias') in blocks."""
    n = BIAS * SLOTS
    step = -(-n // _BLOCKS)
    return [slice(b * step, min(n, (b + 1) * step)) for b in range(_BLOCKS)]


def _average(table: pa.Table) -> pa.Table:
    """Rows of one block averaged over some tasks by use; a row no task used keeps its weights."""
    used, mean = None, None
    for u, w in zip(table["used"], table["weights"], strict=True):
        u = np.frombuffer(u.as_py(), np.float64)
        w = np.frombuffer(w.as_py(), np.float32).reshape(-1, GROUP).astype(np.float64)
        if used is None:
            used, mean = u.copy(), w
            continue
        used += u
        mean += (w - mean) * (u / np.maximum(used, 1))[:, None]
    return pa.table({
        "block": table["block"].slice(0, 1), "part": pa.array([table["part"][0].as_py() // FAN_IN], pa.int32()),
        "used": pa.array([used.tobytes()], pa.binary()), "weights": pa.array([mean.astype(np.float32).tobytes()], pa.binary()),
    })


_WEIGHTS = "block int, part int, used binary, weights binary"


def _averaged(trained: DataFrame) -> DataFrame:
    """One row a block, over all tasks: at most ``FAN_IN`` rows meet in a group."""
    trained = written(trained, "lm-weights")
    tasks = (trained.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        trained = trained.groupBy("block", F.floor(F.col("part") / FAN_IN).alias("node")).applyInArrow(_average, _WEIGHTS)
        tasks = -(-tasks // FAN_IN)
        if tasks == 1:
            return trained


def _score(model):
    """Per text: tokens, the head's share of the counts, the class part, and the hashes to look up."""

    def run(batches):
        m = model.value
        for batch in batches:
            keys = batch.column(0)
            for chunk in chunks(batch.column(1)):
                t = tokens(chunk)
                first, last = t.offsets[:-1], t.offsets[1:]
                y, f = m.classes(t), features(t)
                part = np.empty(len(y))
                for a in range(0, len(y), MINI_BATCH):
                    part[a : a + MINI_BATCH] = class_log(m.weights, f[a : a + MINI_BATCH], y[a : a + MINI_BATCH])
                part = part / np.log(10) - m.class_log[y]
                if len(m.head):
                    at = np.minimum(np.searchsorted(m.head, t.hashes), len(m.head) - 1)
                    known = m.head[at] == t.hashes
                    logs = np.where(known, m.head_log[at], 0.0)
                else:
                    known, logs = np.zeros(len(y), bool), np.zeros(len(y))
                per = [np.add.reduceat(x, first) for x in (known.astype(np.int64), logs, part)]  # every text has a token
                left = np.concatenate([[0], np.cumsum(~known)])[t.offsets].astype(np.int32)
                rare = pa.ListArray.from_arrays(pa.array(left), pa.array(t.hashes[~known].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(chunk.rows[0], len(chunk.rows)), pa.array(last - first, pa.int64()), pa.array(per[0], pa.int64()),
                     pa.array(per[1]), pa.array(per[2]), rare],
                    names=["doc_id", "n_tokens", "known", "logs", "part", "rare"],
                )

    return run


def train(texts: DataFrame) -> tuple[DataFrame, Model, int, int]:
    """(counts table (h, s, c), model, N, V) from a table of texts."""
    spark = texts.sparkSession
    counts = written(
        texts.select("text").mapInArrow(_count, "h long, s int, c long").groupBy("h").agg(F.first("s").alias("s"), F.sum("c").alias("c")),
        "lm-counts",
    )
    head = counts.orderBy(F.desc("c"), "h").limit(HEAD).toArrow()
    h, c, s = head["h"].to_numpy().view(np.uint64), head["c"].to_numpy(), head["s"].to_numpy()
    top = h[s >= 0][:TOP_CLASSES]
    per_suffix = {r["s"]: (r["n"], r["v"]) for r in counts.groupBy("s").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()}
    n_class, v_class = np.zeros(CLASSES), np.zeros(CLASSES)
    for k, (n, v) in per_suffix.items():
        n_class[0 if k < 0 else k + 1 + TOP_CLASSES], v_class[0 if k < 0 else k + 1 + TOP_CLASSES] = n, v
    total_n, total_v = int(n_class.sum()), int(v_class.sum())
    for i, (k, n) in enumerate(zip(s[s >= 0][:TOP_CLASSES], c[s >= 0][:TOP_CLASSES], strict=True)):
        n_class[1 + i], v_class[1 + i] = n, 1
        n_class[k + 1 + TOP_CLASSES] -= n
        v_class[k + 1 + TOP_CLASSES] -= 1
    share = ((n_class + 1) / (total_n + CLASSES)).reshape(-1, GROUP)
    weights = np.zeros((BIAS + 1, SLOTS, GROUP), dtype=np.float32)
    weights[BIAS, 0] = np.log(share.sum(axis=1))
    weights[BIAS, 1:] = np.log(share)
    weights = weights.reshape(-1, GROUP)
    order = np.argsort(h)
    model = Model(h[order], np.log10(c[order] + 1.0), top, np.log10(n_class + v_class + 1), weights)
    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast(model)
        trained = texts.select("text").mapInArrow(_train(shared, GRADIENT_SHARE), _WEIGHTS)
        for r in _averaged(trained).select("block", "weights").collect():  # one row a block
            model.weights[_row_blocks()[r["block"]]] = np.frombuffer(r["weights"], np.float32).reshape(-1, GROUP)
    return counts, model, total_n, total_v


def score_documents(docs: DataFrame, modulus: int = 7, remainder: int = 2) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    Learns from the rows whose crc32(doc_id as text) mod ``modulus`` is not
    ``remainder``. Null text is empty and has the end as its only token.
    base_score: sum of log10((c + 1) / (N + V + 1)); score: the model's log10
    probability. Nothing to learn from gives counts of 0. Only doc_id and text
    are read; repeated rows are scored alike; an empty table gives no rows.
    """
    out = held_out(F.col("doc_id"), modulus, remainder)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts, model, total_n, total_v = train(text.where(~out))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, n_tokens long, known long, logs double, part double, rare array<long>"
    scored = written(text.mapInArrow(_score(shared), schema).withColumn("row", F.monotonically_increasing_id()), "lm-scored")
    rare = (
        scored.select("row", F.explode("rare").alias("h")).join(counts.select("h", "c"), "h")
        .groupBy("row").agg(F.count("*").alias("k"), F.sum(F.log10(F.col("c") + 1)).alias("l"))
    )
    logs = F.col("logs") + F.coalesce("l", F.lit(0.0))
    base = np.log10(total_n + total_v + 1.0)
    return scored.drop("rare").join(rare, "row", "left").select(
        "doc_id", out.alias("held_out"), "n_tokens", (F.col("known") + F.coalesce("k", F.lit(0))).alias("n_known"),
        F.lit(total_n).cast("long").alias("train_tokens"), (logs - F.col("n_tokens") * F.lit(float(base))).alias("base_score"),
        (logs + F.col("part")).alias("score"),
    )
