"""Language model: the base score by plain counting, a proper distribution, held-out gain."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from tagweave.llm import lm
from tagweave.llm.hashing import chunks
from tagweave.llm.queries import op6_lm_score

from .conftest import SF_BIG, texts_of


def words_of(text):
    return [*(text or "").encode().lower().split(), None]


def base(texts):
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    c = Counter(w for d, t in texts.items() if not held[d] for w in words_of(t))
    n, v = sum(c.values()), len(c)
    return {
        d: (held[d], len(words_of(t)), sum(c[w] > 0 for w in words_of(t)), n,
            sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words_of(t)))
        for d, t in texts.items()
    }


def same(rows, want):
    assert len(rows) == len(want)
    for r in rows:
        w = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:4]
        assert math.isclose(r["base_score"], w[4], rel_tol=1e-9, abs_tol=1e-9) and r["score"] <= 0


def test_whole_table_and_held_out_gain(spark, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", 500)
    rows = op6_lm_score(spark, SF_BIG).collect()
    same(rows, base(texts_of(spark, SF_BIG)))
    held = [r for r in rows if r["held_out"]]
    print("gain", 1 - sum(r["score"] for r in held) / sum(r["base_score"] for r in held))
    assert sum(r["score"] for r in held) > 0.99 * sum(r["base_score"] for r in held)
    assert np.mean([r["score"] > r["base_score"] for r in held]) > 0.9


def test_edges(spark, docs_dir):
    rows = [(0, None, "x"), (1, "", "x"), (2, " \n", "x"), (3, "A b a", "x"), (4, "É é", "x"), (5, "word " * 50_000, "x"), (6, "z", "x")]
    docs = spark.read.parquet(docs_dir(rows) + "/documents.parquet")
    same(lm.score_documents(docs).collect(), base({d: t for d, t, _ in rows}))
    assert lm.score_documents(docs.where("false")).collect() == []
    same(lm.score_documents(docs, modulus=1, remainder=0).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect(),
         {d: (True, len(words_of(t)), 0, 0, 0.0) for d, t, _ in rows})


def test_distribution_sums_to_one(spark):
    texts = spark.createDataFrame([("a b a c",), ("b a the end",), ("the a b",)], "text string")
    counts, model, n, v = lm.train(texts)
    vocabulary = {r["h"]: (r["s"], r["c"]) for r in counts.collect()}
    assert (n, v) == (14, 6)
    hashes = np.array(list(vocabulary), dtype=np.int64).view(np.uint64)
    suffix = np.array([s for s, _ in vocabulary.values()])
    t = lm.tokens(next(chunks(pa.array(["the a q"]))))
    for at in range(len(t.hashes)):
        z = lm.class_log(model.weights, np.repeat(lm.features(t)[at : at + 1], lm.CLASSES, axis=0), np.arange(lm.CLASSES))
        assert math.isclose(np.exp(z).sum(), 1, rel_tol=1e-5)
        y = model.classes(lm.Tokens(hashes, suffix, np.array([0, len(hashes)])))
        known = sum(math.exp(z[k]) * (c + 1) / 10 ** model.class_log[k] for k, (_, c) in zip(y, vocabulary.values(), strict=True))
        # A class's denominator is N + V + 1: its known words and one unseen.
        unseen = sum(math.exp(z[k]) / 10 ** model.class_log[k] for k in range(lm.CLASSES))
        assert math.isclose(known + unseen, 1, rel_tol=1e-5)


def plain_update(w, squares, f, y):
    """One mini-batch, value by value: w[row][slot] is a list of GROUP logits."""
    total = {}
    for rows, k in zip(f, y, strict=True):
        for slot, target in ((0, k // lm.GROUP), (1 + k // lm.GROUP, k % lm.GROUP)):
            z = [sum(w[r][slot][c] for r in rows) + w[lm.BIAS][slot][c] for c in range(lm.GROUP)]
            e = [math.exp(v) for v in z]
            for j, r in enumerate(rows):
                grad = total.setdefault((j, r, slot), [0.0] * lm.GROUP)
                for c in range(lm.GROUP):
                    grad[c] += e[c] / sum(e) - (c == target)
    for (_, r, slot), grad in total.items():
        squares[r, slot] = squares.get((r, slot), 0.01) + sum(v * v for v in grad) / lm.GROUP
        for c in range(lm.GROUP):
            w[r][slot][c] -= lm.RATE * grad[c] / math.sqrt(squares[r, slot] + 1e-6)


def test_score_by_plain_updates_on_one_task(spark, monkeypatch):
    monkeypatch.setattr(lm, "MINI_BATCH", 7)
    texts = ["the cat sat on the mat", "the dog sat on the cat and the mat", "a b a c the end", "dog on mat"] * 3
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    rows = {r["doc_id"]: r for r in lm.score_documents(docs, modulus=1, remainder=5).collect()}  # learns from all

    t = lm.tokens(next(chunks(pa.array(texts))))
    _, full, n, _ = lm.train(docs.select("text"))
    assert n == len(t.hashes)
    f, y = lm.features(t).tolist(), full.classes(t).tolist()
    bias = full.weights.reshape(-1, lm.SLOTS, lm.GROUP)[lm.BIAS].astype(float).tolist()
    w = {r: [[0.0] * lm.GROUP for _ in range(lm.SLOTS)] for rs in f for r in rs} | {lm.BIAS: bias}
    squares = {}
    for a in range(0, len(y), 7):
        plain_update(w, squares, f[a : a + 7], y[a : a + 7])
    counts = Counter(h for h in t.hashes.tolist())
    for i in range(len(texts)):
        score = 0.0
        for at in range(t.offsets[i], t.offsets[i + 1]):
            k = y[at]
            for slot, target in ((0, k // lm.GROUP), (1 + k // lm.GROUP, k % lm.GROUP)):
                z = [sum(w[r][slot][c] for r in f[at]) + bias[slot][c] for c in range(lm.GROUP)]
                score += (z[target] - math.log(sum(map(math.exp, z)))) / math.log(10)
            score += math.log10(counts[int(t.hashes[at])] + 1) - full.class_log[k]
        assert math.isclose(rows[i]["score"], score, rel_tol=1e-4), i


def test_averages_as_a_tree(spark, monkeypatch):
    monkeypatch.setattr(lm, "FAN_IN", 3)
    rng = np.random.default_rng(3)
    used = rng.integers(0, 4, (20, 5)).astype(np.float64)
    used[:, 4] = 0
    weights = rng.normal(size=(20, 5, lm.GROUP)).astype(np.float32)
    weights[:, 4] = 0.5  # used by no task, so alike in all
    rows = [(0, i, bytearray(used[i].tobytes()), bytearray(weights[i].tobytes())) for i in range(20)]
    out = lm._averaged(spark.createDataFrame(rows, lm._WEIGHTS)).collect()
    got = np.frombuffer(out[0]["weights"], np.float32).reshape(5, lm.GROUP)
    share = used / np.maximum(used.sum(axis=0), 1)
    want = (weights * share[:, :, None]).sum(axis=0)
    want[4] = 0.5
    assert len(out) == 1 and np.allclose(got, want, atol=1e-5)
