"""Repeated 100-byte strings against a dictionary of every window."""

import hashlib
import random

import numpy as np
import pytest

from tagweave.llm import suffix_dedup
from tagweave.llm.queries import op5_suffix_dedup
from tagweave.llm.suffix_dedup import remove_repeated_strings

from .conftest import SF, texts_of


def brute(texts):
    seen, out = set(), {}
    for d in sorted(texts):
        data = (texts[d] or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 99):
            w = data[i : i + 100]
            if w in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out[d] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def result(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}


def test_whole_table(spark):
    want = brute(texts_of(spark, SF))
    assert result(op5_suffix_dedup(spark, SF)) == want and sum(w[1] > 0 for w in want.values()) > 10


def rows_of(seed):
    rng = random.Random(seed)
    word = lambda n: " ".join("".join(rng.choice("abcdé\0") for _ in range(rng.randint(1, 9))) for _ in range(n))
    shared = [word(rng.randint(10, 60)) for _ in range(8)]
    rows = [(0, None, "x"), (1, "", "x"), (2, "a" * 99, "x"), (3, "a" * 100, "x"), (4, "a" * 350, "x"), (5, "ab" * 400, "x")]
    for d in range(6, 90):
        parts = [word(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            cut = rng.randint(0, 40)
            parts += [s[cut:] if rng.random() < 0.5 else s, word(rng.randint(0, 10))]
        rows.append((d, rng.choice(["", " "]).join(parts), "x"))
    rows += [(200 + i, rows[20][1], "x") for i in range(5)] + [(300, word(3000) + shared[0] * 3, "x")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "hot"), [(1, 50_000), (2, 3)])
def test_planted_repeats(spark, docs_dir, seed, hot):
    rows = rows_of(seed)
    docs = spark.read.parquet(docs_dir(rows) + "/documents.parquet")
    assert result(remove_repeated_strings(docs, hot_runs=hot)) == brute({d: t for d, t, _ in rows})
    assert remove_repeated_strings(docs.where("false")).collect() == []


def test_repeated_and_null_ids(spark, docs_dir):
    a, b = ("first text " + "".join(random.Random(i).choices("abcdefgh", k=300)) for i in (1, 2))
    rows = [(1, a, "x"), (1, a, "x"), (2, a, "x"), (2, b, "x"), (None, b, "x"), (None, None, "x"), (3, "", "x")]
    docs = spark.read.parquet(docs_dir(rows) + "/documents.parquet")
    found = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"]) for r in remove_repeated_strings(docs).collect())
    n = len(a)
    assert found == [("1", n, 0), ("1", n, n), ("2", n, 0), ("2", n, n), ("3", 0, 0), ("None", 0, 0), ("None", n, n)]


def test_long_text_in_blocks(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 100)
    rng = np.random.default_rng(1)
    data = rng.integers(97, 123, 5000).astype(np.uint8)
    chunk = suffix_dedup.chunks(__import__("pyarrow").array([data.tobytes().decode()]))
    windows = []
    for first, shift, part, offsets in suffix_dedup._blocks(next(chunk)):
        _, start, size, _, _ = suffix_dedup.runs_of(part, offsets)
        windows += [s + shift + i for s, n in zip(start, size, strict=True) for i in range(n)]
    assert windows == list(range(4901))


def test_family_levels(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "LENGTH", 3)
    rng = np.random.default_rng(2)
    family, seen = suffix_dedup.SuffixFamily(), set()
    for _ in range(60):
        keys = np.array([bytes(x) for x in rng.integers(97, 105, (rng.integers(1, 40), 3)).astype(np.uint8)], dtype="S3")
        for k, again in zip(keys.tolist(), family.add(keys).tolist(), strict=True):
            assert again == (k in seen)
            seen.add(k)
        sizes = [len(x) for x in family.levels]
        assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:], strict=False)) and sum(sizes) == len(seen)
