"""The Jaccard join against brute force over all pairs that share a shingle."""

import random
from collections import defaultdict

import pytest

from tagweave.llm.jaccard import jaccard_components
from tagweave.llm.queries import op10_jaccard_join

from .conftest import SF_BIG, texts_of


def shingle_set(text):
    w = (text or "").encode().lower().split()
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(texts):
    sets = {d: shingle_set(t) for d, t in texts.items()}
    where = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            where[x].append(d)
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    pairs = {(a, b) for ds in where.values() for a in ds for b in ds if a < b}
    for a, b in pairs:
        k = len(sets[a] & sets[b])
        if 100 * k >= 75 * (len(sets[a]) + len(sets[b]) - k):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {d: (len(sets[d]), root(d)) for d in sets}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_whole_table(spark):
    got = result(op10_jaccard_join(spark, SF_BIG))
    want = brute(texts_of(spark, SF_BIG))
    assert got == want
    assert sum(c != d for d, (_, c) in want.items()) > 50


def near_copies(seed):
    """Chains of edited copies around the similarity bound, a hot passage, edge texts."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    hot = [rng.choice(vocab) for _ in range(30)]
    rows, i = [(0, None, "x"), (1, "", "x"), (2, " \t\n", "x"), (3, "a B c", "x"), (4, "A b C", "x"), (5, "a b", "x")], 6
    for _ in range(12):
        base = [rng.choice(vocab) for _ in range(rng.randint(5, 120))] + hot * rng.randint(0, 1)
        for _ in range(rng.randint(1, 12)):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((i, rng.choice([" ", "\n", "\t "]).join(w), "x"))
            i += 1
            if rng.random() < 0.3:
                base = w  # drift: chains whose ends are not linked directly
    rows.append((i, "long " * 20000 + "tail", "x"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_edited_copies_and_edges(spark, docs_dir, seed):
    rows = near_copies(seed)
    docs = spark.read.parquet(docs_dir(rows) + "/documents.parquet")
    assert result(jaccard_components(docs)) == brute({d: t for d, t, _ in rows})


def test_empty_table(spark, docs_dir):
    docs = spark.read.parquet(docs_dir([(1, "a", "x")]) + "/documents.parquet").where("false")
    assert jaccard_components(docs).collect() == []


def test_repeated_and_null_ids(spark, docs_dir):
    a, b, c = ("one two three four five six " * 3, "red green blue pink grey white " * 3, "up down left right in out " * 3)
    rows = [(5, a, "x"), (5, b, "x"), (2, b, "x"), (7, a, "x"), (None, c, "x"), (9, c, "x"), (None, None, "x"), (4, c + "!", "x")]
    docs = spark.read.parquet(docs_dir(rows) + "/documents.parquet")
    found = sorted((str(r["doc_id"]), r["n_shingles"] > 0, str(r["component_id"])) for r in jaccard_components(docs).collect())
    assert found == [("2", True, "2"), ("4", True, "4"), ("5", True, "2"), ("5", True, "5"), ("7", True, "5"), ("9", True, "4"),
                     ("None", False, "None"), ("None", True, "4")]
