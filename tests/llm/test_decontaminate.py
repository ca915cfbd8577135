"""Spaced seeds: the masks lose no window with two substitutions; planted passages against brute force."""

import itertools
import random
import re
from collections import Counter, defaultdict

from tagweave.llm.decontaminate import MASKS, MIN_ITEM, MIN_SAME, WINDOW, contamination, find_overlaps
from tagweave.llm.queries import op4_decontaminate

from .conftest import SF, texts_of


def test_masks_hit_every_tolerated_window():
    for k in range(WINDOW - MIN_SAME + 1):
        for gone in itertools.combinations(range(WINDOW), k):
            assert any(
                all(s + i not in gone for i, on in enumerate(m) if on == "1")
                for m in MASKS for s in range(WINDOW - len(m) + 1)
            )


def tokens(text):
    return [t for t in re.split(r"[\W_]+", (text or "").lower()) if t]


def brute(docs, items):
    out = {}
    for d, text in docs.items():
        w, hit, where = tokens(text), set(), defaultdict(list)
        for q, x in enumerate(w):
            where[x].append(q)
        for i, item in items.items():
            v = tokens(item)
            k = min(WINDOW, len(v))
            if len(v) < MIN_ITEM:
                continue
            need = MIN_SAME if k == WINDOW else k
            shared = Counter(q - p for p, x in enumerate(v) for q in where[x])
            for shift in [s for s, n in shared.items() if n >= need]:
                lo, hi = max(0, -shift), min(len(v), len(w) - shift)
                eq = [v[p] == w[p + shift] for p in range(lo, hi)]
                if any(sum(eq[s : s + k]) >= need for s in range(len(eq) - k + 1)):
                    hit.add(i)
                    break
        out[d] = hit
    return out


def test_planted_passages(spark, docs_dir):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(60)]
    word = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = {i: " ".join(word(rng.choice([3, 6, 8, 12, 20, 40]))) for i in range(12)} | {90: None, 91: "", 92: "?!"}
    items[93] = items[11]
    rows = [(0, None, "x"), (1, "", "x"), (2, "... ,,", "x")]
    for d in range(3, 90):
        w = word(rng.randint(0, 80))
        if rng.random() < 0.7:
            v = tokens(items[rng.randrange(12)])
            a = rng.randrange(max(1, len(v) - 10))
            v = v[a : a + rng.randint(8, 30)]
            for _ in range(rng.randint(0, 4)):
                v[rng.randrange(len(v))] = "zz"
            w[len(w) // 2 : len(w) // 2] = [x.upper() + rng.choice(["", ",", "!"]) for x in v]
        rows.append((d, " ".join(w), "x"))
    docs = spark.read.parquet(docs_dir(rows) + "/documents.parquet")
    bench = spark.createDataFrame([(i, t, 1) for i, t in items.items()], "item_id long, text string, doc_id int")
    want = brute({d: t for d, t, _ in rows}, {i: t for i, t in items.items() if i != 93})
    found = {}
    for r in find_overlaps(docs, bench).collect():
        found.setdefault(r["doc_id"], set()).add(r["item_id"])
    assert found == {d: h for d, h in want.items() if h}
    flags = {r["doc_id"]: (r["contaminated"], r["n_items"]) for r in contamination(docs, bench).collect()}
    assert flags == {d: (bool(h), len(h)) for d, h in want.items()}
    assert not any(r["contaminated"] for r in contamination(docs, bench.where("false")).collect())


def test_whole_table(spark):
    docs = texts_of(spark, SF)
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    rows = op4_decontaminate(spark, SF).collect()
    found = {(r["doc_id"], r["item_id"]) for r in rows}
    assert len(found) == len(rows)
    assert found == {(d, i) for d, hit in brute(docs, items).items() for i in hit}
    flags = {d: any(d == e for e, _ in found) for d in docs}
    windows = {tuple(tokens(t)[i : i + WINDOW]) for t in items.values() for i in range(len(tokens(t)) - WINDOW + 1)}
    for d, t in docs.items():
        w = tokens(t)
        if any(tuple(w[i : i + WINDOW]) in windows for i in range(len(w))):
            assert flags[d]
    assert 0 < sum(flags.values()) < len(flags) / 2 
