"""Weights, scores and ranks against plain counting, on the whole table and on awkward rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

from tagweave.llm import resample
from tagweave.llm.queries import op12_importance_resample

from .conftest import SF_BIG

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    w = WORD.findall((text or "").translate(LOWER))
    return [zlib.crc32(f.encode()) % 10000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]], len(w)


def plain(docs, target):
    found = [(i, *features(t)) for i, t in docs]
    s, t = Counter(b for _, f, _ in found for b in f), Counter(b for x in target for b in features(x)[0])
    s_all, t_all = float(sum(s.values())), float(sum(t.values()))
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (s_all + 10000) / ((s[b] + 1.0) * (t_all + 10000)))) for b in s}
    rows = []
    for i, f, n in found:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    rank = {id(r): k for k, r in enumerate(able[: 25 * len(able) // 100], 1)}
    return sorted(((*r[:4], rank.get(id(r))) for r in rows), key=repr)


def rows_of(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in df.collect()), key=repr)


def test_whole_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_BIG}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SF_BIG}/benchmark.parquet").collect()]
    assert rows_of(op12_importance_resample(spark, SF_BIG)) == plain(docs, target)


COMMON = "the Common line of many Documents, twenty words or so: " * 3


def edge_docs():
    rows = [(i, f"{COMMON}\nown{i} Text\n\n{COMMON}\n{'x' * (i % 5)} 1") for i in range(40)]
    rows += [(100, None), (101, ""), (102, "\n \n--\n"), (103, "one"), (104, "A\nb\n\n!\nC"), (105, "é É 汉字\r\nnaïve\x00x\x7fy"),
             (106, "a b " * 100_000), (107, "\n".join(["l i n e"] * 5000)), (None, COMMON + COMMON), (3, "same id, other text " * 9)]
    return rows


def test_edges(spark, docs_dir, monkeypatch):
    rows = edge_docs()
    docs = spark.read.parquet(docs_dir([(i, t, "en") for i, t in rows]) + "/documents.parquet")
    target = [COMMON.upper(), None, "", "l i\nn e", "naïve"]
    aims = spark.createDataFrame([(t,) for t in target], "text string")
    want = plain(rows, target)
    assert rows_of(resample.resample(docs, aims)) == want
    monkeypatch.setattr(resample, "HOT_SHARE", 1)  # no line is hot
    monkeypatch.setattr(resample, "BLOCK", 100)
    assert rows_of(resample.resample(docs, aims)) == want


def test_empty_tables(spark, docs_dir):
    docs = spark.read.parquet(docs_dir([]) + "/documents.parquet")
    assert resample.resample(docs, docs.select("text")).count() == 0
    some = spark.createDataFrame(edge_docs(), "doc_id long, text string")
    assert rows_of(resample.resample(some, docs.select("text"))) == plain(edge_docs(), [])


def test_equal_rows_share_a_score(spark):
    rows = [(1, COMMON * 2)] * 8
    found = rows_of(resample.resample(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([("the",)], "text string")))
    assert len({r[:4] for r in found}) == 1 and sorted(r[4] for r in found if r[4]) == [1, 2]
