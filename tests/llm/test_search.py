"""BM25 top-k against a plain evaluation of every document."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tagweave.llm import search as s
from tagweave.llm.queries import op2_topk_search

from .conftest import SF, texts_of


def brute(queries, texts, k):
    docs = {d: Counter((t or "").encode().lower().split()) for d, t in texts.items()}
    n, mean = len(docs), sum(sum(c.values()) for c in docs.values()) / max(1, len(docs))
    df = Counter(w for c in docs.values() for w in c)
    out = {}
    for q, text in queries.items():
        ws = set((text or "").encode().lower().split())
        idf = {w: math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) for w in ws if df[w]}
        score = {}
        for d, c in docs.items():
            norm = s.K1 * (1 - s.B + s.B * sum(c.values()) / mean)
            v = [idf[w] * c[w] * (s.K1 + 1) / (c[w] + norm) for w in ws if c[w]]
            if v:
                score[d] = math.fsum(v)
        out[q] = sorted(score.items(), key=lambda x: (-round(x[1], 9), x[0]))[:k]
    return out


def check(rows, want):
    got = {}
    for r in rows:
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["doc_id"], r["score"])
    assert got.keys() == {q for q, w in want.items() if w}
    for q, ranks in got.items():
        assert sorted(ranks) == list(range(1, len(want[q]) + 1))
        for (d, v), (e, u) in zip([ranks[i] for i in sorted(ranks)], want[q], strict=True):
            assert math.isclose(v, u, rel_tol=1e-9) and d == e


def test_whole_table(spark):
    texts = texts_of(spark, SF)
    check(op2_topk_search(spark, SF).collect(), brute({d: t for d, t in texts.items() if d % 50 == 0}, texts, 10))


@pytest.mark.parametrize("seed", [1, 2])
def test_pruning_shards_and_edges(spark, docs_dir, monkeypatch, seed):
    monkeypatch.setattr(s, "BLOCK_TERMS", 60)  # several broadcasts
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    pick = lambda n: " ".join(vocab[min(299, int(rng.paretovariate(0.5)))] for _ in range(n))
    rows = [(i, pick(rng.randint(0, 60)), "x") for i in range(400)] + [(400, None, "x"), (401, "", "x"), (402, "W1 " * 30_000, "x")]
    rows += [(500 + i, rows[7][1], "x") for i in range(15)]
    docs = spark.read.parquet(docs_dir(rows) + "/documents.parquet")
    texts = {d: t for d, t, _ in rows}
    queries = {1: pick(5), 2: pick(80), 3: rows[7][1], 4: None, 5: "nowhere", 6: "w1"}
    q = spark.createDataFrame(list(queries.items()), "query_id long, text string")
    check(s.search(q, docs, 10).collect(), brute(queries, texts, 10))
    assert s.search(q, docs.where("false")).collect() == [] and s.search(q.where("false"), docs).collect() == []


def test_blocks_are_skipped_without_loss(monkeypatch):
    monkeypatch.setattr(s, "SHARD_DOCS", 300)
    monkeypatch.setattr(s, "BLOCK_DOCS", 4)
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(200)]
    texts = {i: " ".join(vocab[min(199, int(rng.paretovariate(0.7)))] for _ in range(rng.randint(1, 40))) for i in range(900)}
    batch = pa.RecordBatch.from_arrays([pa.array(list(texts)), pa.array(list(texts.values()))], names=["doc_id", "text"])
    rows = [r for b in s._index([batch]) for r in b.to_pylist()]
    assert len(rows) == 3
    n, mean = len(texts), sum(len(t.split()) for t in texts.values()) / len(texts)
    df = Counter(w for t in texts.values() for w in set(t.split()))
    shards = [s.Shard(r, mean) for r in rows]
    queries = range(0, 900, 9)
    asked = []
    for q in queries:
        ws = sorted(set(texts[q].split()), key=hash_of)
        idf = np.array([math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) for w in ws])
        asked.append((np.array([hash_of(w) for w in ws], np.uint64), idf))
    opened = []
    for q, one in zip(queries, asked, strict=True):
        got = sorted((-v, d) for shard in shards for d, v in zip(*shard.top([one], 5)[0], strict=True))[:5]
        assert [d for _, d in got] == [d for d, _ in brute({q: texts[q]}, texts, 5)[q]]
        opened += [shard.opened for shard in shards]
    assert min(opened) < 0.5
    for shard in shards:  # a batch finds what its queries find alone
        for together, one in zip(shard.top(asked, 5), asked, strict=True):
            alone = shard.top([one], 5)[0]
            assert together[0].tolist() == alone[0].tolist() and together[1].tolist() == alone[1].tolist()


def hash_of(word):
    return int(s.words(next(s.chunks(pa.array([word])))).hashes[0])


def test_null_ids_and_ids_beyond_2_53(spark):
    big = (1 << 60) + 1
    docs = spark.createDataFrame([(big, "a b"), (None, "a b"), (7, "c")], "doc_id long, text string")
    q = spark.createDataFrame([(big + 2, "a"), (None, "c")], "query_id long, text string")
    found = sorted((str(r["query_id"]), r["rank"], str(r["doc_id"])) for r in s.search(q, docs, 5).collect())
    assert found == sorted([("None", 1, "7"), (str(big + 2), 1, "None"), (str(big + 2), 2, str(big))])


def test_shards_and_batches_are_bounded_by_postings(monkeypatch):
    rng = random.Random(6)
    texts = {i: " ".join(f"w{rng.randint(0, 400)}" for _ in range(rng.choice([3, 30, 200]))) for i in range(300)}
    texts[300] = " ".join(f"v{i}" for i in range(2_000))  # more postings than a shard may hold
    batch = pa.RecordBatch.from_arrays([pa.array(list(texts)), pa.array(list(texts.values()))], names=["doc_id", "text"])

    def shards():
        return [s.Shard(r, 50.0) for b in s._index([batch]) for r in b.to_pylist()]

    asked = [(np.unique(s.words(next(s.chunks(pa.array([texts[q]])))).hashes), None) for q in range(0, 301, 10)]
    asked = [(h, np.linspace(0.1, 3, len(h))) for h, _ in asked]

    def best(parts):
        found = [shard.top(asked, 5) for shard in parts]
        return [sorted((-v, d) for got in found for d, v in zip(*got[i], strict=True))[:5] for i in range(len(asked))]

    whole = shards()
    monkeypatch.setattr(s, "SHARD_POSTINGS", 1_000)
    monkeypatch.setattr(s, "BATCH_POSTINGS", 500)
    monkeypatch.setattr(s, "SLAB", 2)
    small = shards()
    assert len(whole) == 1 and sorted(d for x in small for d in x.ids) == sorted(texts)
    assert all(len(x.post) <= 1_000 or len(x.ids) == 1 for x in small)
    assert best(small) == best(whole)


def test_a_task_gets_its_shards_one_by_one(spark, monkeypatch):
    def index(batches):
        for _ in batches:
            pass
        noise = np.random.default_rng(1)
        for _ in range(6):
            yield pa.RecordBatch.from_arrays([pa.array([noise.bytes(100_000)])] * 5 + [pa.array([noise.bytes(600_000)])], names=[c.split()[0] for c in s.INDEX.split(", ")])

    def batch_sizes(queries, mean, k):
        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([1]), pa.array([1.0])], names=["q", "doc_id", "score"])

        return run

    frames, names, original = {}, ["parquet.block.size", *s.SHARDS_READ], s.written
    monkeypatch.setattr(s, "written", lambda df, label, *more: frames.setdefault(label, original(df, label, *more)))
    monkeypatch.setattr(s, "_index", index)
    monkeypatch.setattr(s, "_search", batch_sizes)
    monkeypatch.setitem(s.SHARDS_WRITTEN, "parquet.block.size", str(1 << 20))
    before = [spark.conf.get(name, None) for name in names]
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string").coalesce(1)
    found = s.search(docs.withColumnRenamed("doc_id", "query_id"), docs).collect()
    assert {r["query_id"] for r in found} == {1}  # rows of every batch a task was given
    files = [pq.ParquetFile(f.removeprefix("file:").replace("///", "/")).metadata for f in frames["search-index"].inputFiles()]
    groups = [f.row_group(i).num_rows for f in files for i in range(f.num_row_groups)]
    assert sum(groups) == 6 and max(groups) <= 2  # not all of a task's shards at a time
    assert [spark.conf.get(name, None) for name in names] == before


def test_full_shards_hold_one_kind_of_documents(monkeypatch):
    monkeypatch.setattr(s, "SHARD_DOCS", 64)
    monkeypatch.setattr(s, "KIND_POSTINGS", 500)
    monkeypatch.setattr(s, "BLOCK_DOCS", 8)
    rng = random.Random(8)
    texts = {i: " ".join(f"{'ab'[i % 2]}{min(99, int(rng.paretovariate(0.6)))}" for _ in range(rng.randint(10, 60))) for i in range(1_500)}
    batch = pa.RecordBatch.from_arrays([pa.array(list(texts)), pa.array(list(texts.values()))], names=["doc_id", "text"])
    shards = [s.Shard(r, 35.0) for b in s._index([batch]) for r in b.to_pylist()]
    assert sorted(d for x in shards for d in x.ids) == sorted(texts) and len(shards) == 24
    assert sum(len(set(x.ids % 2)) == 1 for x in shards) >= 24 - s.KINDS  # were all mixed
    mixed = [np.concatenate([x.ids[a : a + 8] % 2 for a in range(0, len(x.ids), 8) if len(set(x.ids[a : a + 8] % 2)) == 2] or [x.ids[:0]]) for x in shards]
    assert sum(map(len, mixed)) < 0.1 * len(texts)  # blocks too


def test_the_index_gives_the_statistics():
    texts = ["a b b", None, "", "B c", "a " * 300]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(texts, pa.string())], names=["doc_id", "text"])
    shards = list(s._index([batch]))
    rows = [r for b in s._statistics([b.select(["length", "terms", "df"]) for b in shards]) for r in b.to_pylist()]
    found = {r["h"]: r["df"] for r in rows if r["h"] is not None}
    assert {w: found[int(np.uint64(hash_of(w)).view(np.int64))] for w in "abc"} == {"a": 2, "b": 2, "c": 1} and len(found) == 3
    assert [(r["df"], r["words"]) for r in rows if r["h"] is None] == [(5, 305)]
    empty = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([None, ""], pa.string())], names=["doc_id", "text"])
    shard = s.Shard(next(iter(s._index([empty]))).to_pylist()[0], 0.0)
    assert shard.top([(np.array([5], np.uint64), np.ones(1))], 3)[0][0].tolist() == []


def test_a_few_partitions_of_documents_stay_few(spark, monkeypatch):
    tasks, original = {}, s.written

    def written(df, label, *more):
        tasks[label] = df.rdd.getNumPartitions()
        return original(df, label, *more)

    monkeypatch.setattr(s, "written", written)
    docs = spark.createDataFrame([(i, "a b") for i in range(40)], "doc_id long, text string")
    for parts, want in ((1, 1), (40, spark.sparkContext.defaultParallelism)):
        tasks.clear()
        s.search(docs.limit(0).withColumnRenamed("doc_id", "query_id"), docs.repartition(40).coalesce(parts))
        assert tasks["search-index"] == want
