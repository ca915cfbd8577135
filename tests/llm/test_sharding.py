"""Shards: totals, balance, gapless slots, copies together."""

import zlib
from collections import Counter, defaultdict

from tagweave.llm.queries import op8_shard_by_bytes
from tagweave.llm.sharding import shard_by_bytes

from .conftest import SF_BIG, texts_of


def check(rows, texts, n):
    assert Counter(r["doc_id"] for r in rows) == Counter(d for d, _ in texts)
    by_id = dict(texts)
    size, slots, where = Counter(), defaultdict(list), defaultdict(set)
    for r in rows:
        data = (by_id[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 16, zlib.crc32(data), "bytes", None)
        assert 0 <= r["shard"] < n
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        where[data].add(r["shard"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    return size, where


def test_whole_table(spark):
    texts = list(texts_of(spark, SF_BIG).items())
    size, _ = check(op8_shard_by_bytes(spark, SF_BIG).collect(), texts, 40)
    target = sum(size.values()) / 40
    assert max(abs(size[s] - target) for s in range(40)) <= max(len((t or "").encode()) for _, t in texts) + 16


def test_hot_copies_are_cut_small_groups_are_not(spark, docs_dir):
    rows = [(i, "copy " * 20, "x") for i in range(1000)] + [(1000 + i, f"own {i} " * 12, "x") for i in range(2000)]
    rows += [(3000 + i, "pair", "x") for i in range(4)] + [(4000, None, "x"), (4001, "", "x"), (4002, "é" * 3, "x")]
    docs = spark.read.parquet(docs_dir(rows) + "/documents.parquet")
    size, where = check(shard_by_bytes(docs, 10).collect(), [(d, t) for d, t, _ in rows], 10)
    assert max(size.values()) - min(size.values()) < 0.05 * max(size.values())
    assert len(where[b"copy " * 20]) >= 3 and len(where[b"pair"]) == 1 and len(where[b""]) == 1
    assert shard_by_bytes(docs.where("false")).collect() == []
