"""PPM code lengths against a plain loop; held-out accuracy; edge texts."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np

from tagweave.llm import langid
from tagweave.llm.queries import op7_language_id

from .conftest import SF_BIG


def plain_bits(training: dict[str, list[bytes]], text: bytes):
    out = {}
    for lang, texts in training.items():
        count = defaultdict(Counter)
        for t in texts:
            t = b"\n" * 4 + t.lower()
            for i in range(4, len(t)):
                for o in range(5):
                    count[t[i - o : i]][t[i]] += 1
        t, bits = b"\n" * 4 + text.lower(), 0.0
        for i in range(4, len(t)):
            for o in range(4, -1, -1):
                c = count.get(t[i - o : i])
                if not c:
                    continue
                n, d = sum(c.values()), len(c)
                if t[i] in c:
                    bits += math.log2((n + d) / c[t[i]])
                    break
                bits += math.log2((n + d) / d)
            else:
                bits += 8
        out[lang] = bits
    return out


def test_code_lengths_are_exact(monkeypatch):
    monkeypatch.setattr(langid, "BLOCK", 50)
    training = {"a": [b"The cat sat on the mat. ", b"the hat"], "b": ["Le chat était là où çà. ".encode(), b"le rat"]}
    rows = [(lang, int(k), 1) for lang, ts in training.items() for t in ts for s in range(1, 6)
            for k in langid._grams(np.concatenate([langid._START, langid.LOWER[np.frombuffer(t, np.uint8)]]), s)]
    langs, keys, k = (np.array(x) for x in zip(*rows, strict=True))
    model = langid.build_model(langs.astype(object), keys.astype(np.uint64), k)
    texts = [b"", b"the chat", "où est Zoë?".encode(), b"\x00\xff" * 3, b"cat " * 60]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = langid.score_texts(model, np.frombuffer(b"".join(texts), np.uint8), offsets)
    for t, row in zip(texts, got, strict=True):
        want = plain_bits(training, t)
        assert np.allclose(row, [want[x] for x in model.langs], rtol=1e-5)


def test_whole_table(spark):
    rows = op7_language_id(spark, SF_BIG).collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_BIG}/documents.parquet").collect()}
    assert {r["doc_id"] for r in rows} == docs.keys() and len(rows) == len(docs)
    right = n = 0
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
        if r["held_out"]:
            n += 1
            right += r["lang_pred"] == docs[r["doc_id"]]["lang"]
    assert n > 200 and right / n > 0.97


def test_edges(spark, docs_dir):
    rows = [(i, "the cat and the dog " * 3 + str(i), "en") for i in range(30)]
    rows += [(30 + i, "le chat et la souris " * 3 + str(i), "fr") for i in range(30)]
    rows += [(60, None, "en"), (61, "", "en"), (62, "123 !? \n", "fr"), (63, "le chat et la souris", None), (64, "汉字", None),
             (65, "the dog and the cat " * 100_000, None)]
    docs = spark.read.parquet(docs_dir(rows) + "/documents.parquet")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(docs).collect()}
    assert [got[i] for i in (60, 61, 62)] == [("und", 0.0)] * 3
    assert got[63][0] == "fr" and got[65][0] == "en" and got[64][0] in ("en", "fr") and len(got) == len(rows)
    assert all(got[i][0] == ("en" if i < 30 else "fr") for i in range(60))
    from pyspark.sql import functions as F

    nothing = langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in nothing} == {("und", 0.0)}
    assert langid.identify(docs.where("false")).collect() == []
