"""The manifest against plain hashing, on the whole table and on awkward rows."""

import hashlib
import zlib

import pytest

from tagweave.llm import merkle
from tagweave.llm.queries import op11_merkle_manifest

from .conftest import SF_BIG


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    """(root, sibling lists per node)."""
    proofs, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(place):
            run = nodes[p // 16 * 16 : p // 16 * 16 + 16]
            proofs[i].append((run[: p % 16], run[p % 16 + 1 :]))
        nodes = [h(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
        place = [p // 16 for p in place]
    return nodes[0], proofs


def plain(rows):
    fields = ("doc_id", "source", "lang", "n_chars")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    by_source = {}
    for r in rows:
        head = [framed(r[c]) for c in fields]
        leaf = h(*head, framed(r["text"]))
        hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        given = h(*head, framed(r["text"].translate(low))) if hit and r["text"] is not None else leaf
        by_source.setdefault(r["source"], []).append(((r["doc_id"] is not None, r["doc_id"] or 0), leaf, given, r["doc_id"]))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree([x[1] for x in sorted(by_source[s])]) for s in order]
    root, above = tree([t[0] for t in trees])
    out = []
    for s, (subroot, proofs), up in zip(order, trees, above, strict=True):
        for (_, leaf, given, doc_id), proof in zip(sorted(by_source[s]), proofs, strict=True):
            cur, siblings = given, []
            for before, after in proof + up:
                cur = h(*before, cur, *after)
                siblings += before + after
            out.append((doc_id, leaf, subroot, root, h(*siblings), cur, cur == root))
    return out


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_BIG}/documents.parquet").collect()
    want = plain(docs)
    assert found(op11_merkle_manifest(spark, SF_BIG)) == sorted(want, key=repr)
    assert {w[-1] for w in want} == {True, False}


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, path string, pos long, g string, digest string, s0 string"


def made(spark, tmp_path, rows):
    full = [(*r, "x", 9, "y", "z", "w") for r in rows]
    spark.createDataFrame(full, SCHEMA).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return op11_merkle_manifest(spark, str(tmp_path))


def case(rows):
    return [dict(zip(("doc_id", "source", "lang", "n_chars", "text"), r, strict=True)) for r in rows]


@pytest.mark.parametrize("n", [1, 2, 16, 17, 257])
def test_sizes_of_one_source(spark, tmp_path, n):
    rows = [(i * 7 % 1000, "s", "en", 3, f"Text {i}") for i in range(n)]
    assert found(made(spark, tmp_path, rows)) == sorted(plain(case(rows)), key=repr)


def test_edges(spark, tmp_path):
    rows = [(i, None if i % 3 else "hot", None, None, "A" * i) for i in range(60)]
    rows += [(None, None, None, None, None), (None, "", "", 0, ""), (5, "hot", "en", 1, None), (5, "hot", "en", 1, None),
             (5, "hot", "en", 2, "Zoë É 汉"), (-9, "-", "en", 1, "A:b"), (1 << 60, "é", "en", 1, "A" * 200_000)]
    rows += [(i, f"src{i}", "en", 1, "One") for i in range(40)]  # more sources than the fanout
    assert found(made(spark, tmp_path, rows)) == sorted(plain(case(rows)), key=repr)
    assert made(spark, tmp_path, []).count() == 0


def test_a_changed_sibling_breaks_the_fold(spark):
    docs = spark.createDataFrame([(i, "s", "en", 1, "t") for i in range(20)], "doc_id long, source string, lang string, n_chars long, text string")
    rows = merkle.manifest(docs, tampered=docs["doc_id"] == 3).collect()
    assert all(r["verified"] for r in rows)  # lower-casing changes nothing here
    upper = docs.selectExpr("doc_id", "source", "lang", "n_chars", "case when doc_id = 3 then 'T' else text end as text")
    assert [r["doc_id"] for r in merkle.manifest(upper, tampered=upper["doc_id"] == 3).collect() if not r["verified"]] == [3]
