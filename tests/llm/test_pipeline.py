"""The pipeline against brute force, stage by stage on the rows each one gets."""

from pyspark.sql import functions as F

import corpus_pipeline

from .conftest import SF
from .test_chunk_dedup import brute as brute_chunks
from .test_decontaminate import brute as brute_overlaps
from .test_jaccard import brute as brute_components
from .test_packing import check as check_packing


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "ngram_jaccard_join", "substring_dedup", "benchmark_decontamination", "best_fit_packing",
    ]


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def through(spark, docs, sf_dir):
    """Each stage's result held against a plain one; returns the texts before the last stage and its rows."""
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = texts(docs), corpus_pipeline.written(stage(spark, docs, sf_dir), f"test-{name}")
        assert docs.columns == columns
        after = texts(docs)
        if name == "language_id":
            want = {d: t for d, t in before.items() if any(c.isalpha() for c in t or "")}
            assert after == want
        elif name == "ngram_jaccard_join":
            assert after == {d: before[d] for d, (_, c) in brute_components(before).items() if c == d}
        elif name == "substring_dedup":
            found = brute_chunks(before)
            assert after == {d: k for d, (_, gone, _, k) in found.items() if not gone or k.split()}
        else:
            items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
            assert after == {d: before[d] for d, hit in brute_overlaps(before, items).items() if not hit}
    return after, corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()


def test_small_tables(spark, docs_dir):
    base = "the cat and the dog ran over the old stone bridge to the mill and back again before noon "
    rows = [(i, f"{base * 3} {i} " + " ".join(f"w{i}x{j}" for j in range(60)), "en") for i in range(12)]
    rows += [(20, None, "en"), (21, "", "en"), (22, "12 34 !!", "en"), (23, rows[0][1], "en"), (24, "unique short one", "en")]
    rows += [(25, "the items say alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu", "en")]
    folder = docs_dir(rows)
    bench = [(0, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (1, None)]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left, pieces = through(spark, docs, folder)
    assert 25 not in left and 23 not in left and 22 not in left and {0, 24} <= left.keys()
    check_packing(pieces, left)
    empty = docs.where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).collect() == []



def test_whole_table(spark):
    left, pieces = through(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    check_packing(pieces, left)
    ran = corpus_pipeline.run(spark, SF).collect()
    key = lambda rows: sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in rows)
    assert key(ran) == key(pieces)
