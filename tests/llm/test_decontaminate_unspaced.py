"""Benchmark items in scripts written without spaces."""

from tagweave.llm.decontaminate import contamination, find_overlaps


def test_unspaced_items_are_found(spark, docs_dir):
    zh, ja, far = "水在一个大气压下的沸点是多少摄氏度", "にほんでいちばんたかいやまはなんですか", "".join(chr(0x20000 + 7 * i) for i in range(14))
    rows = [
        (0, f"前文不相干{zh}后面还有别的内容", "x"), (1, "これは" + ja[:9] + "を" + ja[10:] + "です", "x"), (2, f"abc{far}def", "x"),
        (3, "完全没有关系的一段普通文字内容而已", "x"), (4, "plain words about nothing in particular at all here", "x"),
    ]
    docs = spark.read.parquet(docs_dir(rows) + "/documents.parquet")
    bench = spark.createDataFrame([(0, zh), (1, ja), (2, far), (3, "短句")], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in find_overlaps(docs, bench).collect()} == {(0, 0), (1, 1), (2, 2)}
    assert {r["doc_id"] for r in contamination(docs, bench).collect() if r["contaminated"]} == {0, 1, 2}
