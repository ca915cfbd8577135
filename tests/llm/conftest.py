import pytest

SF = "/root/testdata/sf0.001"
SF_BIG = "/root/testdata/sf0.01"


def texts_of(spark, sf_dir):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def write_docs(spark, tmp_path, rows):
    """A documents table with extra, clashing columns; returns its folder."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, n long, tokens string, token string"
    full = [(i, t, lang, "s", len(t or ""), 7, "x", "y") for i, t, lang in rows]
    spark.createDataFrame(full, schema).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


@pytest.fixture()
def docs_dir(spark, tmp_path):
    return lambda rows: write_docs(spark, tmp_path, rows)
