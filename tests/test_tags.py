import pytest
from pyspark.sql import functions as F

from tagweave.codes import CatalogError
from tagweave.functions.templating import render_sql
from tagweave.operators import tags as tg
from tagweave.operators.tags import LabelRule, label_exact, label_predicate, tag_frame

from .conftest import mini_catalog


def _rules(pairs, mode):
    return [LabelRule(i, q, lab, mode) for i, (q, lab) in enumerate(pairs, 1)]


def test_render_sql_replaces_every_occurrence():
    sql = "select 'executeDate' a, executeDate_x from t where d <= 'executeDate'"
    out = render_sql(sql, "2024-01-15")
    assert "executeDate" not in out and out.count("2024-01-15") == 3


@pytest.mark.parametrize("bad", ["2024-1-5", "2024-01-15' or 1=1 --", "", None])
def test_render_sql_rejects_bad_dates(bad):
    with pytest.raises(ValueError):
        render_sql("select 1", bad)


def test_predicate_first_match_wins(spark):
    df = spark.createDataFrame([("u", 3)], "uid string, query_value int")
    out = label_predicate(df, _rules([("< 10", "a"), ("< 5", "b")], "predicate"))
    assert out.collect()[0].query_value == "a"


def test_unmatched_and_null_values_give_null(spark):
    df = spark.createDataFrame([("u1", 30), ("u2", None)], "uid string, query_value int")
    out = label_predicate(df, _rules([("< 10", "a")], "predicate")).collect()
    assert [r.query_value for r in out] == [None, None]
    out = label_exact(df, _rules([("1", "a")], "exact")).collect()
    assert [r.query_value for r in out] == [None, None]


def test_wrapping_zodiac_range(spark):
    rules = _rules(
        [("between '12-22' and '12-31'", "Capricorn"), ("between '01-01' and '01-19'", "Capricorn")],
        "predicate",
    )
    df = spark.createDataFrame(
        [("a", "12-25"), ("b", "01-05"), ("c", "06-01"), ("d", None)], "uid string, query_value string"
    )
    got = {r.uid: r.query_value for r in label_predicate(df, rules).collect()}
    assert got == {"a": "Capricorn", "b": "Capricorn", "c": None, "d": None}


def test_numeric_exact_rule_compares_as_number(spark):
    df = spark.createDataFrame([("u", 1)], "uid string, query_value bigint")
    assert label_exact(df, _rules([("01", "one")], "exact")).first().query_value == "one"
    assert label_exact(df, _rules([("x", "never"), ("1", "one")], "exact")).first().query_value == "one"
    assert label_exact(df, _rules([("x", "never")], "exact")).first().query_value is None


def test_label_with_apostrophe_is_kept(spark):
    df = spark.createDataFrame([("u", "v")], "uid string, query_value string")
    assert label_exact(df, _rules([("v", "it's")], "exact")).first().query_value == "it's"


def test_many_exact_rules_use_lookup_with_same_result(spark, monkeypatch):
    df = spark.range(0, 300).select(
        F.col("id").cast("string").alias("uid"), (F.col("id") % 120).alias("query_value")
    )
    pairs = [(str(v), f"L{v}") for v in range(100)] + [("5", "dup"), ("zz", "bad")]
    rules = _rules(pairs, "exact")
    via_lookup = {r.uid: r.query_value for r in label_exact(df, rules).collect()}
    monkeypatch.setattr(tg, "EXACT_CASE_MAX_RULES", 10_000)
    via_case = {r.uid: r.query_value for r in label_exact(df, rules).collect()}
    assert via_lookup == via_case
    assert via_case["5"] == "L5" and via_case["110"] is None


def test_labelled_tag_must_be_text(spark, warehouse):
    rules = _rules([("1", "a")], "exact")
    sql = "select cast(c_custkey as string) uid, c_nationkey query_value from customer"
    with pytest.raises(CatalogError, match="string or date"):
        tag_frame(spark, sql, "2024-01-15", "1", rules)


def test_unknown_type_code_is_an_error(spark, warehouse):
    with pytest.raises(CatalogError, match="'9'"):
        tag_frame(spark, "select 1 uid, 2 query_value", "2024-01-15", "9")


def test_passthrough_is_positional(spark):
    df = spark.createDataFrame([(7, "x")], "a int, b string")
    out = tg.cast_value(tg.passthrough(df), "3")
    assert out.columns == ["uid", "query_value"] and tuple(out.first()) == ("7", "x")


def test_build_tag_from_catalog_with_exact_rules(spark, warehouse):
    cat = mini_catalog(
        spark,
        [(1, "TAG_SEG_SHORT", "3",
          "select cast(c_custkey as string) uid, c_mktsegment query_value from customer")],
        rules=[(1, 1, "BUILDING", 11, None), (2, 1, "AUTOMOBILE", 12, None), (3, 1, "BUILDING", 13, None)],
        labels=[(11, "B"), (12, "A"), (13, "never")],
    )
    got = {r.uid: r.query_value for r in tg.build_tag(spark, cat, 1, "2024-01-15").collect()}
    raw = {
        str(r.c_custkey): r.c_mktsegment
        for r in spark.table("customer").select("c_custkey", "c_mktsegment").collect()
    }
    expected = {u: {"BUILDING": "B", "AUTOMOBILE": "A"}.get(v) for u, v in raw.items()}
    assert got == expected


def test_passthrough_takes_exactly_two_columns_by_position(spark):
    from tagweave.operators.tags import passthrough

    assert passthrough(spark.sql("select 1 x, 2 x")).first().asDict() == {"uid": 1, "query_value": 2}
    for sql in ("select 1 u, 2 v, 3 w", "select 1 u"):
        with pytest.raises(CatalogError, match="exactly"):
            passthrough(spark.sql(sql))


def test_exact_rules_compare_exact_numbers_in_both_plans(spark, monkeypatch):
    from tagweave.operators import tags

    rules = [("1.005", "a"), ("x", "b"), ("1.0", "c"), ("1.010", "d"), ("-2.50", "e"), (None, "f"), ("1e2", "g"), ("9" * 30, "h")]
    rules = [tags.LabelRule(i, v, name, "exact") for i, (v, name) in enumerate(rules)]
    values = spark.sql("select cast(id as string) uid, cast(v as decimal(16,2)) query_value from values "
                       "(1, 1.01), (2, 1.00), (3, -2.5), (4, 100), (5, 1.02), (6, null) t(id, v)")
    want = {"1": "d", "2": "c", "3": "e", "4": "g", "5": None, "6": None}
    texts = spark.sql("select cast(id as string) uid, v query_value from values (1, '1.0'), (2, '1') t(id, v)")
    for limit in (64, 0):
        monkeypatch.setattr(tags, "EXACT_CASE_MAX_RULES", limit)
        assert {r.uid: r.query_value for r in tags.label_exact(values, rules).collect()} == want
        longs = values.selectExpr("uid", "cast(query_value as bigint) query_value")
        assert {r.uid: r.query_value for r in tags.label_exact(longs, rules).collect()} == {**dict.fromkeys("1256", "c"), "3": None, "4": "g", "6": None}
        assert {r.uid: r.query_value for r in tags.label_exact(texts, rules).collect()} == {"1": "c", "2": None}


def test_value_that_does_not_fit_raises_without_ansi(spark):
    from tagweave.operators.tags import cast_value

    df = spark.createDataFrame([("1", "12"), ("2", "zz")], "uid string, query_value string")
    ansi = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert cast_value(df.where("uid = '1'"), "1").first().query_value == 12
        with pytest.raises(Exception, match="is not bigint"):
            cast_value(df, "1").collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", ansi)


def test_dates_are_real_dates():
    from tagweave.codes import check_date

    assert check_date("2024-02-29") == "2024-02-29"
    for bad in ("2024-01-15\n", "2024-13-99", "2023-02-29", "20240115", None):
        with pytest.raises(ValueError):
            check_date(bad)
