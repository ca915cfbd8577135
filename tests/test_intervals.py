"""Range rules looked up in intervals give what a CASE chain gives; bound dates."""

import random

import pytest
from pyspark.sql import functions as F

from tagweave.functions import intervals
from tagweave.functions.intervals import flatten, interval_label, parse_range
from tagweave.functions.labels import predicate_label
from tagweave.functions.templating import has_marker, render_sql, sql_arguments


def same(df, rules):
    looked_up = interval_label("query_value", df.schema["query_value"].dataType, rules)
    assert looked_up is not None
    both = df.select("query_value", looked_up.alias("a"), predicate_label("query_value", rules).alias("b")).collect()
    assert [(r.query_value, r.a) for r in both] == [(r.query_value, r.b) for r in both]
    return {r.a for r in both}


def random_rules(rnd, n, literal, top):
    out = []
    for i in range(n):
        a, b = literal(rnd.randint(0, top)), literal(rnd.randint(0, top))
        kind = rnd.choice(["between", "BETWEEN", "between", "<", ">=", "=", "other"] if i > 3 * n // 4 else ["between", "=", "other"])
        text = {"<": f"< {literal(3)}", ">=": f" >= {literal(top - 3)}", "=": f"= {a}", "other": f"in ({a}, {b})"}.get(kind, f"{kind} {a}  and {b} ")
        out.append((text, None if i % 11 == 5 else f"label {i}"))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_the_case_chain(spark, seed):
    rnd = random.Random(seed)
    numbers = spark.range(-5, 320).selectExpr("cast(id as bigint) query_value").unionByName(spark.sql("select cast(null as bigint) query_value"))
    assert len(same(numbers, random_rules(rnd, 60, str, 300))) > 5
    money = numbers.selectExpr("cast(query_value / 4.0 as decimal(16,2)) query_value")
    same(money, random_rules(rnd, 60, lambda x: f"{x / 4:.3f}", 300))
    texts = numbers.selectExpr("concat(if(query_value % 7 = 0, 'é', 'a'), query_value) query_value")
    same(texts, random_rules(rnd, 60, lambda x: f"'{'é' if x % 5 == 0 else 'a'}{x}'", 300))


def test_a_thousand_ranges(spark):
    rules = [(f"between {i * 10} and {i * 10 + 9}", f"l{i}") for i in range(1000)]
    values = spark.range(-3, 10_020, 7).selectExpr("id query_value")
    assert len(same(values, rules)) == 1001
    assert interval_label("query_value", values.schema["query_value"].dataType, rules[: intervals.MIN_RANGES - 1]) is None


def test_fragments_that_stay_case(spark):
    text, number = spark.sql("select 'x' a, 1 b, 1.5d c").schema.fields[:2]
    assert parse_range("between 1 and 2", text.dataType) is None  # compared after a cast
    assert parse_range("= 'x'", number.dataType) is None
    assert parse_range("between 'a''b' and 'c'", text.dataType) is None
    assert parse_range(r"= 'a\\'", text.dataType) is None and parse_range("like 'a%'", text.dataType) is None
    assert parse_range("> 1.0e3", number.dataType) is None and parse_range(None, number.dataType) is None
    assert parse_range("> 1", spark.sql("select 1.5d c").schema["c"].dataType) is None


def test_flattened_intervals_are_disjoint(spark):
    kind = spark.sql("select 1 a").schema["a"].dataType
    rules = ["between 5 and 3", "between 10 and 20", "between 15 and 30", "= 10", "< 0"]
    assert flatten([(i, parse_range(r, kind)) for i, r in enumerate(rules)]) == [
        (None, 4), (("0", False), None), (("10", False), 1), (("20", True), 2), (("30", True), None),
    ]


def test_marker_or_text():
    assert has_marker("select :executeDate") and not has_marker("select ':executeDate', \":executeDate\", x::executeDate -- :executeDate")
    assert render_sql("select 'executeDate'", "2024-01-15") == "select '2024-01-15'"
    sql = "select :executeDate, 'executeDate'"
    assert render_sql(sql, "2024-01-15") == sql and sql_arguments(sql, "2024-01-15") == {"executeDate": "2024-01-15"}
    assert sql_arguments("select 'executeDate'", "2024-01-15") == {}


def test_bound_date(spark):
    from tagweave.operators.tags import run_tag_sql

    df = run_tag_sql(spark, "select cast(:executeDate as date) + 1 d, 'executeDate' t", "2024-01-15")
    assert tuple(map(str, df.first())) == ("2024-01-16", "executeDate")
    assert df.where(F.col("t") == "executeDate").count() == 1
