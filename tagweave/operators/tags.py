"""Tag computation: stored SQL -> (optional labels) -> typed (uid, query_value)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagweave.codes import (
    MATCH_EXACT,
    MATCH_PREDICATE,
    TYPE_DATE,
    TYPE_STRING,
    CatalogError,
    value_type,
)
from tagweave.functions.intervals import interval_label
from tagweave.functions.labels import exact_label, predicate_label, rule_text
from tagweave.functions.templating import render_sql, sql_arguments

# Up to this many exact rules the labels are a CASE chain inside the scan's
# codegen stage; above it they become a lookup join, so per-row cost stays
# constant however many leaf labels a tag has.
EXACT_CASE_MAX_RULES = 64
# A lookup built from catalog rules is broadcast only below this many bytes
# (its size is known exactly on the driver); larger ones use a shuffle join.
RULE_BROADCAST_MAX_BYTES = 8 << 20


@dataclass(frozen=True)
class LabelRule:
    rule_id: int
    query_value: str | None
    label: str | None
    match_mode: str


def rules_from_rows(rows) -> list[LabelRule]:
    return [
        LabelRule(int(r["id"]), r["query_value"], r["sub_tag_value"], r["match_mode"])
        for r in rows
    ]


def run_tag_sql(spark: SparkSession, task_sql: str, execute_date: str) -> DataFrame:
    """Give the stored SQL its date, as text or bound to ``:executeDate``, and plan it (a derived table)."""
    text = render_sql(task_sql, execute_date)
    return spark.sql(text, args=sql_arguments(task_sql, execute_date) or None)


def passthrough(df: DataFrame) -> DataFrame:
    """No rules: the SQL's two columns are uid and value, by position whatever their names."""
    if len(df.columns) != 2:
        raise CatalogError(f"tag SQL must return exactly (uid, value); got columns {df.columns}")
    return df.toDF("uid", "query_value")


def _require_contract(df: DataFrame) -> None:
    missing = {"uid", "query_value"} - {c.lower() for c in df.columns}
    if missing:
        raise CatalogError(
            f"a tag SQL with label rules must return uid and query_value; missing {sorted(missing)}"
        )


def label_predicate(df: DataFrame, rules: Sequence[LabelRule]) -> DataFrame:
    """``case when query_value <fragment> then label ... end`` in rule order.

    Many range fragments are looked up instead (see :mod:`tagweave.functions.intervals`); the result is the same.
    """
    _require_contract(df)
    pairs = [(r.query_value, r.label) for r in rules]
    expr = interval_label("query_value", df.schema["query_value"].dataType, pairs)
    if expr is None:
        expr = predicate_label("query_value", pairs)
    return df.select(F.col("uid"), expr.alias("query_value"))


def label_exact(df: DataFrame, rules: Sequence[LabelRule]) -> DataFrame:
    """``case query_value when rule then label ... end`` in rule order."""
    _require_contract(df)
    vtype = df.schema["query_value"].dataType
    if len(rules) <= EXACT_CASE_MAX_RULES:
        expr = exact_label(F.col("query_value"), vtype, [(r.query_value, r.label) for r in rules])
        return df.select(F.col("uid"), expr.alias("query_value"))
    return _label_exact_lookup(df, rules, vtype)


def _label_exact_lookup(df: DataFrame, rules: Sequence[LabelRule], vtype: T.DataType) -> DataFrame:
    """Many exact rules: left join on a (key -> first label) lookup."""
    spark = df.sparkSession
    lookup = spark.createDataFrame(
        [(r.rule_id, rule_text(r.query_value, vtype), r.label) for r in rules],
        "rule_id bigint, rule_value string, label string",
    )
    lookup = (
        lookup.select(F.col("rule_value").try_cast(vtype).alias("_key"), "rule_id", "label")
        .where(F.col("_key").isNotNull())
        .groupBy("_key")
        .agg(F.min_by("label", "rule_id").alias("_label"))
    )
    size = sum(len((r.query_value or "").encode()) + len((r.label or "").encode()) + 16 for r in rules)
    if size <= RULE_BROADCAST_MAX_BYTES:
        lookup = F.broadcast(lookup)
    joined = df.join(lookup, F.col("query_value") == F.col("_key"), "left")
    return joined.select(F.col("uid"), F.col("_label").alias("query_value"))


def label(df: DataFrame, rules: Sequence[LabelRule]) -> DataFrame:
    modes = {r.match_mode for r in rules}
    if len(modes) > 1:
        raise CatalogError(f"rules of one task mix match modes {sorted(modes)}")
    if modes == {MATCH_PREDICATE}:
        return label_predicate(df, rules)
    if modes == {MATCH_EXACT}:
        return label_exact(df, rules)
    raise CatalogError(f"unknown match mode(s) {sorted(modes)}")


def cast_value(df: DataFrame, type_code: str) -> DataFrame:
    """uid as text, value in the tag's catalog type.

    A value that the type cannot hold raises, whatever the ANSI setting.
    """
    target = value_type(type_code)
    value = F.col("query_value")
    typed = value.cast(target)
    if not isinstance(target, T.StringType) and df.schema["query_value"].dataType != target:
        parsed = value.try_cast(target)
        message = F.concat(F.lit("tag value "), value.cast("string"), F.lit(f" is not {target.simpleString()}"))
        typed = F.when(value.isNotNull() & parsed.isNull(), F.raise_error(message)).otherwise(parsed)
    return df.select(F.col("uid").cast(T.StringType()).alias("uid"), typed.cast(target).alias("query_value"))


def tag_frame(
    spark: SparkSession,
    task_sql: str,
    execute_date: str,
    type_code: str,
    rules: Sequence[LabelRule] = (),
) -> DataFrame:
    """The rows one tag stores for a date (lazy; nothing runs yet)."""
    value_type(type_code)  # unknown code -> error before any work
    raw = run_tag_sql(spark, task_sql, execute_date)
    if rules:
        if str(type_code) not in (TYPE_STRING, TYPE_DATE):
            raise CatalogError(
                f"labels are text; a tag with rules must be string or date typed, not {type_code!r}"
            )
        out = label(raw, rules)
    else:
        out = passthrough(raw)
    return cast_value(out, type_code)


def build_tag(spark: SparkSession, catalog, task_id: int, execute_date: str) -> DataFrame:
    """Catalog-driven tag rows of ``task_id`` for ``execute_date``."""
    tag = catalog.tag_for_task(task_id)
    task = catalog.task_by_id(task_id)
    rules = rules_from_rows(catalog.rule_rows(task_id, tag["tag_code"]))
    return tag_frame(spark, task["task_sql"], execute_date, tag["tag_value_type"], rules)


__all__ = [
    "LabelRule",
    "build_tag",
    "cast_value",
    "label",
    "label_exact",
    "label_predicate",
    "passthrough",
    "rules_from_rows",
    "run_tag_sql",
    "tag_frame",
]
