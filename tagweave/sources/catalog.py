"""Metadata catalog: tag definitions, tasks and label rules.

The catalog is small relational metadata (one row per tag / task / rule).
It is read as DataFrames - from JDBC, Parquet or in-memory rows - and the
lookups below are ordinary joins and filters. Only the catalog rows a job
needs are brought to the driver, never warehouse data.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagweave.codes import (
    MATCH_EXACT,
    MATCH_PREDICATE,
    PREDICATE_TAG_CODE,
    TASK_ENABLED,
    TYPE_DATE,
    TYPE_STRING,
    CatalogError,
    value_type,
)

TAG_INFO_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("tag_code", T.StringType()),
        T.StructField("tag_name", T.StringType()),
        T.StructField("tag_level", T.LongType()),
        T.StructField("parent_tag_id", T.LongType()),
        T.StructField("tag_type", T.StringType()),
        T.StructField("tag_value_type", T.StringType()),
        T.StructField("tag_value_limit", T.LongType()),
        T.StructField("tag_value_step", T.LongType()),
        T.StructField("tag_task_id", T.LongType()),
        T.StructField("tag_comment", T.StringType()),
        T.StructField("create_time", T.TimestampType()),
        T.StructField("update_time", T.TimestampType()),
    ]
)

TASK_INFO_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("task_name", T.StringType()),
        T.StructField("task_status", T.StringType()),
        T.StructField("task_comment", T.StringType()),
        T.StructField("task_time", T.StringType()),
        T.StructField("task_type", T.StringType()),
        T.StructField("exec_type", T.StringType()),
        T.StructField("main_class", T.StringType()),
        T.StructField("file_id", T.LongType()),
        T.StructField("task_args", T.StringType()),
        T.StructField("task_sql", T.StringType()),
        T.StructField("task_exec_level", T.LongType()),
        T.StructField("create_time", T.TimestampType()),
    ]
)

# ``match_mode`` ('exact' / 'predicate') is this engine's addition: it makes
# the labelling mode a property of the rule instead of a hard-coded tag code.
TASK_TAG_RULE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("tag_id", T.LongType()),
        T.StructField("task_id", T.LongType()),
        T.StructField("query_value", T.StringType()),
        T.StructField("sub_tag_id", T.LongType()),
        T.StructField("match_mode", T.StringType()),
    ]
)

# Columns returned by the tag-by-task lookup (no level, step or update time).
TAG_BY_TASK_COLUMNS = [
    "id",
    "tag_code",
    "tag_name",
    "parent_tag_id",
    "tag_type",
    "tag_value_type",
    "tag_value_limit",
    "tag_task_id",
    "tag_comment",
    "create_time",
]

TABLES = {
    "tag_info": TAG_INFO_SCHEMA,
    "task_info": TASK_INFO_SCHEMA,
    "task_tag_rule": TASK_TAG_RULE_SCHEMA,
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns by name, cast to its types; absent -> NULL."""
    present = {c.lower(): c for c in df.columns}
    cols = []
    for field in schema.fields:
        src = present.get(field.name.lower())
        col = F.col(f"`{src}`") if src is not None else F.lit(None)
        cols.append(col.cast(field.dataType).alias(field.name))
    return df.select(*cols)


def local_frame(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Small driver-side rows as a local relation.

    Built from a pandas frame (object columns keep ``None`` as NULL), which
    Spark plans as a ``LocalRelation`` when Arrow is on: lookups on it need
    no cluster job. Without Arrow it is an ordinary scan; results are equal.
    """
    import pandas as pd

    names = schema.fieldNames()
    if rows:
        pdf = pd.DataFrame(rows, columns=names, dtype=object)
    else:
        pdf = pd.DataFrame({n: pd.Series([], dtype=object) for n in names})
    return spark.createDataFrame(pdf, schema)


def _rows(records: Iterable[Mapping[str, Any]], schema: T.StructType) -> list[tuple]:
    names = schema.fieldNames()
    out = []
    for rec in records:
        unknown = set(rec) - set(names)
        if unknown:
            raise CatalogError(f"unknown catalog fields {sorted(unknown)}")
        out.append(tuple(rec.get(n) for n in names))
    return out


class Catalog:
    """The three metadata tables as DataFrames plus the lookups jobs need."""

    def __init__(self, tag_info: DataFrame, task_info: DataFrame, task_tag_rule: DataFrame):
        self.tag_info = conform(tag_info, TAG_INFO_SCHEMA)
        self.task_info = conform(task_info, TASK_INFO_SCHEMA)
        self.task_tag_rule = conform(task_tag_rule, TASK_TAG_RULE_SCHEMA)
        self._cache: dict = {}

    # -- loading ------------------------------------------------------------
    @classmethod
    def from_rows(
        cls,
        spark: SparkSession,
        tags: Iterable[Mapping[str, Any]],
        tasks: Iterable[Mapping[str, Any]],
        rules: Iterable[Mapping[str, Any]] = (),
    ) -> Catalog:
        return cls(
            local_frame(spark, _rows(tags, TAG_INFO_SCHEMA), TAG_INFO_SCHEMA),
            local_frame(spark, _rows(tasks, TASK_INFO_SCHEMA), TASK_INFO_SCHEMA),
            local_frame(spark, _rows(rules, TASK_TAG_RULE_SCHEMA), TASK_TAG_RULE_SCHEMA),
        )

    @classmethod
    def from_parquet(cls, spark: SparkSession, path: str) -> Catalog:
        """``<path>/tag_info``, ``<path>/task_info``, ``<path>/task_tag_rule``."""
        return cls(*(spark.read.parquet(f"{path}/{name}") for name in TABLES))

    @classmethod
    def from_jdbc(
        cls,
        spark: SparkSession,
        url: str,
        properties: Mapping[str, str] | None = None,
        table_names: Mapping[str, str] | None = None,
    ) -> Catalog:
        """Read the metadata tables over JDBC (e.g. a MySQL metadata db)."""
        names = {**{k: k for k in TABLES}, **(table_names or {})}
        props = dict(properties or {})
        return cls(*(spark.read.jdbc(url, names[k], properties=props) for k in TABLES))

    def write_parquet(self, path: str) -> None:
        for name, df in zip(TABLES, (self.tag_info, self.task_info, self.task_tag_rule)):
            df.write.mode("overwrite").parquet(f"{path}/{name}")

    # -- lookups (DataFrames) ---------------------------------------------------
    def enabled_tags(self) -> DataFrame:
        """Tags whose task is enabled: inner equi-join on the task id.

        Ordered by tag id so the wide table's column order is stable. Both
        sides are catalog tables; Spark's own size statistics decide whether
        the join broadcasts.
        """
        return self._enabled().orderBy("id")

    def _enabled(self) -> DataFrame:
        tasks = self.task_info.where(F.col("task_status") == TASK_ENABLED).select(
            F.col("id").alias("_task_id")
        )
        return self.tag_info.join(
            tasks, F.col("tag_task_id") == F.col("_task_id"), "inner"
        ).drop("_task_id")

    def tags_by_task(self, task_id: int) -> DataFrame:
        return self.tag_info.where(F.col("tag_task_id") == F.lit(int(task_id))).select(
            *TAG_BY_TASK_COLUMNS
        )

    def tasks_by_id(self, task_id: int) -> DataFrame:
        return self.task_info.where(F.col("id") == F.lit(int(task_id)))

    def _rules(self, condition) -> DataFrame:
        leaf = self.tag_info.select(
            F.col("id").alias("_leaf_id"), F.col("tag_name").alias("sub_tag_value")
        )
        return (
            self.task_tag_rule.where(condition)
            .join(leaf, F.col("sub_tag_id") == F.col("_leaf_id"), "inner")
            .select(
                "id",
                "tag_id",
                "task_id",
                "query_value",
                "sub_tag_id",
                "sub_tag_value",
                "match_mode",
            )
        )

    def rules_for_task(self, task_id: int) -> DataFrame:
        """Rules of a task with the label (the leaf tag's name) joined in.

        Inner join: a rule whose ``sub_tag_id`` names no tag is dropped.
        Ordered by rule id, which is the first-match order of the labels.
        """
        return self._rules(F.col("task_id") == F.lit(int(task_id))).orderBy("id")

    # -- lookups brought to the driver (catalog rows only) -----------------------
    # A Catalog instance is the metadata snapshot of one run: each lookup is
    # fetched once and remembered, and ``prefetch`` loads the rows of every
    # enabled task in three queries instead of three per task.
    def _memo(self) -> dict:
        return self._cache

    @staticmethod
    def _by_id(df: DataFrame) -> list[Row]:
        """Collect a catalog lookup and order it by id on the driver.

        Lookups return a few metadata rows; sorting them here spares Spark a
        range-partitioning job per lookup.
        """
        return sorted(df.collect(), key=lambda r: (r["id"] is None, r["id"]))

    @classmethod
    def _first(cls, df: DataFrame, what: str) -> Row:
        rows = cls._by_id(df)
        if not rows:
            raise CatalogError(f"no {what}")
        return rows[0]

    def tag_for_task(self, task_id: int) -> Row:
        """The tag computed by a task (first by id if several)."""
        key = ("tag", int(task_id))
        memo = self._memo()
        if key not in memo:
            memo[key] = self._first(self.tags_by_task(task_id), f"tag for task {task_id}")
        return memo[key]

    def task_by_id(self, task_id: int) -> Row:
        key = ("task", int(task_id))
        memo = self._memo()
        if key not in memo:
            memo[key] = self._first(self.tasks_by_id(task_id), f"task with id {task_id}")
        return memo[key]

    def enabled_tag_rows(self) -> list[Row]:
        """Enabled tags in id order; one row per tag of the catalog."""
        memo = self._memo()
        if "enabled" not in memo:
            memo["enabled"] = self._by_id(self._enabled())
        return memo["enabled"]

    def enabled_task_ids(self) -> list[int]:
        return sorted({int(t["tag_task_id"]) for t in self.enabled_tag_rows()})

    def prefetch(self, task_ids=None) -> None:
        """Fetch tags, tasks and rules of ``task_ids`` (default: enabled) at once."""
        ids = [int(i) for i in (task_ids if task_ids is not None else self.enabled_task_ids())]
        if not ids:
            return
        memo = self._memo()
        wanted = F.col("tag_task_id").isin(ids)
        for row in self._by_id(self.tag_info.where(wanted).select(*TAG_BY_TASK_COLUMNS)):
            memo.setdefault(("tag", int(row["tag_task_id"])), row)
        for row in self._by_id(self.task_info.where(F.col("id").isin(ids))):
            memo.setdefault(("task", int(row["id"])), row)
        rules: dict[int, list[Row]] = {i: [] for i in ids}
        for row in self._by_id(self._rules(F.col("task_id").isin(ids))):
            rules[int(row["task_id"])].append(row)
        for i, rows in rules.items():
            memo[("rules", i)] = rows

    def rule_rows(self, task_id: int, tag_code: str | None = None) -> list[Row]:
        """Label rules in first-match order, with the match mode resolved."""
        key = ("rules", int(task_id))
        memo = self._memo()
        if key not in memo:
            memo[key] = self._by_id(self._rules(F.col("task_id") == F.lit(int(task_id))))
        default = MATCH_PREDICATE if (tag_code or "").upper() == PREDICATE_TAG_CODE else MATCH_EXACT
        out = []
        for r in memo[key]:
            mode = (r["match_mode"] or default).lower()
            if mode not in (MATCH_EXACT, MATCH_PREDICATE):
                raise CatalogError(f"rule {r['id']}: unknown match_mode {r['match_mode']!r}")
            out.append(Row(**{**r.asDict(), "match_mode": mode}))
        return out

    def validate(self) -> None:
        """Fail before any work if an enabled tag cannot run.

        Checks every enabled tag: a known value type, a task with SQL, rules
        with a known match mode, and text typing when it has labels; and that
        no two enabled tags share a wide column name.
        """
        tags = self.enabled_tag_rows()
        self.prefetch()
        problems = []
        seen: dict[str, str] = {}
        by_task: dict[int, str] = {}
        for tag in tags:
            code = tag["tag_code"] or ""
            try:
                value_type(tag["tag_value_type"])
            except CatalogError as err:
                problems.append(f"{code}: {err}")
            task = self.task_by_id(tag["tag_task_id"])
            if not (task["task_sql"] or "").strip():
                problems.append(f"{code}: task {task['id']} has no SQL")
            try:
                rules = self.rule_rows(tag["tag_task_id"], code)
            except CatalogError as err:
                problems.append(f"{code}: {err}")
                rules = []
            if rules and str(tag["tag_value_type"]) not in (TYPE_STRING, TYPE_DATE):
                problems.append(f"{code}: labelled tags must be string or date typed")
            other = by_task.setdefault(int(tag["tag_task_id"]), code)
            if other != code:
                problems.append(f"{code}: task {tag['tag_task_id']} already computes {other}; one task computes one tag")
            if code.lower() in seen or code.lower() == "uid":
                problems.append(f"{code}: wide column {code.lower()!r} collides with {seen.get(code.lower(), 'uid')}")
            seen[code.lower()] = code
        if problems:
            raise CatalogError("catalog cannot run: " + "; ".join(problems))
