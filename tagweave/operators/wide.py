"""Merge: UNION ALL of the enabled tags' slices, pivoted to one row per uid.

Plan shape: one Parquet scan per stored value type (at most four, whatever the
number of tags; only ``uid, query_value`` of the date's slices is read, the tag
comes from the folder a row was read from), a union, and two narrow shuffles:
``max`` per (uid, tag), reduced on the map side, so a uid that repeats many times
inside a tag collapses before anything gathers by uid; then at most one row per
(uid, tag) by uid, where the pivot runs in the same stage. No shuffled row
carries a column per tag, so bytes grow with the cells, not with tags times cells.

The pivot has two levels: tags are numbered, about sqrt(N) neighbours are a group;
a group's cells become one row of its columns, then a uid's groups become
one row. A cell so meets 2 * sqrt(N) conditions instead of N.

The table that is stored goes by ranges of uid instead of its hash in the second shuffle:
the pivot needs no other, and every file is one sorted range that the export and
the bitmaps take as it is.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil, sqrt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagweave.sources.catalog import local_frame
from tagweave.sources.store import ProfileStore

UNION_SCHEMA = T.StructType(
    [
        T.StructField("uid", T.StringType()),
        T.StructField("query_value", T.StringType()),
        T.StructField("tag_code", T.StringType()),
    ]
)


def tag_branch(tag_rows: DataFrame, tag_code: str) -> DataFrame:
    """``select uid, query_value, '<TAG_CODE>' tag_code``; value as text.

    Each branch casts from its own catalog type, so the text of a value does
    not depend on which other tags are in the union.
    """
    return tag_rows.select(
        F.col("uid").cast(T.StringType()).alias("uid"),
        F.col("query_value").cast(T.StringType()).alias("query_value"),
        F.lit(tag_code).alias("tag_code"),
    )


def union_tags(branches: Sequence[DataFrame], spark: SparkSession | None = None) -> DataFrame:
    """N-way UNION ALL of tag branches (Catalyst flattens it to one Union)."""
    if not branches:
        if spark is None:
            raise ValueError("an empty union needs a session")
        return spark.createDataFrame([], UNION_SCHEMA)
    names = UNION_SCHEMA.fieldNames()
    aligned = [b if b.columns == names else b.select(*names) for b in branches]
    return reduce(DataFrame.union, aligned)


def wide_columns(tag_codes: Sequence[str]) -> list[str]:
    cols = [c.lower() for c in tag_codes]
    dup = {c for c in cols if cols.count(c) > 1}
    if dup or "uid" in cols:
        raise ValueError(f"tag codes collide as wide columns: {sorted(dup | ({'uid'} & set(cols)))}")
    return cols


_NUMBERS = T.StructType([T.StructField("tag_code", T.StringType()), T.StructField("tag", T.IntegerType())])
#: Up to this many tags one level costs less than two.
ONE_LEVEL_TAGS = 8


def pivot_cells(cells: DataFrame, columns: Sequence[str], clustered: bool = False) -> DataFrame:
    """``uid`` and one column per tag from (uid, query_value, tag), ``tag`` being the column's position.

    Several values of one uid in one tag resolve by text ``max``; a row with a
    null ``tag`` only makes its uid appear. ``clustered``: partitions are ranges of
    uid and sorted by it (bounds are sampled from the reduced cells, at most one a uid and tag).
    """
    if not columns:
        return cells.select("uid").limit(0)
    reduced = cells.groupBy("uid", "tag").agg(F.max("query_value").alias("query_value"))
    if clustered:
        return _pivot_reduced(reduced.repartitionByRange("uid"), columns).sortWithinPartitions("uid")
    return _pivot_reduced(reduced.repartition("uid"), columns)


def _pivot_reduced(reduced: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per uid from at most one cell per (uid, tag); a uid's cells share a partition."""
    if len(columns) <= ONE_LEVEL_TAGS:
        one = reduced.groupBy("uid").agg(*[F.max(F.when(F.col("tag") == i, F.col("query_value"))).alias(c) for i, c in enumerate(columns)])
        return one.select("uid", *columns)
    width = ceil(sqrt(len(columns)))
    groups = ceil(len(columns) / width)
    slot, group = F.pmod("tag", F.lit(width)), F.floor(F.col("tag") / width).cast("int")
    inner = reduced.groupBy("uid", group.alias("_group")).agg(
        *[F.max(F.when(slot == j, F.col("query_value"))).alias(f"_s{j}") for j in range(width)]
    )
    parts = F.struct(*[f"_s{j}" for j in range(width)])
    outer = inner.groupBy("uid").agg(
        *[F.first(F.when(F.col("_group") == g, parts), ignorenulls=True).alias(f"_g{g}") for g in range(groups)]
    )
    return outer.select("uid", *[F.col(f"_g{i // width}._s{i % width}").alias(c) for i, c in enumerate(columns)])


def pivot_tags(union: DataFrame, tag_codes: Sequence[str]) -> DataFrame:
    """``pivot(max(query_value) for tag_code in (codes))`` grouped by uid.

    Codes are listed, so no discovery pass is needed; they match
    literally (original case) and columns are lower case. A uid with
    only other codes has a row of NULLs.
    """
    columns = wide_columns(tag_codes)
    if not tag_codes:
        return union.select("uid").limit(0)
    numbers = local_frame(union.sparkSession, [(c, i) for i, c in enumerate(tag_codes)], _NUMBERS)  # a row a tag
    return pivot_cells(union.join(F.broadcast(numbers), "tag_code", "left").select("uid", "query_value", "tag"), columns)


def build_wide(
    store: ProfileStore,
    tags: Sequence,
    execute_date: str,
    missing_ok: bool = False,
    clustered: bool = False,
) -> DataFrame:
    """Wide rows of a date from the stored tag slices of ``tags`` (id order).

    A tag without a table, or without a slice for the date (never computed),
    is an error naming it; with ``missing_ok`` its column is all NULL instead.
    A slice that was computed and has no rows is no error. ``clustered``: see :func:`pivot_cells`.
    """
    codes = [t["tag_code"] for t in tags]
    columns = wide_columns(codes)
    return pivot_cells(store.read_tags(codes, execute_date, missing_ok), columns, clustered)
