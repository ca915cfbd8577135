"""Registered queries over the sample warehouse and their DuckDB oracles.

Each query runs the engine on the given tables (``sf_dir``) with the sample
catalog of :mod:`tagweave.plans.seed`; each oracle computes the same result
in plain SQL, written independently of the engine: labels as CASE text,
merge as ``max(case ...)``, unpivot as UNION ALL, bitmaps as
``count(distinct uid)``. Values leave both sides as text or BIGINT.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tagweave.codes import BITMAP_TABLES, MATCH_EXACT, MATCH_PREDICATE, TYPE_DECIMAL, TYPE_STRING
from tagweave.functions.templating import render_sql
from tagweave.operators.bitmap import cardinality, decode, unpivot_tags
from tagweave.operators.tags import LabelRule, build_tag, tag_frame
from tagweave.operators.wide import build_wide, tag_branch, union_tags
from tagweave.plans import jobs
from tagweave.plans.seed import EXECUTE_DATE, SEED_TABLES, SEED_TAGS, seed_catalog
from tagweave.session import scratch_dir
from tagweave.sources.store import ProfileStore
from tagweave.sources.warehouse import register_parquet_views

D = EXECUTE_DATE
D_OLD = "1998-01-01"
D_PREV = "2024-01-10"

_SQL = {tid: sql for tid, _code, _type, _status, sql in SEED_TAGS}
_CODE = {tid: code for tid, code, _type, _status, _sql in SEED_TAGS}
_TYPE = {tid: vtype for tid, _code, vtype, _status, _sql in SEED_TAGS}
ENABLED = [tid for tid, _c, _t, status, _s in SEED_TAGS if status == "1"]

# Tag with several rows per uid (one per order / line), for the text max.
DUP_TAGS = [
    (1, "TAG_ORDER_PRIORITY", "3", "1",
     "select cast(o_custkey as string) uid, o_orderpriority query_value from orders"),
    (2, "TAG_LINE_QTY", "1", "1",
     "select cast(o_custkey as string) uid, cast(l_quantity as bigint) query_value "
     "from orders join lineitem on l_orderkey = o_orderkey"),
]
# Task 8 after an edit that makes it return no rows for recent dates.
DORMANT_EVENT_SQL = (
    "select cast(user_id as string) uid, count(*) query_value from events "
    "where cast(ts as date) < date_sub(cast('executeDate' as date), 30) group by user_id"
)
# Two-tag catalog (decimal + string) for the bitmap slice clearing case.
SLICE_TAGS = [t for t in SEED_TAGS if t[0] in (1, 3)]
# A tag with rows and one whose SQL returns none for the date.
EMPTY_TAGS = [SEED_TAGS[0], (8, "TAG_EVENT_COUNT", "1", "1", DORMANT_EVENT_SQL.replace("date_sub(cast('executeDate' as date), 30)", "cast('1990-01-01' as date)"))]
# Sixty tags over the customers, several values each, some without a row.
MANY_TAGS = [
    (i, f"TAG_MANY_{i}", "1", "1",
     f"select cast(c_custkey as string) uid, c_custkey % {i + 1} query_value from customer where c_custkey % 3 <> {i % 4}")
    for i in range(1, 61)
]
TWO_DATE_TAGS = [t for t in SEED_TAGS if t[0] in (1, 2)]


# ---------------------------------------------------------------- helpers --
def _setup(spark: SparkSession, sf_dir: str, label: str, **catalog_kwargs):
    register_parquet_views(spark, sf_dir, SEED_TABLES)
    catalog = seed_catalog(spark, **catalog_kwargs)
    store = ProfileStore(spark, root=scratch_dir(spark, label))
    return catalog, store


def _inputs(spark: SparkSession, sf_dir: str) -> tuple:
    """What the day is made from: the warehouse files with their sizes and times."""
    found = []
    for table in SEED_TABLES:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{table}.parquet")
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for status in fs.globStatus(path) or []:
            files = fs.listStatus(path) if status.isDirectory() else [status]
            found += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files]
    return tuple(sorted(found))


_DAY_LOCK = threading.Lock()
_DAYS: dict[tuple, ProfileStore] = {}


def seed_day(spark: SparkSession, sf_dir: str) -> tuple:
    """Store holding one full seed day (tags, wide, export, bitmaps).

    Built once per application and warehouse files and reused by the merge,
    export and bitmap queries, which only read it.
    """
    key = (spark.sparkContext.applicationId, _inputs(spark, sf_dir))
    with _DAY_LOCK:
        store = _DAYS.get(key)
        if store is None or not store.published(store.export_path(D)):
            catalog, store = _setup(spark, sf_dir, "seed-day")
            jobs.run_day(spark, catalog, store, D)
            _DAYS[key] = store
        else:
            register_parquet_views(spark, sf_dir, SEED_TABLES)
        return seed_catalog(spark), store


def _text(df: DataFrame) -> DataFrame:
    return df.withColumn("query_value", F.col("query_value").cast("string"))


def _all_bitmaps(store: ProfileStore, date: str | None = D) -> DataFrame:
    """The four typed tables as one frame, value as text."""
    parts = [
        jobs.read_bitmaps(store, code, date).withColumn("tag_value", F.col("tag_value").cast("string"))
        for code in BITMAP_TABLES
    ]
    return reduce(DataFrame.unionByName, parts)


# ---------------------------------------------------------- tag queries --
def _tag(task_id: int, text: bool = False):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        catalog, _ = _setup(spark, sf_dir, "tag")
        df = build_tag(spark, catalog, task_id, D)
        if text:
            assert df.schema["query_value"].dataType == DecimalType(16, 2)
        return _text(df) if text else df

    return query


# A decimal value under label rules that only exact comparison gets right.
EXACT_DECIMAL_SQL = "select cast(c_custkey as string) uid, cast(c_nationkey / 4.0 as decimal(16,2)) query_value from customer"
EXACT_DECIMAL_RULES = [
    (1, "0.250", "quarter"), (2, "1.005", "never"), (3, "1", "one"), (4, "1.5e0", "one and a half"), (5, "x", "never"),
    (6, "2.004", "never"), (7, "02.00", "two"), (8, "1.00", "second rule"),
]


def tag_exact_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact rules on DECIMAL(16,2): equal numbers match, a rule of three places never does."""
    register_parquet_views(spark, sf_dir, SEED_TABLES)
    rules = [LabelRule(i, value, label, MATCH_EXACT) for i, value, label in EXACT_DECIMAL_RULES]
    return tag_frame(spark, EXACT_DECIMAL_SQL, D, TYPE_STRING, rules)


def tag_exact_unmatched_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog, _ = _setup(spark, sf_dir, "tag")
    df = build_tag(spark, catalog, 5, D)
    return df.groupBy("query_value").agg(F.count("*").alias("n_uids"))


def tag_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write two dates, rewrite the first, read the whole table."""
    catalog, store = _setup(spark, sf_dir, "overwrite")
    for date in (D, D_OLD, D):
        jobs.run_tag_job(spark, catalog, store, 2, date)
    return store.read_tag(_CODE[2], _TYPE[2])


def tag_empty_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date whose rewrite returns no rows ends up empty; others stay."""
    catalog, store = _setup(spark, sf_dir, "empty")
    for date in (D, D_PREV):
        jobs.run_tag_job(spark, catalog, store, 8, date)
    edited = seed_catalog(spark, sql_overrides={8: DORMANT_EVENT_SQL})
    jobs.run_tag_job(spark, edited, store, 8, D_PREV)
    return store.read_tag(_CODE[8], _TYPE[8])


# Task 2 after an edit that fails on every row.
FAILING_SQL = f"select uid, cast(raise_error('the edited SQL fails') as bigint) query_value from ({_SQL[2]}) t"
# Task 2's values as text, as after a change of the tag's type.
AS_TEXT_TAGS = [(2, _CODE[2], TYPE_STRING, "1", f"select uid, concat('n', query_value) query_value from ({_SQL[2]}) t")]
# The date bound as a parameter, beside the token in quotes that stays as it is.
BOUND_SQL = (
    "select cast(o_custkey as string) uid, count(*) query_value from orders "
    "where o_orderdate <= cast(:executeDate as date) and 'executeDate' = concat('execute', 'Date') group by o_custkey"
)
# A thousand price ranges, overlapping, with one other fragment among them.
RANGE_SQL = "select cast(o_orderkey as string) uid, cast(o_totalprice as decimal(16,2)) query_value from orders"
RANGE_RULES = [(f"between {i * 400} and {i * 400 + 600}", f"band {i}") for i in range(1000)]
RANGE_RULES.insert(100, ("in (1, 2) or query_value % 1000 < 100", "round"))


def tag_failed_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date whose rewrite failed is read as it was; nothing is put right in between."""
    catalog, store = _setup(spark, sf_dir, "failed")
    for date in (D, D_OLD):
        jobs.run_tag_job(spark, catalog, store, 2, date)
    edited = seed_catalog(spark, sql_overrides={2: FAILING_SQL})
    try:
        jobs.run_tag_job(spark, edited, store, 2, D)
    except PySparkException:
        return store.read_tag(_CODE[2], _TYPE[2])
    raise AssertionError("the rewrite was meant to fail")


def tag_type_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date stored before its tag's type changed is read beside one stored after."""
    catalog, store = _setup(spark, sf_dir, "type-change")
    jobs.run_tag_job(spark, catalog, store, 2, D_OLD)
    changed = seed_catalog(spark, tags=AS_TEXT_TAGS, labels=[], rules=[])
    jobs.run_tag_job(spark, changed, store, 2, D)
    return store.read_tag(_CODE[2], TYPE_STRING)


def tag_bound_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored SQL with the parameter marker ``:executeDate``."""
    register_parquet_views(spark, sf_dir, SEED_TABLES)
    return tag_frame(spark, BOUND_SQL, D_OLD, "1")


def tag_predicate_many_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A thousand range rules, looked up in disjoint intervals; first match wins."""
    register_parquet_views(spark, sf_dir, SEED_TABLES)
    rules = [LabelRule(i, fragment, label, MATCH_PREDICATE) for i, (fragment, label) in enumerate(RANGE_RULES)]
    return tag_frame(spark, RANGE_SQL, D, TYPE_STRING, rules)


# -------------------------------------------------------- merge queries --
def merge_union_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog, store = seed_day(spark, sf_dir)
    branches = [
        tag_branch(store.read_tag(t["tag_code"], t["tag_value_type"], D), t["tag_code"])
        for t in catalog.enabled_tag_rows()
    ]
    return union_tags(branches, spark)


def merge_wide_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog, store = seed_day(spark, sf_dir)
    return build_wide(store, catalog.enabled_tag_rows(), D)


def merge_duplicate_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog, store = _setup(spark, sf_dir, "dup", tags=DUP_TAGS, labels=[], rules=[])
    for task_id in jobs.enabled_task_ids(catalog):
        jobs.run_tag_job(spark, catalog, store, task_id, D)
    return jobs.merge_frame(catalog, store, D)


def merge_disabled_excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-NULL cells per wide column: the disabled tag has no column."""
    _, store = seed_day(spark, sf_dir)
    wide = store.read_wide(D)
    cols = [c for c in wide.columns if c != "uid"]
    long = wide.unpivot("uid", cols, "tag_code", "tag_value")
    return long.groupBy("tag_code").agg(F.count("tag_value").alias("n_values"))


def merge_wide_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, store = seed_day(spark, sf_dir)
    return store.read_wide(D)


def export_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, store = seed_day(spark, sf_dir)
    return store.read_export(D)


def export_file_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the export and how many of its files overlap an earlier one's range of uid."""
    _, store = seed_day(spark, sf_dir)
    uid = F.col("uid")
    files = store.read_export(D).groupBy(F.col("_metadata.file_path").alias("file"))
    files = files.agg(F.min(uid).alias("first"), F.max(uid).alias("last"), F.count("*").alias("n"))
    before = F.max("last").over(Window.orderBy("first", "file").rowsBetween(Window.unboundedPreceding, -1))  # a row a file
    ranges = files.select("n", (F.col("first") <= before).alias("overlaps"))
    return ranges.agg(F.sum("n").alias("n_uids"), F.count_if("overlaps").alias("n_overlaps"))


def merge_empty_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tag that was computed and has no rows for the date gives a NULL column."""
    catalog, store = _setup(spark, sf_dir, "empty-slice", tags=EMPTY_TAGS, labels=[], rules=[])
    for task_id in jobs.enabled_task_ids(catalog):
        jobs.run_tag_job(spark, catalog, store, task_id, D)
    return jobs.merge_frame(catalog, store, D)


def merge_many_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixty tags in slices of their own, merged into one wide table."""
    catalog, store = _setup(spark, sf_dir, "many", tags=MANY_TAGS, labels=[], rules=[])
    jobs.run_tag_jobs(spark, catalog, store, D)
    jobs.run_merge_job(spark, catalog, store, D)
    return store.read_wide(D)


# ------------------------------------------------------- bitmap queries --
def bitmap_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, store = seed_day(spark, sf_dir)
    wide = store.read_wide(D)
    return unpivot_tags(wide, [c for c in wide.columns if c != "uid"])


def bitmap_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, store = seed_day(spark, sf_dir)
    return cardinality(_all_bitmaps(store))


def _cardinality_with(spark: SparkSession, sf_dir: str, label: str, options) -> DataFrame:
    catalog, store = seed_day(spark, sf_dir)
    other = ProfileStore(spark, root=scratch_dir(spark, label))
    other.write_wide(store.read_wide(D), D)
    jobs.run_bitmap_job(spark, catalog, other, D, options)
    return cardinality(_all_bitmaps(other))


def bitmap_cardinality_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same cardinalities with every group stored as a bitmap."""
    return _cardinality_with(spark, sf_dir, "plain", jobs.BitmapOptions(layout="bitmap"))


def bitmap_cardinality_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same cardinalities with ``auto`` routing low-cardinality tags to bitmaps.

    The density bar is lowered so that both paths run on small tables.
    """
    options = jobs.BitmapOptions(layout="auto", dense_min_ids_per_group=64, first_run_scan=True)
    return _cardinality_with(spark, sf_dir, "mixed", options)


def bitmap_decode_uids(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, store = seed_day(spark, sf_dir)
    return decode(_all_bitmaps(store))


# Customers under ids that fill the unsigned 64 bits, on both sides of 2^63.
UNSIGNED_TAGS = [
    (1, "TAG_UNSIGNED", TYPE_STRING, "1",
     "select cast(case when c_custkey % 2 = 0 then cast('18446744073709551615' as decimal(20,0)) - c_custkey "
     "else cast('9223372036854775807' as decimal(20,0)) + c_custkey - 100 end as string) uid, c_mktsegment query_value from customer")
]


def bitmap_unsigned_uids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """uids beyond BIGINT through all jobs, decoded as unsigned numbers."""
    catalog, store = _setup(spark, sf_dir, "unsigned", tags=UNSIGNED_TAGS, labels=[], rules=[])
    jobs.run_day(spark, catalog, store, D)
    found = decode(jobs.read_bitmaps(store, TYPE_STRING, D), all_unsigned=True)
    return found.withColumn("uid", F.col("uid").cast("string"))


def bitmap_cardinality_two_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct uids over two dates' states: a uid of both dates counts once."""
    catalog, store = _setup(spark, sf_dir, "two-dates", tags=TWO_DATE_TAGS, labels=[], rules=[])
    for date in (D_OLD, D):
        jobs.run_day(spark, catalog, store, date)
    return cardinality(_all_bitmaps(store, None))


def bitmap_route_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per typed table: tags, (tag, value) pairs and uid references."""
    _, store = seed_day(spark, sf_dir)
    parts = []
    for code, table in BITMAP_TABLES.items():
        counts = cardinality(jobs.read_bitmaps(store, code, D)).agg(
            F.countDistinct("tag_code").alias("n_tags"),
            F.count("*").alias("n_pairs"),
            F.coalesce(F.sum("cardinality"), F.lit(0)).cast("bigint").alias("n_refs"),
        )
        parts.append(counts.select(F.lit(table).alias("bitmap_table"), "*"))
    return reduce(DataFrame.unionByName, parts)


def _typed(type_code: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        _, store = seed_day(spark, sf_dir)
        out = cardinality(jobs.read_bitmaps(store, type_code, D))
        if type_code == TYPE_DECIMAL:
            assert out.schema["tag_value"].dataType == DecimalType(16, 2)
            out = out.withColumn("tag_value", F.col("tag_value").cast("string"))
        return out

    return query


def bitmap_slice_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A type with no enabled tag has its date slice cleared, others kept."""
    catalog, store = _setup(spark, sf_dir, "slice", tags=SLICE_TAGS, labels=[], rules=[])
    for date in (D, D_PREV):
        jobs.run_day(spark, catalog, store, date)
    without_decimal = seed_catalog(spark, tags=SLICE_TAGS, labels=[], rules=[], status_overrides={3: "0"})
    jobs.run_merge_job(spark, without_decimal, store, D_PREV)
    jobs.run_bitmap_job(spark, without_decimal, store, D_PREV)
    bitmaps = jobs.read_bitmaps(store, TYPE_DECIMAL).withColumn(
        "tag_value", F.col("tag_value").cast("string")
    )
    return cardinality(bitmaps, keys=("tag_code", "tag_value", "dt"))


def profile_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: every enabled tag -> wide -> bitmaps -> cardinality."""
    catalog, store = _setup(spark, sf_dir, "profile")
    jobs.run_day(spark, catalog, store, D)
    return cardinality(_all_bitmaps(store))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "tag_string_passthrough": _tag(1),
        "tag_long_count": _tag(2),
        "tag_decimal_spend": _tag(3, text=True),
        "tag_date_last_order": _tag(4),
        "tag_exact_region": _tag(5),
        "tag_exact_unmatched_null": tag_exact_unmatched_null,
        "tag_predicate_zodiac": _tag(6),
        "tag_predicate_first_match": _tag(7),
        "tag_event_count": _tag(8),
        "tag_exact_decimal": tag_exact_decimal,
        "tag_window_sql": _tag(9),
        "tag_partition_overwrite": tag_partition_overwrite,
        "tag_empty_overwrite": tag_empty_overwrite,
        "tag_failed_rewrite": tag_failed_rewrite,
        "tag_type_change": tag_type_change,
        "tag_bound_date": tag_bound_date,
        "tag_predicate_many_ranges": tag_predicate_many_ranges,
        "merge_union_long": merge_union_long,
        "merge_wide_pivot": merge_wide_pivot,
        "merge_duplicate_max": merge_duplicate_max,
        "merge_disabled_excluded": merge_disabled_excluded,
        "merge_wide_table": merge_wide_table,
        "merge_empty_slice": merge_empty_slice,
        "merge_many_tags": merge_many_tags,
        "export_clustered": export_clustered,
        "export_file_ranges": export_file_ranges,
        "bitmap_unpivot": bitmap_unpivot,
        "bitmap_route_types": bitmap_route_types,
        "bitmap_cardinality": bitmap_cardinality,
        "bitmap_cardinality_plain": bitmap_cardinality_plain,
        "bitmap_cardinality_mixed": bitmap_cardinality_mixed,
        "bitmap_cardinality_two_dates": bitmap_cardinality_two_dates,
        "bitmap_decode_uids": bitmap_decode_uids,
        "bitmap_unsigned_uids": bitmap_unsigned_uids,
        "bitmap_typed_long": _typed("1"),
        "bitmap_typed_decimal": _typed("2"),
        "bitmap_typed_string": _typed(TYPE_STRING),
        "bitmap_typed_date": _typed("4"),
        "bitmap_slice_delete": bitmap_slice_delete,
        "profile_end_to_end": profile_end_to_end,
    }


# ================================================================ oracle ==
def _o(task_id: int, date: str = D, sql: str | None = None) -> str:
    """A seed tag's SQL for a date (catalog content, the same on both sides)."""
    return "(" + render_sql(sql or _SQL[task_id], date) + ")"


# Label rules written out as SQL CASE text (first match wins, no ELSE).
_REGION_CASE = (
    "case query_value when 0 then 'AFRICA' when 1 then 'AMERICA' "
    "when 2 then 'ASIA' when 3 then 'EUROPE' end"
)
_ZODIAC_CASE = (
    "case when query_value between '12-22' and '12-31' then 'Capricorn' "
    "when query_value between '01-01' and '01-19' then 'Capricorn' "
    "when query_value between '01-20' and '02-18' then 'Aquarius' "
    "when query_value between '02-19' and '03-20' then 'Pisces' "
    "when query_value between '03-21' and '04-19' then 'Aries' "
    "when query_value between '04-20' and '05-20' then 'Taurus' "
    "when query_value between '05-21' and '06-20' then 'Gemini' "
    "when query_value between '06-21' and '07-22' then 'Cancer' "
    "when query_value between '07-23' and '08-22' then 'Leo' "
    "when query_value between '08-23' and '09-22' then 'Virgo' "
    "when query_value between '09-23' and '10-22' then 'Libra' "
    "when query_value between '10-23' and '11-21' then 'Scorpio' "
    "when query_value between '11-22' and '12-21' then 'Sagittarius' end"
)
_BAND_CASE = (
    "case when query_value >= 3000000 then 'high' when query_value >= 1500000 then 'mid' "
    "when query_value >= 0 then 'low' end"
)
_LABELS = {5: _REGION_CASE, 6: _ZODIAC_CASE, 7: _BAND_CASE}


def _o_tag(task_id: int, date: str = D) -> str:
    """``uid, query_value`` of a tag as stored (labels applied)."""
    value = _LABELS.get(task_id, "query_value")
    return f"select uid, {value} as query_value from {_o(task_id, date)} t"


def _o_tags(tags=None) -> str:
    """UNION ALL of the enabled tags: uid, text value, tag code."""
    ids = tags or ENABLED
    return " union all ".join(
        f"select uid, cast(query_value as varchar) as query_value, '{_CODE[i]}' as tag_code "
        f"from ({_o_tag(i)}) b{i}"
        for i in ids
    )


def _o_wide(tags=None) -> str:
    ids = tags or ENABLED
    cols = ", ".join(
        f"max(case when tag_code = '{_CODE[i]}' then query_value end) as {_CODE[i].lower()}"
        for i in ids
    )
    return f"select uid, {cols} from ({_o_tags(ids)}) u group by uid"


def _o_unpivot(tags=None) -> str:
    ids = tags or ENABLED
    return " union all ".join(
        f"select uid, '{_CODE[i].lower()}' as tag_code, {_CODE[i].lower()} as tag_value "
        f"from w where {_CODE[i].lower()} is not null and {_CODE[i].lower()} <> ''"
        for i in ids
    )


def _o_pairs(tags=None) -> str:
    """``with w as (wide), p as (unpivoted non-empty cells)``."""
    return f"with w as ({_o_wide(tags)}), p as ({_o_unpivot(tags)}) "


_O_CARD = _o_pairs() + (
    "select tag_code, tag_value, count(distinct uid) as cardinality from p group by tag_code, tag_value"
)


def _o_typed(type_code: str) -> str:
    ids = [i for i in ENABLED if _TYPE[i] == type_code]
    value = "cast(tag_value as bigint)" if type_code == "1" else "tag_value"
    return _o_pairs(ids) + (
        f"select tag_code, {value} as tag_value, count(distinct uid) as cardinality "
        f"from p group by tag_code, tag_value"
    )


def _o_route() -> str:
    mapping = " union all ".join(
        f"select '{_CODE[i].lower()}' as tag_code, '{BITMAP_TABLES[_TYPE[i]]}' as bitmap_table"
        for i in ENABLED
    )
    tables = " union all ".join(f"select '{t}' as bitmap_table" for t in BITMAP_TABLES.values())
    return _o_pairs() + (
        f", m as ({mapping}), t as ({tables}), "
        "c as (select tag_code, tag_value, count(distinct uid) as n from p group by tag_code, tag_value) "
        "select t.bitmap_table, count(distinct c.tag_code) as n_tags, count(c.tag_code) as n_pairs, "
        "cast(coalesce(sum(c.n), 0) as bigint) as n_refs "
        "from t left join m on m.bitmap_table = t.bitmap_table "
        "left join c on c.tag_code = m.tag_code group by t.bitmap_table"
    )


def _o_dup() -> str:
    sql = {tid: s for tid, _c, _t, _st, s in DUP_TAGS}
    return (
        "select uid, max(case when tag_code = 'TAG_ORDER_PRIORITY' then query_value end) as tag_order_priority, "
        "max(case when tag_code = 'TAG_LINE_QTY' then query_value end) as tag_line_qty from ("
        f"select uid, cast(query_value as varchar) as query_value, 'TAG_ORDER_PRIORITY' as tag_code from ({sql[1]}) a "
        f"union all select uid, cast(query_value as varchar) as query_value, 'TAG_LINE_QTY' as tag_code from ({sql[2]}) b"
        ") u group by uid"
    )


def _o_disabled() -> str:
    return _o_pairs() + (
        "select tag_code, count(*) as n_values from ("
        + " union all ".join(
            f"select '{_CODE[i].lower()}' as tag_code, {_CODE[i].lower()} as v from w "
            f"where {_CODE[i].lower()} is not null"
            for i in ENABLED
        )
        + ") x group by tag_code"
    )


def _o_slice() -> str:
    return (
        "select 'tag_order_spend' as tag_code, cast(query_value as varchar) as tag_value, "
        f"'{D}' as dt, count(distinct uid) as cardinality from ({_o_tag(3)}) s "
        "where query_value is not null group by query_value"
    )


def _o_exact_decimal() -> str:
    case = "case v when 0.25 then 'quarter' when 1.00 then 'one' when 1.50 then 'one and a half' when 2.00 then 'two' end"
    source = "select cast(c_custkey as varchar) as uid, cast(c_nationkey / 4.0 as decimal(16,2)) as v from customer"
    return f"select uid, {case} as query_value from ({source}) t"


def _o_many() -> str:
    branches = " union all ".join(
        f"select cast(c_custkey as varchar) as uid, cast(c_custkey % {i + 1} as varchar) as v, {i} as t "
        f"from customer where c_custkey % 3 <> {i % 4}"
        for i in range(1, 61)
    )
    cells = ", ".join(f"max(case when t = {i} then v end) as tag_many_{i}" for i in range(1, 61))
    return f"select uid, {cells} from ({branches}) u group by uid"


def _o_two_dates() -> str:
    parts = " union all ".join(
        f"select uid, '{_CODE[i].lower()}' as tag_code, cast(query_value as varchar) as tag_value from ({_o_tag(i, d)}) x"
        for i in (1, 2) for d in (D_OLD, D)
    )
    return (
        f"select tag_code, tag_value, count(distinct uid) as cardinality from ({parts}) u "
        "where tag_value is not null and tag_value <> '' group by tag_code, tag_value"
    )


_O_TWO_DATES_OF_2 = (
    f"select uid, query_value, '{D}' as dt from ({_o_tag(2, D)}) a "
    f"union all select uid, query_value, '{D_OLD}' as dt from ({_o_tag(2, D_OLD)}) b"
)


def _o_ranges() -> str:
    """The first rule by number of those that hold, as a join with the rules' bounds."""
    rules = ", ".join(
        f"({i}, {f.split()[1]}, {f.split()[3]}, '{label}')" for i, (f, label) in enumerate(RANGE_RULES) if f.startswith("between")
    )
    other = next(i for i, (f, _) in enumerate(RANGE_RULES) if not f.startswith("between"))
    return f"""
with v as (select cast(o_orderkey as varchar) as uid, cast(o_totalprice as decimal(16,2)) as x from orders),
r as (select * from (values {rules}) t(i, lo, hi, label)),
hits as (
  select uid, i, label from v join r on x >= lo and x <= hi
  union all select uid, {other}, 'round' from v where x in (1, 2) or x % 1000 < 100
)
select v.uid, first.label as query_value from v left join (select uid, min_by(label, i) as label from hits group by uid) first on v.uid = first.uid
"""


def oracle_sql() -> dict[str, str]:
    wide = _o_wide()
    return {
        "tag_string_passthrough": _o_tag(1),
        "tag_long_count": _o_tag(2),
        "tag_decimal_spend": f"select uid, cast(query_value as varchar) as query_value from ({_o_tag(3)}) t3",
        "tag_date_last_order": _o_tag(4),
        "tag_exact_region": _o_tag(5),
        "tag_exact_unmatched_null": (
            f"select query_value, count(*) as n_uids from ({_o_tag(5)}) t5 group by query_value"
        ),
        "tag_predicate_zodiac": _o_tag(6),
        "tag_predicate_first_match": _o_tag(7),
        "tag_event_count": _o_tag(8),
        "tag_exact_decimal": _o_exact_decimal(),
        "tag_window_sql": _o_tag(9),
        "tag_partition_overwrite": _O_TWO_DATES_OF_2,
        "tag_failed_rewrite": _O_TWO_DATES_OF_2,
        "tag_type_change": (
            f"select uid, 'n' || query_value as query_value, '{D}' as dt from ({_o_tag(2, D)}) a "
            f"union all select uid, cast(query_value as varchar) as query_value, '{D_OLD}' as dt from ({_o_tag(2, D_OLD)}) b"
        ),
        "tag_bound_date": (
            "select cast(o_custkey as varchar) as uid, count(*) as query_value from orders "
            f"where o_orderdate <= date '{D_OLD}' group by o_custkey"
        ),
        "tag_predicate_many_ranges": _o_ranges(),
        "tag_empty_overwrite": f"select uid, query_value, '{D}' as dt from ({_o_tag(8, D)}) a",
        "merge_union_long": _o_tags(),
        "merge_wide_pivot": wide,
        "merge_duplicate_max": _o_dup(),
        "merge_disabled_excluded": _o_disabled(),
        "merge_wide_table": wide,
        "merge_empty_slice": f"select uid, query_value as tag_cust_segment, cast(null as varchar) as tag_event_count from ({_o_tag(1)}) t1",
        "merge_many_tags": _o_many(),
        "export_clustered": wide,
        "export_file_ranges": f"select count(*) as n_uids, cast(0 as bigint) as n_overlaps from ({wide}) w",
        "bitmap_unpivot": _o_pairs() + "select uid, tag_code, tag_value from p",
        "bitmap_route_types": _o_route(),
        "bitmap_cardinality": _O_CARD,
        "bitmap_cardinality_plain": _O_CARD,
        "bitmap_cardinality_mixed": _O_CARD,
        "bitmap_cardinality_two_dates": _o_two_dates(),
        "bitmap_decode_uids": _o_pairs()
        + "select distinct tag_code, tag_value, cast(uid as bigint) as uid from p",
        "bitmap_unsigned_uids": (
            "select 'tag_unsigned' as tag_code, c_mktsegment as tag_value, cast(case when c_custkey % 2 = 0 "
            "then 18446744073709551615::hugeint - c_custkey else 9223372036854775707::hugeint + c_custkey end as varchar) as uid from customer"
        ),
        "bitmap_typed_long": _o_typed("1"),
        "bitmap_typed_decimal": _o_typed("2"),
        "bitmap_typed_string": _o_typed("3"),
        "bitmap_typed_date": _o_typed("4"),
        "bitmap_slice_delete": _o_slice(),
        "profile_end_to_end": _O_CARD,
    }
