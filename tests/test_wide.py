import random

import pytest
from pyspark.sql import functions as F

from tagweave.operators.wide import build_wide, pivot_tags, tag_branch, union_tags
from tagweave.sources.store import MissingTableError


def _tag(spark, rows, vtype="string"):
    return spark.createDataFrame(rows, f"uid string, query_value {vtype}")


def test_duplicate_uid_resolves_by_text_max(spark):
    b = tag_branch(_tag(spark, [("1", 10), ("1", 9)], "bigint"), "TAG_A")
    assert pivot_tags(b, ["TAG_A"]).first().tag_a == "9"


def test_uid_with_only_null_value_keeps_a_row(spark):
    b = tag_branch(_tag(spark, [("2", None)]), "TAG_A")
    c = tag_branch(_tag(spark, [("3", "x")]), "TAG_B")
    rows = {r.uid: (r.tag_a, r.tag_b) for r in pivot_tags(union_tags([b, c]), ["TAG_A", "TAG_B"]).collect()}
    assert rows == {"2": (None, None), "3": (None, "x")}


def test_mixed_types_become_own_text_in_any_order(spark):
    parts = {
        "TAG_L": tag_branch(_tag(spark, [("1", 5)], "bigint"), "TAG_L"),
        "TAG_D": tag_branch(
            spark.createDataFrame([("1", "1.50")], "uid string, query_value string").select(
                "uid", F.col("query_value").cast("decimal(16,2)").alias("query_value")
            ),
            "TAG_D",
        ),
        "TAG_S": tag_branch(_tag(spark, [("1", "abc")]), "TAG_S"),
    }
    for order in (["TAG_L", "TAG_D", "TAG_S"], ["TAG_S", "TAG_D", "TAG_L"]):
        row = pivot_tags(union_tags([parts[c] for c in order]), order).first()
        assert (row.tag_l, row.tag_d, row.tag_s) == ("5", "1.50", "abc")


def test_pivot_uses_original_code_case(spark):
    b = tag_branch(_tag(spark, [("1", "v")]), "tag_b")
    assert pivot_tags(b, ["TAG_B"]).first().tag_b is None
    assert pivot_tags(b, ["tag_b"]).first().tag_b == "v"


def test_no_enabled_tag_gives_empty_uid_frame(spark, store):
    out = build_wide(store, [], "2024-01-15")
    assert out.columns == ["uid"] and out.count() == 0


def test_missing_tag_table(spark, store):
    store.write_tag(_tag(spark, [("1", "v")]), "TAG_OK", "2024-01-15")
    tags = [{"tag_code": "TAG_OK", "tag_value_type": "3"}, {"tag_code": "TAG_GONE", "tag_value_type": "3"}]
    with pytest.raises(MissingTableError, match="TAG_GONE"):
        build_wide(store, tags, "2024-01-15")
    out = build_wide(store, tags, "2024-01-15", missing_ok=True)
    assert out.columns == ["uid", "tag_ok", "tag_gone"]
    assert tuple(out.first()) == ("1", "v", None)


def test_wide_is_two_narrow_shuffles(spark, store):
    for code in ("TAG_A", "TAG_B", "TAG_C"):
        store.write_tag(_tag(spark, [("1", "v"), ("2", "w")]), code, "2024-01-15")
    tags = [{"tag_code": c, "tag_value_type": "3"} for c in ("TAG_A", "TAG_B", "TAG_C")]
    wide = build_wide(store, tags, "2024-01-15")
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # max per (uid, tag), then one row per cell by uid
    files = wide.inputFiles()  # only the date's slices, in one scan as all are text
    assert plan.split("== Initial Plan ==")[0].count("FileScan parquet") == 1
    assert len({f.split("/dt=")[0] for f in files}) == 3 and all("/dt=2024-01-15/" in f for f in files)
    assert "ReadSchema: struct<uid:string,query_value:string>" in plan


def test_unpivot_of_pivot_gives_back_the_cells(spark):
    rnd = random.Random(7)
    codes = ["TAG_A", "TAG_B", "TAG_C"]
    cells = {(str(u), c): f"v{rnd.randint(0, 5)}" for u in range(60) for c in codes if rnd.random() < 0.6}
    branches = [
        tag_branch(_tag(spark, [(u, v) for (u, cc), v in cells.items() if cc == c] or [("x", None)]), c)
        for c in codes
    ]
    wide = pivot_tags(union_tags(branches), codes)
    from tagweave.operators.bitmap import unpivot_tags

    back = {(r.uid, r.tag_code.upper()): r.tag_value for r in unpivot_tags(wide, [c.lower() for c in codes]).collect()}
    assert back == cells


def test_day_with_no_enabled_tag(spark, store):
    from tagweave.plans import jobs

    from .conftest import mini_catalog

    cat = mini_catalog(spark, [(1, "TAG_OFF", "3", "select 1 uid, 2 query_value")], statuses={1: "0"})
    jobs.run_day(spark, cat, store, "2024-01-15")
    wide = store.read_wide("2024-01-15")
    assert wide.columns == ["uid"] and wide.count() == 0
    assert store.read_export("2024-01-15").count() == 0
    for code in "1234":
        assert jobs.read_bitmaps(store, code, "2024-01-15").count() == 0


def test_slice_never_computed_is_an_error_but_an_empty_one_is_not(spark, store):
    import pytest

    from tagweave.operators.wide import build_wide
    from tagweave.sources.store import MissingTableError

    rows = spark.createDataFrame([("1", "a")], "uid string, query_value string")
    tags = [{"tag_code": "TAG_A", "tag_value_type": "3"}, {"tag_code": "TAG_B", "tag_value_type": "3"}]
    store.write_tag(rows, "TAG_A", "2024-01-15")
    store.write_tag(rows, "TAG_B", "2024-01-14")
    with pytest.raises(MissingTableError, match="2024-01-15"):
        build_wide(store, tags, "2024-01-15")
    assert build_wide(store, tags, "2024-01-15", missing_ok=True).first().tag_b is None
    store.write_tag(rows.where("false"), "TAG_B", "2024-01-15")
    assert [tuple(r) for r in build_wide(store, tags, "2024-01-15").collect()] == [("1", "a", None)]


def test_no_shuffled_row_has_a_column_per_tag(spark):
    import re

    from tagweave.operators.wide import pivot_tags

    codes = [f"T{i}" for i in range(40)]
    union = spark.createDataFrame([("1", "v", "T3"), ("1", "w", "T3"), ("2", "x", "T39")], "uid string, query_value string, tag_code string")
    wide = pivot_tags(union, codes)
    got = {r.uid: (r.t3, r.t39) for r in wide.collect()}
    assert got == {"1": ("w", None), "2": (None, "x")}
    plan = wide._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    lines = plan.splitlines()
    shuffled = [lines[i + 1] for i, line in enumerate(lines) if re.search(r"\bExchange hashpartitioning", line)]
    assert len(shuffled) == 2 and all("t39" not in x.lower() and "T3 " not in x for x in shuffled)


def _many(spark, store, n, seed=3):
    """n tags of three types with missing cells and repeats; returns (tags, cells by uid and column)."""
    rnd = random.Random(seed)
    tags, want = [], {}
    kinds = {"1": "bigint", "2": "decimal(16,2)", "3": "string"}
    for i in range(n):
        code, kind = f"TAG_{i}", "123"[i % 3]
        values = [(str(u), rnd.randint(0, 30)) for u in range(40) for _ in range(rnd.choice([0, 1, 1, 2]))]
        rows = spark.createDataFrame([(u, str(v)) for u, v in values] or [("0", "0")], "uid string, v string")
        store.write_tag(rows.selectExpr("uid", f"cast(v as {kinds[kind]}) query_value"), code, "2024-01-15")
        tags.append({"tag_code": code, "tag_value_type": kind})
        for u, v in values or [("0", 0)]:
            text = f"{v}.00" if kind == "2" else str(v)
            row = want.setdefault(u, {})
            row[code.lower()] = max(row.get(code.lower(), ""), text)
    return tags, want


@pytest.mark.parametrize("n", [9, 23])
def test_many_tags_are_one_scan_a_type(spark, store, n):
    tags, want = _many(spark, store, n)
    wide = build_wide(store, tags, "2024-01-15")
    plan = wide._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 3 and plan.count("Exchange hashpartitioning") == 2
    got = {r.uid: {c: v for c, v in r.asDict().items() if c != "uid" and v is not None} for r in wide.collect()}
    assert got == want and wide.columns == ["uid", *[t["tag_code"].lower() for t in tags]]


def test_pivot_of_six_hundred_tags(spark):
    n = 600
    cells = spark.range(3000).selectExpr("cast(id % 50 as string) uid", "cast(id as string) query_value", "cast(id * 7 % 600 as int) tag")
    from tagweave.operators.wide import pivot_cells

    got = {(r.uid, c): v for r in pivot_cells(cells, [f"t{i}" for i in range(n)]).collect() for c, v in r.asDict().items() if c != "uid" and v}
    want = {}
    for i in range(3000):
        key = (str(i % 50), f"t{i * 7 % n}")
        want[key] = max(want.get(key, ""), str(i))
    assert got == want


def test_bounded_session_copies_settings_and_never_raises_a_size(spark):
    from tagweave.session import bounded_session

    size, cost = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    before = spark.conf.get(size), spark.conf.get(cost)
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        spark.conf.set(size, "3k")
        own = bounded_session(spark, {size: 8 << 20, cost: 1 << 20})
        assert own.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
        assert own.conf.get(size) in ("3072", "3072b") and own.conf.get(cost) in (str(1 << 20), f"{1 << 20}b")
        assert spark.conf.get(size) == "3k" and spark.conf.get(cost) == before[1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.conf.set(size, before[0])


def test_tags_are_read_in_small_splits(spark, store, monkeypatch):
    from tagweave.sources import store as module

    tags = []
    for i in range(12):
        store.write_tag(_tag(spark, [(str(u), f"v{u}") for u in range(50)]).repartition(4), f"TAG_{i}", "2024-01-15")
        tags.append({"tag_code": f"TAG_{i}", "tag_value_type": "3"})
    for name in module.TAG_SPLITS:
        monkeypatch.setitem(module.TAG_SPLITS, name, 1 << 12)
    rows = store.read_tags([t["tag_code"] for t in tags], "2024-01-15")
    assert rows._jdf.rdd().getNumPartitions() >= 48 and rows.sparkSession is spark  # a file or less each
    rows.createOrReplaceTempView("tags_of_a_day")
    assert spark.sql("select count(*) n from tags_of_a_day").first().n == 600
    wide = build_wide(store, tags, "2024-01-15")
    assert {tuple(r) for r in wide.collect()} == {(str(u), *[f"v{u}"] * 12) for u in range(50)}


def test_partitions_of_the_merge_grow_with_the_rows(spark, store, monkeypatch):
    from tagweave.plans import jobs

    from .conftest import mini_catalog

    catalog = mini_catalog(spark, [(1, "TAG_A", "3", "select cast(id as string) uid, 'v' query_value from range(200)"),
                                   (2, "TAG_B", "1", "select cast(id as string) uid, id query_value from range(0, 200, 2)")])
    jobs.run_tag_jobs(spark, catalog, store, "2024-01-15")
    assert store.count_tag_rows(["TAG_A", "TAG_B"], "2024-01-15") == 300
    monkeypatch.setattr(jobs, "MERGE_CELLS", 10)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")  # a file a partition
    try:
        jobs.run_merge_job(spark, catalog, store, "2024-01-15")
    finally:
        spark.conf.set(coalesce, "true")
    wide = store.read_wide("2024-01-15")
    assert {tuple(r) for r in wide.collect()} == {(str(u), "v", None if u % 2 else str(u)) for u in range(200)}
    assert len(wide.inputFiles()) > 20 and spark.conf.get("spark.sql.shuffle.partitions") == "8"
    ends = wide.groupBy(F.col("_metadata.file_path")).agg(F.min("uid").alias("a"), F.max("uid").alias("b")).orderBy("a").collect()
    assert all(x.b < y.a for x, y in zip(ends, ends[1:]))
