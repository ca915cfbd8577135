from pyspark.sql import functions as F

from tagweave.operators.export import cluster_by_uid
from tagweave.sources.jdbc import jdbc_options


def test_cluster_by_uid_gives_sorted_disjoint_ranges(spark):
    wide = spark.range(0, 5000).select(
        F.format_string("%06d", (F.col("id") * 7919) % 5000).alias("uid"), F.lit("x").alias("t")
    )
    parts = cluster_by_uid(wide, 4).rdd.glom().map(lambda rows: [r.uid for r in rows]).collect()
    parts = [p for p in parts if p]
    assert len(parts) > 1
    for p in parts:
        assert p == sorted(p)
    for a, b in zip(parts, parts[1:]):
        assert a[-1] < b[0]
    assert sum(map(len, parts)) == 5000


def test_jdbc_writer_options():
    opts = jdbc_options(url="jdbc:x://h/db", table="user_tag_merge_20240115", driver="d.Driver",
                        create_table_options="ENGINE = MergeTree() ORDER BY uid")
    assert opts["batchsize"] == "1000"
    assert opts["isolationLevel"] == "NONE"
    assert opts["numPartitions"] == "4"
    assert opts["dbtable"] == "user_tag_merge_20240115"
    assert opts["createTableOptions"].endswith("ORDER BY uid")


def test_cluster_ranges_stay_disjoint_for_uids_of_mixed_length(spark):
    wide = spark.range(0, 3000).select(F.col("id").cast("string").alias("uid"))
    parts = cluster_by_uid(wide, 4).rdd.glom().map(lambda rows: [r.uid for r in rows]).collect()
    parts = [p for p in parts if p]
    assert sum(map(len, parts)) == 3000 and all(p == sorted(p) for p in parts)
    assert all(a[-1] < b[0] for a, b in zip(parts, parts[1:]))


def test_jdbc_defaults_and_writer_count(spark, store, monkeypatch):
    """A MergeTree target is ordered by uid by default; the writer count reaches both ways of export."""
    from tagweave.plans import jobs

    assert jdbc_options(url="jdbc:clickhouse://h/db", table="t")["createTableOptions"] == "ENGINE = MergeTree() ORDER BY uid"
    assert "createTableOptions" not in jdbc_options(url="jdbc:x://h/db", table="t")
    store.write_wide(spark.range(100).selectExpr("cast(id as string) uid"), "2024-01-15")
    seen = {}
    monkeypatch.setattr(jobs, "write_jdbc", lambda df, mode, **opts: seen.update(jdbc_options(**opts)))
    jobs.run_export_job(spark, None, store, "2024-01-15", jdbc={"url": "jdbc:x://h/db"}, num_partitions=9)
    assert seen["numPartitions"] == "9" and seen["dbtable"] == "user_tag_merge_20240115"
    path = jobs.run_export_job(spark, None, store, "2024-01-15", num_partitions=3)
    assert len(store.read_dataset(path).inputFiles()) == 3


def test_jdbc_paths_reach_the_jdbc_layer(spark):
    """Without a database: both JDBC paths get as far as driver lookup."""
    import pytest

    from tagweave.sources.catalog import Catalog
    from tagweave.sources.jdbc import write_jdbc

    df = spark.createDataFrame([("1", "a")], "uid string, tag_a string")
    with pytest.raises(Exception, match="(?i)no suitable driver"):
        write_jdbc(df, url="jdbc:tagweave-none://nowhere/db", table="user_tag_merge_20240115")
    with pytest.raises(Exception, match="(?i)no suitable driver"):
        Catalog.from_jdbc(spark, "jdbc:tagweave-none://nowhere/meta")


def _merged(spark, store, n=4000):
    """A stored day of three tags over uids of mixed length, with repeats; returns (catalog, rows by uid)."""
    from tagweave.plans import jobs

    from .conftest import mini_catalog

    sql = "select cast(id * 7919 % {n} as string) uid, cast(id % {m} as bigint) query_value from range({r})"
    tags = [(i, f"TAG_{i}", "1", sql.format(n=n, m=m, r=r)) for i, m, r in ((1, 7, n), (2, 11, n // 2), (3, 5, 2 * n))]
    cat = mini_catalog(spark, tags)
    jobs.run_tag_jobs(spark, cat, store, "2024-01-15")
    return cat, {tuple(r) for r in jobs.merge_frame(cat, store, "2024-01-15").collect()}


def _file_ranges(frame):
    """(least uid, greatest uid, whether sorted) of every file, by least uid."""
    import pyarrow.parquet as pq

    uids = [pq.read_table(f.removeprefix("file://")).column("uid").to_pylist() for f in frame.inputFiles()]
    return sorted((u[0], u[-1], u == sorted(u)) for u in uids if u)


def test_merged_table_is_clustered_and_exported_without_a_shuffle(spark, store, monkeypatch):
    from tagweave.plans import jobs

    monkeypatch.setattr(jobs, "cluster_by_uid", None)  # not called
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cat, want = _merged(spark, store)
        plan = jobs.merge_frame(cat, store, "2024-01-15", clustered=True)._jdf.queryExecution().executedPlan().toString()
        jobs.run_merge_job(spark, cat, store, "2024-01-15")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    initial = plan.split("== Initial Plan ==")[0]
    assert initial.count("Exchange rangepartitioning") == 1 and initial.count("Exchange hashpartitioning") == 1
    wide = store.read_wide("2024-01-15")
    ranges = _file_ranges(wide)
    assert len(ranges) > 3 and all(r[2] for r in ranges) and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert {tuple(r) for r in wide.collect()} == want and wide.count() == len(want)
    apart = store.read_files_apart(store.wide_path("2024-01-15"))
    assert "Exchange" not in apart._jdf.queryExecution().executedPlan().toString()
    jobs.run_export_job(spark, cat, store, "2024-01-15")
    export = store.read_export("2024-01-15")
    assert _file_ranges(export) == ranges
    assert {tuple(r) for r in export.collect()} == want and export.count() == len(want)
    manifest = store.published(store.export_path("2024-01-15"))
    assert manifest.sorted_by == "uid" and manifest.source == store.published(store.wide_path("2024-01-15")).version
    assert jobs.bitmap_input(store, "2024-01-15").inputFiles() == export.inputFiles()


def test_table_stored_by_other_means_is_clustered_by_the_export(spark, store):
    from tagweave.plans import jobs

    rows = spark.range(0, 900, 1, 6).selectExpr("cast(id * 7 % 900 as string) uid", "'x' tag_a")
    store.write_wide(rows, "2024-01-15")
    assert store.published(store.wide_path("2024-01-15")).sorted_by == ""
    jobs.run_export_job(spark, None, store, "2024-01-15")
    ranges = _file_ranges(store.read_export("2024-01-15"))
    assert ranges and all(r[2] for r in ranges) and store.read_export("2024-01-15").count() == 900
    jobs.run_export_job(spark, None, store, "2024-01-15", num_partitions=3)
    assert len(_file_ranges(store.read_export("2024-01-15"))) == 3


def test_manifest_without_an_order_is_read(spark, store):
    """A manifest written before files had a stated order."""
    import json
    from dataclasses import asdict

    from tagweave.sources import manifest

    store.write_wide(spark.range(3).selectExpr("cast(id as string) uid"), "2024-01-15", sorted_by="uid")
    path = store.wide_path("2024-01-15")
    old = asdict(store.published(path))
    del old["sorted_by"]
    manifest._replace_file(spark, f"{path}/{manifest.MANIFEST}", json.dumps(old))
    assert store.published(path).sorted_by == "" and store.read_wide("2024-01-15").count() == 3
