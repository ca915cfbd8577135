"""Published datasets: failure at every step, direct-write stores, changed types, what runs leave behind."""

import datetime
import decimal

import pytest

from tagweave.plans import jobs
from tagweave.sources import manifest
from tagweave.sources.store import MissingTableError, ProfileStore

from .conftest import mini_catalog

DATE = "2024-01-15"


def rows(spark, values, vtype="string"):
    return spark.createDataFrame([("1", v) for v in values], f"uid string, query_value {vtype}")


def stored(store, code="3", date=DATE, tag="TAG_M"):
    return sorted(r.query_value for r in store.read_tag(tag, code, date).collect())


def folders(store, date=DATE):
    fs, path = manifest.filesystem(store.spark, f"{store.tag_path('TAG_M')}/dt={date}")
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.getPath().getName().startswith("v-"))


@pytest.fixture(params=["renaming store", "direct-write store"])
def any_store(request, store, monkeypatch):
    """The second writes its manifests in place, as object stores do."""
    if request.param == "direct-write store":
        monkeypatch.setattr(manifest, "OBJECT_STORES", ("file",))
    return store


def test_rows_and_columns_are_in_the_manifest(spark, any_store):
    any_store.write_tag(rows(spark, ["a", "b", None]), "TAG_M", DATE)
    m = any_store.published(f"{any_store.tag_path('TAG_M')}/dt={DATE}")
    assert m.rows == 3 and m.columns.fieldNames() == ["uid", "query_value"] and m.previous == ""
    any_store.write_tag(rows(spark, []), "TAG_M", DATE)
    again = any_store.published(f"{any_store.tag_path('TAG_M')}/dt={DATE}")
    assert again.rows == 0 and again.previous == m.folder and stored(any_store) == []


class Lost(Exception):
    pass


def lost(*_, **__):
    raise Lost("lost the driver")


def failing_rows(spark):
    return rows(spark, ["x"]).selectExpr("uid", "cast(raise_error('boom') as string) query_value")


@pytest.mark.parametrize("step", ["data", "before publishing", "manifest"])
@pytest.mark.parametrize("died", [False, True])
def test_failure_at_a_step_keeps_the_published_version(spark, any_store, monkeypatch, step, died):
    """``died``: nothing is cleaned up either, as when the driver's machine is lost."""
    any_store.write_tag(rows(spark, ["old"]), "TAG_M", DATE)
    with monkeypatch.context() as m:
        if step == "before publishing":
            m.setattr(any_store, "_before_publishing", lost)
        if step == "manifest":
            m.setattr(manifest, "_replace_file", lost)
        if died:
            m.setattr(manifest, "_drop", lambda *_: None)
        with pytest.raises(Exception, match="boom|lost"):
            any_store.write_tag(failing_rows(spark) if step == "data" else rows(spark, ["new"]), "TAG_M", DATE)
    assert stored(any_store) == ["old"] and any_store.slice_dates(any_store.tag_path("TAG_M")) == [DATE]
    if died and step != "data":
        assert len(folders(any_store)) == 2
        assert any_store.vacuum(min_age_hours=24) == []
        assert len(any_store.vacuum(min_age_hours=0)) == 1
    any_store.write_tag(rows(spark, ["next"]), "TAG_M", DATE)
    assert stored(any_store) == ["next"]


def test_a_first_run_that_fails_is_no_slice(spark, any_store, monkeypatch):
    any_store.write_tag(rows(spark, ["a"]), "TAG_M", "2024-01-14")
    with monkeypatch.context() as m:
        m.setattr(any_store, "_before_publishing", lost)
        m.setattr(manifest, "_drop", lambda *_: None)
        with pytest.raises(Lost):
            any_store.write_tag(rows(spark, ["b"]), "TAG_M", DATE)
    assert any_store.slice_dates(any_store.tag_path("TAG_M")) == ["2024-01-14"]
    with pytest.raises(MissingTableError, match=DATE):
        any_store.read_tag("TAG_M", "3", DATE)
    assert any_store.read_tag("TAG_M", "3").count() == 1
    assert any_store.read_tag("TAG_M", "3", DATE, require_slice=False).count() == 0


def test_failure_in_cleaning_up_is_no_failure_of_the_run(spark, store, monkeypatch):
    for v in ("1", "2"):
        store.write_tag(rows(spark, [v]), "TAG_M", DATE)
    with monkeypatch.context() as m:
        m.setattr(manifest, "_drop", lost)
        store.write_tag(rows(spark, ["3"]), "TAG_M", DATE)
    assert stored(store) == ["3"] and len(folders(store)) == 3
    assert len(store.vacuum(min_age_hours=0)) == 1 and len(folders(store)) == 2


def test_a_reader_under_way_outlives_one_rewrite(spark, store):
    store.write_tag(rows(spark, ["old"]), "TAG_M", DATE)
    reading = store.read_tag("TAG_M", "3", DATE)
    store.write_tag(rows(spark, ["new"]), "TAG_M", DATE)
    assert [r.query_value for r in reading.collect()] == ["old"] and stored(store) == ["new"]


def test_unbuilt_dates_raise_in_every_reader(spark, store):
    cat = mini_catalog(spark, [(1, "TAG_A", "3", "select '1' uid, 'v' query_value")])
    jobs.run_day(spark, cat, store, DATE)
    other = "2020-01-01"
    for read in (
        lambda: store.read_tag("TAG_A", "3", other), lambda: store.read_wide(other), lambda: store.read_export(other),
        lambda: jobs.read_bitmaps(store, "3", other), lambda: jobs.read_bitmaps(store, "1", other),
        lambda: store.read_tags(["TAG_A"], other), lambda: jobs.run_merge_job(spark, cat, store, other),
        lambda: jobs.run_export_job(spark, cat, store, other), lambda: jobs.run_bitmap_job(spark, cat, store, other),
    ):
        with pytest.raises(MissingTableError):
            read()
    assert jobs.read_bitmaps(store, "3", other, require_slice=False).count() == 0


def test_a_changed_type_does_not_break_older_dates(spark, store):
    day = datetime.date(2024, 1, 15)
    store.write_tag(rows(spark, [10, 9], "bigint"), "TAG_M", "2024-01-13")
    store.write_tag(rows(spark, [decimal.Decimal("1.50")], "decimal(16,2)"), "TAG_M", "2024-01-14")
    store.write_tag(rows(spark, ["x", str(day)]), "TAG_M", DATE)
    assert {(r.query_value, r.dt) for r in store.read_tag("TAG_M", "3").collect()} == {
        ("10", "2024-01-13"), ("9", "2024-01-13"), ("1.50", "2024-01-14"), ("x", DATE), (str(day), DATE),
    }
    assert stored(store, "1", "2024-01-13") == [9, 10] and stored(store, "2", "2024-01-13") == [9, 10]
    with pytest.raises(Exception, match="is not bigint"):
        store.read_tag("TAG_M", "1", DATE).collect()
    # A merge of an old date takes the text of the type stored then.
    assert [r.query_value for r in store.read_tags(["TAG_M"], "2024-01-14").collect()] == ["1.50"]


def test_registered_tables_follow_the_type(spark, store):
    store.database = f"typed_{abs(hash(store.root)) % 10**8}"
    name = store.database
    store.write_tag(rows(spark, [1], "bigint"), "TAG_M", "2024-01-14")
    store.register_tag("TAG_M", "1")
    assert spark.table(f"{name}.tag_m").schema["query_value"].dataType.simpleString() == "bigint"
    store.write_tag(rows(spark, ["a"]), "TAG_M", DATE)
    store.register_tag("TAG_M", "3")
    table = spark.table(f"{name}.tag_m")
    assert table.schema["query_value"].dataType.simpleString() == "string"
    assert [tuple(r) for r in table.collect()] == [("1", "a", DATE)]
    store.write_tag(rows(spark, ["b"]), "TAG_M", DATE)  # rewritten: register again, see the new version
    store.register_tag("TAG_M", "3")
    spark.catalog.refreshTable(f"{name}.tag_m")
    assert [r.query_value for r in spark.table(f"{name}.tag_m").collect()] == ["b"]


def test_another_session_sees_what_is_published(spark, store):
    store.write_tag(rows(spark, ["a"]), "TAG_M", DATE)
    other = ProfileStore(spark.newSession(), root=store.root.rsplit("/", 1)[0])
    assert stored(other) == ["a"]
