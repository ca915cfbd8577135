import pytest

from tagweave.codes import CatalogError
from tagweave.plans.seed import seed_catalog
from tagweave.sources.catalog import TAG_BY_TASK_COLUMNS, Catalog

from .conftest import mini_catalog


def test_enabled_tags_inner_join_on_enabled_tasks(spark):
    cat = seed_catalog(spark)
    codes = [r.tag_code for r in cat.enabled_tag_rows()]
    assert codes[0] == "TAG_CUST_SEGMENT" and len(codes) == 9
    assert "TAG_EVENT_TOP" not in codes  # task status 0
    assert not any(c.startswith("LEAF_") for c in codes)  # leaf tags have no task
    ids = [r.id for r in cat.enabled_tag_rows()]
    assert ids == sorted(ids)


def test_tag_for_task_projects_ten_columns(spark):
    row = seed_catalog(spark).tag_for_task(3)
    assert list(row.asDict()) == TAG_BY_TASK_COLUMNS
    assert row.tag_code == "TAG_ORDER_SPEND" and row.tag_value_type == "2"


def test_two_tags_for_one_task_takes_first_by_id(spark):
    cat = mini_catalog(
        spark, [(7, "B", "3", "select 1"), (5, "A", "3", "select 1")]
    )
    # both tags point at their own task; add a second tag on task 7
    tags = cat.tag_info.unionByName(
        spark.createDataFrame([(2, "FIRST", 7)], "id bigint, tag_code string, tag_task_id bigint"),
        allowMissingColumns=True,
    )
    cat2 = Catalog(tags, cat.task_info, cat.task_tag_rule)
    assert cat2.tag_for_task(7).tag_code == "FIRST"


def test_missing_task_is_a_clear_error(spark):
    cat = seed_catalog(spark)
    with pytest.raises(CatalogError, match="999"):
        cat.task_by_id(999)
    with pytest.raises(CatalogError, match="999"):
        cat.tag_for_task(999)


def test_rules_join_drops_unknown_leaf_and_orders_by_id(spark):
    cat = seed_catalog(spark)
    rows = cat.rules_for_task(5).collect()
    assert [r.id for r in rows] == [1, 2, 3, 4]  # rule 5 names leaf 999
    assert [r.sub_tag_value for r in rows] == ["AFRICA", "AMERICA", "ASIA", "EUROPE"]


def test_rule_match_mode_defaults(spark):
    cat = seed_catalog(spark)
    assert {r.match_mode for r in cat.rule_rows(5, "TAG_CUST_REGION")} == {"exact"}
    assert {r.match_mode for r in cat.rule_rows(6, "TAG_PERSON_BASE_CONS")} == {"predicate"}
    assert {r.match_mode for r in cat.rule_rows(7, "TAG_SPEND_BAND")} == {"predicate"}


def test_parquet_round_trip(spark, tmp_path):
    cat = seed_catalog(spark)
    cat.write_parquet(str(tmp_path))
    back = Catalog.from_parquet(spark, str(tmp_path))
    assert [r.tag_code for r in back.enabled_tag_rows()] == [
        r.tag_code for r in cat.enabled_tag_rows()
    ]
    assert back.task_by_id(9).task_sql == cat.task_by_id(9).task_sql


def test_from_rows_rejects_unknown_fields(spark):
    with pytest.raises(CatalogError):
        Catalog.from_rows(spark, [{"id": 1, "bogus": 2}], [])


def test_warehouse_views_skip_absent_tables(spark):
    from tagweave.sources.warehouse import register_parquet_views

    from .conftest import SF_SMALL

    names = register_parquet_views(spark, SF_SMALL, ["customer", "no_such_table"])
    assert names == ["customer"]
    assert spark.table("customer").count() > 0


def test_validate_reports_every_problem(spark):
    cat = mini_catalog(
        spark,
        [(1, "TAG_OK", "3", "select 1 uid, 2 query_value"), (2, "TAG_BADTYPE", "9", "select 1"),
         (3, "TAG_NOSQL", "3", " "), (4, "TAG_LONGLABEL", "1", "select 1 uid, 2 query_value"),
         (5, "tag_ok", "3", "select 1")],
        rules=[(1, 4, "2", 11, None)],
        labels=[(11, "two")],
    )
    with pytest.raises(CatalogError) as err:
        cat.validate()
    msg = str(err.value)
    for part in ("TAG_BADTYPE", "TAG_NOSQL", "TAG_LONGLABEL", "collides"):
        assert part in msg
    assert "TAG_OK:" not in msg
    seed_catalog(spark).validate()


def test_local_catalog_frames_keep_nulls_and_allow_empty(spark):
    from tagweave.sources.catalog import TASK_TAG_RULE_SCHEMA, local_frame

    empty = local_frame(spark, [], TASK_TAG_RULE_SCHEMA)
    assert empty.count() == 0 and empty.schema == TASK_TAG_RULE_SCHEMA
    one = local_frame(spark, [(1, None, 5, "x", None, None)], TASK_TAG_RULE_SCHEMA).first()
    assert (one.id, one.tag_id, one.task_id, one.sub_tag_id) == (1, None, 5, None)


def test_two_tags_on_one_task_are_reported(spark):
    from tagweave.sources.catalog import Catalog

    tags = [{"id": i, "tag_code": c, "tag_name": c, "tag_value_type": "3", "tag_task_id": 1} for i, c in ((1, "TAG_A"), (2, "TAG_B"))]
    cat = Catalog.from_rows(spark, tags, [{"id": 1, "task_status": "1", "task_sql": "select '1', 'a'"}], [])
    with pytest.raises(CatalogError, match="one task computes one tag"):
        cat.validate()
