import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tagweave.session import get_session

    session = get_session("local[*]", app_name="tagweave-tests", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture()
def store(spark):
    from tagweave.session import scratch_dir
    from tagweave.sources.store import ProfileStore

    return ProfileStore(spark, root=scratch_dir(spark, "test"))


@pytest.fixture(scope="session")
def warehouse(spark):
    from tagweave.sources.warehouse import register_parquet_views

    register_parquet_views(spark, SF_SMALL)
    return SF_SMALL


def mini_catalog(spark, tags, rules=(), labels=(), statuses=None):
    """Catalog from (id, code, type, sql) tuples; task id = tag id."""
    from tagweave.sources.catalog import Catalog

    statuses = statuses or {}
    tag_rows = [
        {"id": i, "tag_code": c, "tag_name": c.lower(), "tag_value_type": t, "tag_task_id": i}
        for i, c, t, _ in tags
    ]
    tag_rows += [{"id": i, "tag_code": f"LEAF_{i}", "tag_name": n} for i, n in labels]
    task_rows = [
        {"id": i, "task_status": statuses.get(i, "1"), "task_sql": s} for i, _c, _t, s in tags
    ]
    rule_rows = [
        {"id": rid, "task_id": task, "query_value": q, "sub_tag_id": leaf, "match_mode": mode}
        for rid, task, q, leaf, mode in rules
    ]
    return Catalog.from_rows(spark, tag_rows, task_rows, rule_rows)
