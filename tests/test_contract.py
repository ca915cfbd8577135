"""Every registered query equals its DuckDB oracle on the smallest tables."""

import pytest

from .conftest import SF_SMALL
from .oracle_compare import compare, duck


@pytest.fixture(scope="module")
def report(spark):
    return compare(spark, SF_SMALL, con=duck(SF_SMALL))


def test_every_query_has_an_oracle():
    from tagweave.plans.contract import oracle_sql, queries

    assert set(queries()) == set(oracle_sql())


def test_queries_match_oracle(report):
    bad = {k: v for k, v in report.items() if not (v.get("columns_match") and v.get("values_match"))}
    assert not bad


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["tag_code", "tag_value", "cardinality"]
    assert df.count() > 0
