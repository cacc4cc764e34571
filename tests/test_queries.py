"""Every registered spatial query with SQL equals it on the smallest tables."""

import pytest

from spanforge.plans.queries import QUERIES, SQL
from tests.compare import differences
from tests.conftest import SF


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert not differences(name, spark, SF, QUERIES, SQL)


def test_entry_and_registration(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).limit(1).count() == 1


def test_no_nested_loop_in_spatial_join(spark):
    plan = QUERIES["spatial_join"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "PushedFilters" in plan
