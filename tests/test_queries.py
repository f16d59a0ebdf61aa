"""Every registered query against its SQL, and the shape of its plan."""

import os

import pytest

import __spark_entry__ as entry
import compare
from thermolane import catalog

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry.queries()

needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(QUERIES)
    assert set(catalog.all_queries()) - set(catalog.all_sql()) == {"multi_target_regression", "what_if_scores"}


@needs_data
@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    ok, note = compare.compare(spark, duck, SF_DIR, name)
    assert ok, note


@needs_data
def test_entry(spark):
    assert entry.entry(spark).count() > 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@needs_data
@pytest.mark.parametrize(
    "name",
    ["zone_feature_table", "plan_long", "plan_long_whole_days", "clean_interpolate", "preprocess_ac",
     "monthly_statistics", "limits_to_master", "fan_frequency", "skeleton_hours", "feature_target_corr"],
)
def test_no_cross_join_and_no_python_rows(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "MapInPandas"):
        assert bad not in plan


@needs_data
def test_duplicates_are_limited_before_the_shuffle(spark):
    plan = plan_of(QUERIES["clean_dedup_prefer_on"](spark, SF_DIR))
    shuffle = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[shuffle:]


@needs_data
def test_similar_days_are_limited_while_ranked(spark):
    assert "WindowGroupLimit" in plan_of(QUERIES["similar_days_topn"](spark, SF_DIR))


@needs_data
def test_unit_hours_combine_before_the_shuffle(spark):
    plan = plan_of(QUERIES["indoor_hours"](spark, SF_DIR))
    assert "partial_" in plan[plan.index("Exchange hashpartitioning"):]


@needs_data
def test_scans_read_only_what_they_need(spark):
    plan = plan_of(QUERIES["weather_hourly_mean"](spark, SF_DIR))
    assert "event_type" not in plan and "event_id" not in plan
    plan = plan_of(QUERIES["sql_named_params"](spark, SF_DIR))
    assert "GreaterThanOrEqual(o_totalprice" in plan and "o_orderstatus" not in plan
