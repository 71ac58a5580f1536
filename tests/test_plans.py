"""What the plans must not contain, and what the scans must push down."""

import re

import pytest

from profitlens.plans.queries import all_queries

QUERIES = all_queries()

# Fitting a model takes long and its scoring plan is the library's own.
FITTED = {
    "margin_risk_scores", "margin_importance", "margin_attributions", "margin_attribution_sums", "delivery_risk_scores", "ltv_scores",
    "churn_scores", "feature_importance", "permutation_importance", "calibrated_scores",
    "model_report", "cross_validated_auc", "calibrated_model_scores",
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FITTED))
def test_no_python_rows_and_no_cross_joins(spark, data, name):
    plan = plan_of(QUERIES[name](spark, data))
    for forbidden in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert forbidden not in plan


@pytest.mark.parametrize("name", ["rfm_segments", "abc_classification", "pareto_curve"])
def test_ordered_work_is_partitioned(spark, data, name):
    """Windows over values are partitioned by slice; only slice sums are windowed as a whole."""
    for window in re.findall(r"Window \[.*?windowspecdefinition\((.*?)\)", plan_of(QUERIES[name](spark, data))):
        assert "slice" in window or "metric" in window


def test_scans_read_only_needed_columns(spark, data):
    plan = plan_of(QUERIES["discount_sensitivity"](spark, data))
    lineitem = next(s for s in re.findall(r"ReadSchema: struct<[^>]*>", plan) if "l_discount" in s)
    assert "l_tax" not in lineitem and "l_shipdate" not in lineitem


def test_filters_reach_the_scan(spark, data):
    plan = plan_of(QUERIES["policy_breach_rows"](spark, data))
    assert "GreaterThan(l_discount,0.09)" in plan
    plan = plan_of(QUERIES["cross_filter"](spark, data))
    assert re.search(r"In\(c_mktsegment, \[BUILDING,MACHINERY\]\)", plan)
    assert re.search(r"In\(r_name, \[ASIA,EUROPE\]\)", plan)


def test_top_lists_are_not_full_sorts(spark, data):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["top_customers_profit"](spark, data))
    assert "WindowGroupLimit" in plan_of(QUERIES["abc_top_products"](spark, data))
