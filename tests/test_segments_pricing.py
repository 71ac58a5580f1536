"""Segments, concentration, discounts and samples on small tables."""

import pytest
from pyspark.sql import functions as F

from profitlens.operators import pricing, ranking, sampling, segments


def customers(spark, rows):
    return spark.createDataFrame(rows, "customer_id long, total_sales double, total_profit double, order_count long")


def test_margin_is_zero_without_sales(spark):
    df = spark.createDataFrame([(100.0, 20.0), (200.0, 50.0), (0.0, 0.0)], "total_sales double, total_profit double")
    assert [r["margin"] for r in segments.product_margin(df).collect()] == [0.2, 0.25, 0.0]


def test_tiers(spark):
    df = customers(spark, [(1, 10000.0, 1.0, 15), (2, 2000.0, 1.0, 5), (3, 500.0, 1.0, 1), (4, 6000.0, 1.0, 9)])
    assert [r["tier"] for r in segments.customer_tier(df).orderBy("customer_id").collect()] == [
        "VIP", "Loyal", "Occasional", "Loyal",
    ]


def test_value_matrix(spark):
    df = customers(spark, [(1, 100.0, 5.0, 1), (2, 90.0, -5.0, 1), (3, 10.0, -1.0, 1), (4, 10.0, 1.0, 1)])
    got = segments.customer_segmentation(df, 0.5).orderBy("customer_id").collect()
    assert [r["segment_class"] for r in got] == [segments.VIP, segments.BLEEDER, segments.LOW_VALUE, segments.STANDARD]
    assert segments.bleeder_count(segments.customer_segmentation(df, 0.5)).first()[0] == 1


def test_pareto_is_a_share_of_all_customers(spark):
    df = customers(spark, [(1, 1.0, 60.0, 1), (2, 1.0, 20.0, 1), (3, 1.0, 20.0, 1), (4, 1.0, -9.0, 1)])
    curve = segments.pareto_curve(df).orderBy("customer_rank").collect()
    assert [r["cumulative_pct"] for r in curve] == [0.6, 0.8, 1.0]
    assert segments.pareto_pct(df).first()["pareto_pct"] == 50.0


def test_abc_share_falls_back_after_passing_one(spark):
    rows = [("p1", 70.0), ("p2", 40.0), ("p3", -10.0)]
    df = spark.createDataFrame(rows, "product_name string, total_profit double")
    got = {r["product_name"]: (r["cumulative_profit_pct"], r["abc_class"]) for r in segments.abc_classification(df).collect()}
    assert got == {"p1": (0.7, segments.ABC_A), "p2": (1.1, segments.ABC_C), "p3": (1.0, segments.ABC_C)}


def test_rfm_without_dates_uses_two_scores(spark):
    df = spark.createDataFrame([(i, i, float(i)) for i in range(1, 9)], "customer_id long, frequency long, monetary double")
    got = segments.rfm_segments(df).orderBy("customer_id").collect()
    assert [r["rfm_total"] for r in got] == [2, 2, 4, 4, 6, 6, 8, 8]
    assert [r["rfm_segment"] for r in got][::2] == ["Lost", "At Risk", "Potential Loyalist", "Loyal"]


def test_efficiency_of_identical_products(spark):
    df = spark.createDataFrame(
        [("a", 10.0, 1.0, 2.0, 0.5), ("b", 10.0, 1.0, 2.0, 0.5)],
        "product_name string, total_sales double, total_profit double, units_sold double, profit_per_unit double",
    )
    assert [r["product_efficiency_index"] for r in segments.product_efficiency(df).collect()] == [0.0, 0.0]


@pytest.fixture
def orders(spark):
    rows = [(0.0, 1.0, 100.0), (0.05, 2.0, 100.0), (0.06, 3.0, 100.0), (0.10, -4.0, 100.0), (0.30, 5.0, 100.0)]
    return spark.createDataFrame(rows, "discount_rate double, profit double, sales double")


def test_curve_leaves_out_undiscounted_rows(orders):
    got = {r["bracket_high"]: r["avg_profit"] for r in pricing.discount_curve(orders).collect()}
    assert got == {0.05: 2.0, 0.10: -0.5, 0.30: 5.0}


def test_simulator_counts_undiscounted_rows(orders):
    got = {r["discount_bucket"]: r["orders"] for r in pricing.discount_buckets(orders).collect()}
    assert got == {"0–5%": 2, "5–10%": 2, "25–30%": 1}


def test_caps(orders):
    row = pricing.discount_whatif(orders, 0.05).first()
    assert (row["breaching_orders"], row["breach_pct"], row["recovered"]) == (3, 60.0, 31.0)
    assert row["simulated_profit"] == 38.0
    assert pricing.revenue_at_risk(orders, 0.25).first()[0] == 5.0
    assert pricing.revenue_at_risk(orders, 0.9).first()[0] == 0.0
    table = {r["cap"]: r["breaching_orders"] for r in pricing.cap_sensitivity(orders).collect()}
    assert table[0.05] == 3 and table[0.30] == 0 and len(table) == 8


def test_histogram_puts_the_maximum_in_the_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "v double")
    assert {r["bin"]: r["orders"] for r in pricing.histogram(df, "v", 5).collect()} == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}
    same = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert [(r["bin"], r["orders"]) for r in pricing.histogram(same, "v", 5).collect()] == [(0, 2)]


def test_ties_in_top_lists_go_by_key(spark):
    df = customers(spark, [(3, 1.0, 5.0, 1), (1, 1.0, 5.0, 1), (2, 1.0, 9.0, 1)])
    assert [r["customer_id"] for r in ranking.top(df, "total_profit", "customer_id", 2).collect()] == [2, 1]


@pytest.mark.parametrize("wanted", [10, 500, 5000])
def test_sample_has_the_wanted_size_and_repeats(spark, wanted):
    # A third of the rows are copies of one row.
    rows = [(0 if i % 3 == 0 else i, float(i % 3 and i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "customer_id long, sales double")
    first = sampling.sample_rows(df.repartition(3), wanted).collect()
    again = sampling.sample_rows(df.repartition(7), wanted).collect()
    assert len(first) == min(wanted, 3000)
    assert sorted(first) == sorted(again)


def test_scaled_estimate(spark):
    sample = spark.createDataFrame([(10.0, 1.0), (30.0, 3.0)], "sales double, profit double")
    row = sampling.sample_scaled_kpis(sample, sample.filter("sales > 20"), F.lit(10)).first()
    assert (row["estimated_revenue"], row["estimated_profit"], row["estimated_orders"]) == (150.0, 15.0, 5)
