"""Totals, ratios, correlation and dates on small tables."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from profitlens.functions import arithmetic as a
from profitlens.functions.dates import month_of, parsed_moment, whole_days
from profitlens.operators import aggregates, kpis


def one(df):
    return df.first()[0]


def test_total_is_exact_for_any_order(spark):
    values = [(0.1,)] * 1000 + [(1e12,), (-1e12,), (-2.5,), (3e19,), (-3e19,), (-1e-9,), (None,)]
    df = spark.createDataFrame(values, "v double")
    found = {one(df.repartition(n).orderBy(order).agg(a.total("v"))) for n in (1, 7) for order in ("v", F.rand(n))}
    assert len(found) == 1
    assert found.pop() == pytest.approx(97.5 - 1e-9, abs=1e-11)


def test_total_keeps_every_digit(spark):
    small = spark.range(100_000).select(F.lit(0.00004).alias("v"))
    assert one(small.agg(a.total("v"))) == pytest.approx(4.0, abs=1e-9)
    assert one(small.agg(a.mean("v"))) == pytest.approx(0.00004, abs=1e-14)
    large = spark.range(1000).select((F.lit(1e9) + F.lit(0.0625)).alias("v"))
    assert one(large.agg(a.total("v"))) == 1000 * (1e9 + 0.0625)


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), float("-inf"), 1e300])
def test_what_is_not_finite_does_not_count(spark, bad):
    df = spark.createDataFrame([(1.5,), (bad,), (2.5,)], "v double")
    assert one(df.agg(a.total("v"))) == 4.0
    assert one(df.agg(a.mean("v"))) == 2.0


def test_places_add_up_to_the_market(spark):
    rows = [(f"m{i % 2}", f"r{i % 7}", 1e9 + 0.1 * (i % 13), 0.00004) for i in range(20_000)]
    tx = spark.createDataFrame(rows, "market string, order_region string, sales double, profit double")
    places = aggregates.places_agg(tx).filter("dimension = 'market'").orderBy("value").collect()
    markets = aggregates.market_agg(tx).orderBy("market").collect()
    assert [r["total_sales"] for r in places] == pytest.approx([r["total_sales"] for r in markets], rel=1e-15)


def test_total_of_nothing_is_zero_and_mean_is_null(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert one(df.agg(a.total("v"))) == 0.0
    assert one(df.agg(a.mean("v"))) is None


def test_correlation(spark):
    pairs = spark.createDataFrame([(1.0, 2.0), (2.0, 4.5), (3.0, None), (4.0, 7.0)], "x double, y double")
    assert one(pairs.agg(a.pearson("x", "y"))) == pytest.approx(0.98198, abs=1e-5)
    single = pairs.limit(1)
    assert one(single.agg(a.pearson("x", "y"))) is None
    constant = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert one(constant.agg(a.pearson("x", "y"))) is None


def test_scaling_of_a_constant_column(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    assert [r[0] for r in df.select(a.min_max(F.col("v"), F.lit(5.0), F.lit(5.0))).collect()] == [0.0, 0.0]
    assert [r[0] for r in df.select(a.min_max_soft(F.col("v"), F.lit(5.0), F.lit(5.0))).collect()] == [0.0, 0.0]


def test_not_a_number(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (None,), (2.0,)], "v double")
    assert [r[0] for r in df.select(a.zero_if_not_finite(F.col("v"))).collect()] == [0.0, 0.0, 0.0, 2.0]
    assert [r[0] for r in df.select(a.null_if_nan(F.col("v"))).collect()] == [None, float("inf"), None, 2.0]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_days_round_down_in_any_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql(
            "SELECT timestamp_ntz'2020-01-02 06:00:00' AS o, timestamp_ntz'2020-01-02 00:00:00' AS s "
            "UNION ALL SELECT timestamp_ntz'2020-03-07 12:00:00', timestamp_ntz'2020-03-09 12:00:00' "
            "UNION ALL SELECT timestamp_ntz'2020-01-01 00:00:00', NULL"
        )
        assert [r[0] for r in df.select(whole_days(F.col("o"), F.col("s"))).collect()] == [-1, 2, None]
        assert df.select(month_of(F.col("o"))).first()[0] == "2020-01"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_unreadable_dates_are_null(spark):
    df = spark.createDataFrame([("1/31/2018 22:56",), ("2018-01-31 22:56:00",), ("soon",), (None,)], "t string")
    formats = ("yyyy-MM-dd HH:mm:ss", "M/d/yyyy H:mm")
    got = [r[0] for r in df.select(parsed_moment(F.col("t"), formats).cast("string")).collect()]
    assert got == ["2018-01-31 22:56:00", "2018-01-31 22:56:00", None, None]


def test_growth_after_a_zero_month(spark):
    rows = [("2020-01-05", 1.0), ("2020-02-05", 0.0), ("2020-04-05", 3.0)]
    tx = spark.createDataFrame(rows, "d string, sales double").select(
        F.col("d").cast("timestamp_ntz").alias("order_date"), "sales", F.col("sales").alias("profit")
    )
    got = [r["mom_revenue_growth_pct"] for r in kpis.monthly_trend(tx).orderBy("month").collect()]
    assert got == [None, -100.0, None]


def test_retention_counts_customers_once_per_month(spark):
    rows = [(1, "2020-01-05"), (1, "2020-01-06"), (1, "2020-03-01"), (2, "2020-01-09"), (3, "2020-03-09")]
    tx = spark.createDataFrame(rows, "customer_id long, d string").select(
        "customer_id", F.col("d").cast("timestamp_ntz").alias("order_date")
    )
    got = {(r["cohort"], r["months_later"]): (r["customers"], r["retention"]) for r in kpis.cohort_retention(tx).collect()}
    assert got == {("2020-01", 0): (2, 1.0), ("2020-01", 2): (1, 0.5), ("2020-03", 0): (1, 1.0)}


def test_correlations_have_the_same_bits_for_any_partitioning(spark):
    rng = random.Random(2)
    rows = [tuple(rng.choice([None, float("nan"), rng.gauss(1e6 * (i % 3), 3.0), 0.1 * rng.random()]) if rng.random() < 0.9 else None for i in range(4)) for _ in range(900)]
    table = spark.createDataFrame(rows, "a double, b double, c double, d double")
    found = [kpis.correlation_matrix(table.repartition(n), ("a", "b", "c", "d")).collect() for n in (1, 3, 300)]
    assert found[0] == found[1] == found[2]
    frame = pd.DataFrame(rows, columns=list("abcd"), dtype=float)
    for r in found[0]:
        assert r["correlation"] == pytest.approx(frame[r["x"]].corr(frame[r["y"]]), abs=1e-9)


def test_correlations_copy_no_row(spark, monkeypatch):
    plans = []
    table = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.5, 5.0), (3.0, 5.0, 5.0)], "a double, b double, c double")
    collect = type(table).collect
    monkeypatch.setattr(type(table), "collect", lambda self: (plans.append(self._jdf.queryExecution().executedPlan().toString()), collect(self))[1])
    rows = {(r["x"], r["y"]): r["correlation"] for r in kpis.correlation_matrix(table, ("a", "b", "c")).collect()}
    assert len(plans) == 2 and "Generate" not in plans[0] and "Expand" not in plans[0]
    assert rows["a", "a"] == 1.0 and rows["a", "b"] == rows["b", "a"] and rows["a", "c"] is None and rows["c", "c"] is None
