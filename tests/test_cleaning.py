"""Cleaning rules on small tables."""

import pytest
from pyspark.sql import functions as F

from profitlens.config import Thresholds
from profitlens.operators import aggregates, cleaning, filters, kpis

MONEY = "unit_price double, quantity double, discount_amount double, order_item_total double"


def test_financial_validation_keeps_what_adds_up(spark):
    rows = [(50.0, 2.0, 10.0, 90.0), (100.0, 1.0, 0.0, 100.0), (10.0, 5.0, 0.0, 999.0), (10.0, 1.0, None, 10.0)]
    kept = cleaning.filter_financials(spark.createDataFrame(rows, MONEY)).collect()
    assert [r["order_item_total"] for r in kept] == [90.0, 100.0]


def test_financial_validation_without_the_columns(spark):
    df = spark.createDataFrame([(1.0,)], "unit_price double")
    assert cleaning.tag_financials(df).first()["finval_ok"] is True


def test_nonnegative_sales(spark):
    kept = cleaning.nonnegative_sales(spark.createDataFrame([(100,), (200,), (-50,), (400,)], "sales int"))
    assert sorted(r[0] for r in kept.collect()) == [100, 200, 400]


def test_text_and_missing_values(spark):
    df = spark.createDataFrame([(" méxico ", 1.0, 1.0, 1), (None, None, 1.0, 1)], "customer_city string, sales double, profit double, customer_id int")
    assert [r["customer_city"] for r in cleaning.normalise_text(df).collect()] == ["MÉXICO", None]
    assert cleaning.drop_missing(df).count() == 1


def outlier_table(spark, sales):
    return spark.createDataFrame([(float(s), 1.0 * i, 0.1 * i) for i, s in enumerate(sales)], "sales double, profit double, discount_amount double")


def test_zscore_uses_the_population_deviation_and_drops_unknown(spark):
    df = outlier_table(spark, [10.0] * 50 + [11.0] * 50 + [1000.0]).unionByName(
        spark.createDataFrame([(None, 1.0, 1.0)], "sales double, profit double, discount_amount double")
    )
    kept = cleaning.outliers_zscore(df)
    assert kept.count() == 100 and kept.agg(F.max("sales")).first()[0] == 11.0


def test_constant_column_falls_back_to_quartiles(spark):
    df = outlier_table(spark, [5.0] * 40)
    assert cleaning.outlier_rule(df)[0] == "IQR"
    assert cleaning.outliers_adaptive(df).count() == 40


def test_quartile_rule_takes_over(spark):
    df = outlier_table(spark, [10.0, 11.0, 12.0, 13.0] * 10 + [500.0] * 3)
    settings = Thresholds(zscore_limit=1.0)
    assert cleaning.outlier_rule(df, settings)[0] == "IQR"
    assert cleaning.outliers_adaptive(df, settings).count() == 40


def test_clean_and_report_agree(spark):
    row = (1, 50.0, 2.0, 10.0, 90.0, 90.0, 5.0)
    rows = [row, row, row] + [(i, 50.0 + i, 2.0, 10.0, 90.0 + 2 * i, 90.0, 5.0 + i) for i in range(2, 30)]
    rows += [(99, 1.0, 1.0, 0.0, 55.0, 1.0, 1.0), (98, 1.0, 1.0, 0.0, 1.0, None, 1.0)]
    df = spark.createDataFrame(rows, f"customer_id int, {MONEY}, sales double, profit double")
    clean, report = cleaning.clean_with_report(df, Thresholds(zscore_limit=50.0))
    got = report.first().asDict()
    assert (got["initial_rows"], got["dropped_duplicates"]) == (33, 2)
    assert (got["dropped_missing"], got["financial_mismatches"]) == (1, 1)
    assert got["final_rows"] == clean.count() == 33 - 2 - 1 - 1 - got["outliers_removed"]
    assert clean.columns == df.columns


def test_bands_include_their_upper_bound(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (0.10,), (0.25,), (0.3,), (None,)], "profit_ratio double")
    assert [r["margin_band"] for r in cleaning.with_margin_band(df).collect()] == [
        "Loss", "Loss", "Thin (<10%)", "Healthy (10-25%)", "Star (>25%)", None,
    ]


def test_overrun_without_dates(spark):
    df = spark.createDataFrame([(5, 3)], "real_days int, scheduled_days int")
    assert cleaning.with_delivery_overrun(df).first()["delivery_overrun_days"] == 2
    assert cleaning.with_delivery_overrun(df.drop("scheduled_days")).columns == ["real_days"]


def test_null_keys_are_left_out(spark):
    df = spark.createDataFrame([("EU", 1.0, 1.0), (None, 2.0, 2.0)], "market string, sales double, profit double")
    assert [r["market"] for r in aggregates.market_agg(df).collect()] == ["EU"]
    assert [r["value"] for r in aggregates.places_agg(df).collect()] == ["EU"]


def test_most_frequent_value_takes_the_smallest_of_several(spark):
    rows = [(1, s) for s in "baba"] + [(2, None), (2, "c")]
    got = aggregates.customer_modes(spark.createDataFrame(rows, "customer_id long, customer_segment string"))
    assert dict(got.collect()) == {1: "a", 2: "c"}


@pytest.fixture
def without_order_id(spark):
    return spark.createDataFrame(
        [(1, 10.0, 1.0, 0.0, 0.1), (1, 20.0, 2.0, 0.1, 0.1)],
        "customer_id long, sales double, profit double, discount_rate double, profit_ratio double",
    )


def test_rows_count_as_orders_without_order_id(without_order_id):
    assert aggregates.customer_agg(without_order_id).first()["order_count"] == 2
    row = kpis.macro_kpis(without_order_id).first()
    assert row["n_orders"] == 2 and row["benefit_per_order_total"] is None
    assert row["average_category_margin_pct"] == 0.0


def test_selection_and_options(spark):
    df = spark.createDataFrame([("A", "X"), ("B", "X"), (None, "Y")], "customer_segment string, market string")
    assert filters.cross_filter(df, customer_segment=["A"], market=[]).count() == 1
    assert filters.cross_filter(df, category_name=["Z"]).count() == 3
    assert [tuple(r) for r in filters.filter_options(df).collect()] == [
        ("customer_segment", "A"), ("customer_segment", "B"), ("market", "X"), ("market", "Y"),
    ]


COPIED = [
    (1, "a", 1.0, None), (1, "a", 1.0, None), (1, "a", None, 1.0), (1, None, 1.0, 1.0), (None, None, None, None), (None, None, None, None),
    (2, "b", 0.0, 2.0), (2, "b", -0.0, 2.0), (3, "c", float("nan"), 1.0), (3, "c", float("nan"), 1.0), (4, "", 1.0, 1.0), (5, "x.y", 1.0, 1.0),
]


def counted(rows):
    return sorted(repr(tuple(r)).replace("-0.0", "0.0") for r in rows)  # NaN equals itself in print


@pytest.mark.parametrize("digest", [
    cleaning.row_digest,
    lambda df: (F.lit(7).cast("bigint"), F.lit(7).cast("bigint")),  # all digests clash
    lambda df: (F.pmod(F.xxhash64("`k.1`"), F.lit(2)), F.lit(0).cast("bigint")),
])
def test_copies_are_counted_whatever_the_digests(spark, digest):
    df = spark.createDataFrame(COPIED, "`k.1` int, t string, x double, y double").repartition(3)
    found = cleaning.counted_rows(df, digest)
    expected = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).count()
    assert counted(found.collect()) == counted(expected.collect())
    none = df.limit(0)
    assert cleaning.counted_rows(none, digest).count() == 0


def test_rows_without_copies_are_not_shuffled(spark):
    """Of many rows a tenth are copies: the rows that travel are few, the digests narrow."""
    wide = spark.range(5000).select(F.col("id"), *[F.md5(F.concat("id", F.lit(i))).alias(f"c{i}") for i in range(12)])
    df = wide.unionByName(wide.filter("id % 20 = 0")).repartition(3)
    found = cleaning.counted_rows(df)
    assert found.count() == 5000 and found.filter("_copies = 2").count() == 250
    first, _ = cleaning.row_digest(df)
    copied = df.groupBy(first.alias("d")).count().filter("count > 1")
    held = df.filter(cleaning.Bitmap.of(copied, "d", 250).may_hold(first)).count()
    assert 500 <= held < 600  # the copies, and few others


def test_a_full_bitmap_still_gives_whole_results(spark, monkeypatch):
    df = spark.range(300).selectExpr("id % 200 as a", "id % 200 as b").repartition(4)
    of = cleaning.Bitmap.of
    monkeypatch.setattr(cleaning.Bitmap, "of", classmethod(lambda cls, keys, key, rows: of(keys, key, rows, most_words=1)))
    found = cleaning.counted_rows(df)
    assert found.count() == 200 and found.filter("_copies = 2").count() == 100
