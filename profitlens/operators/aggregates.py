"""Totals per customer, product, category, place and shipping mode.

Rows with a null key are left out of every grouping. Few-valued keys are no
problem for balance: sums and counts are combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profitlens.functions.arithmetic import mean, percent, ratio, ratio_or_zero, total
from profitlens.session import stage


def order_count(df: DataFrame) -> Column:
    """Distinct orders, or rows when there is no order id."""
    return F.countDistinct("order_id") if "order_id" in df.columns else F.count("sales")


def most_frequent(column: str) -> Column:
    """The most frequent value; the smallest of several."""
    return F.mode(column, True)


def customer_agg(tx: DataFrame, usual: tuple[str, ...] = ("customer_segment",)) -> DataFrame:
    """Sales, profit, discount, orders and value per customer, with their usual segment or more."""
    usual = tuple(c for c in usual if c in tx.columns)
    totals = (
        tx.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            total("sales").alias("total_sales"),
            total("profit").alias("total_profit"),
            mean("discount_rate").alias("avg_discount"),
            order_count(tx).alias("order_count"),
            mean("profit_ratio").alias("avg_profit_ratio"),
            *[most_frequent(c).alias(c) for c in usual],
        )
    )
    value = ratio_or_zero(F.col("total_profit"), F.col("order_count"))
    columns = ["customer_id", "total_sales", "total_profit", "avg_discount", "order_count", "avg_profit_ratio"]
    return totals.select(*columns, value.alias("customer_value_index"), *usual)


def customer_modes(
    tx: DataFrame, columns: tuple[str, ...] = ("customer_segment", "market", "order_region")
) -> DataFrame:
    """The usual value of each column per customer."""
    return (
        tx.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(*[most_frequent(c).alias(c) for c in columns if c in tx.columns])
    )


def customer_with_segment(tx: DataFrame) -> DataFrame:
    """Customer totals with their usual segment, from one pass instead of a join of two."""
    return customer_agg(tx, usual=("customer_segment",))


def category_agg(tx: DataFrame) -> DataFrame:
    """Category totals with revenue share and concentration."""
    totals = stage(
        tx.filter(F.col("category_name").isNotNull())
        .groupBy("category_name")
        .agg(
            total("sales").alias("total_sales"),
            total("profit").alias("total_profit"),
            mean("profit_ratio").alias("avg_profit_ratio"),
            total("quantity").alias("units_sold"),
        ),
        "category_totals",
    )
    revenue = totals.agg(total("total_sales")).scalar()
    return totals.withColumn("revenue_share", ratio(F.col("total_sales"), revenue)).withColumn(
        "hhi_contribution", F.col("revenue_share") * F.col("revenue_share")
    )


def product_agg(tx: DataFrame) -> DataFrame:
    totals = (
        tx.filter(F.col("product_name").isNotNull())
        .groupBy("product_name")
        .agg(
            total("sales").alias("total_sales"),
            total("profit").alias("total_profit"),
            total("quantity").alias("units_sold"),
            mean("discount_rate").alias("avg_discount"),
        )
    )
    return totals.withColumn(
        "profit_per_unit", ratio_or_zero(F.col("total_profit"), F.col("units_sold"))
    )


def _sales_totals() -> list[Column]:
    return [
        total("sales").alias("total_sales"),
        total("profit").alias("total_profit"),
        F.count("sales").alias("order_count"),
    ]


def _margin_pct() -> Column:
    return percent(F.col("total_profit"), F.col("total_sales"))


def place_agg(tx: DataFrame, key: str) -> DataFrame:
    """Sales, profit, rows and margin per value of ``key``."""
    return (
        tx.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(*_sales_totals())
        .withColumn("profit_margin_pct", _margin_pct())
    )


def market_agg(tx: DataFrame) -> DataFrame:
    return place_agg(tx, "market")


def region_agg(tx: DataFrame) -> DataFrame:
    return place_agg(tx, "order_region")


def country_agg(tx: DataFrame) -> DataFrame:
    return place_agg(tx, "order_country")


def places_agg(tx: DataFrame, keys: tuple[str, ...] = ("market", "order_region", "order_country")) -> DataFrame:
    """Totals of several place columns in one pass: ``(dimension, value, …)``.

    The finest combination is aggregated first, so only the few combinations
    are repeated per dimension.
    """
    keys = tuple(k for k in keys if k in tx.columns)
    finest = tx.groupBy(*keys).agg(
        total("sales").alias("sales"), total("profit").alias("profit"), F.count("sales").alias("n")
    )
    pairs = F.array(*[F.struct(F.lit(k).alias("dimension"), F.col(k).alias("value")) for k in keys])
    return (
        finest.select(F.inline(pairs), "sales", "profit", "n")
        .filter(F.col("value").isNotNull())
        .groupBy("dimension", "value")
        .agg(
            total("sales").alias("total_sales"),
            total("profit").alias("total_profit"),
            F.sum("n").alias("order_count"),
        )
        .withColumn("profit_margin_pct", _margin_pct())
    )


def shipping_agg(tx: DataFrame) -> DataFrame:
    """Totals per shipping mode, with the mean overrun where it is known."""
    overrun = [mean("delivery_overrun_days").alias("avg_overrun_days")]
    return (
        tx.filter(F.col("shipping_mode").isNotNull())
        .groupBy("shipping_mode")
        .agg(*_sales_totals(), *(overrun if "delivery_overrun_days" in tx.columns else []))
        .withColumn("profit_margin_pct", _margin_pct())
    )


# --- places on a map ------------------------------------------------------

MARKER_ORDERS_PER_UNIT = 10
MARKER_MIN, MARKER_MAX = 3.0, 15.0


def geo_nodes(tx: DataFrame) -> DataFrame:
    """Totals per coordinate pair (and city and country, where known)."""
    keys = ["latitude", "longitude", *[c for c in ("order_city", "order_country") if c in tx.columns]]
    return (
        tx.dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            total("profit").alias("total_profit"),
            total("sales").alias("total_sales"),
            F.count("sales").alias("order_count"),
        )
        .withColumn("profit_status", F.when(F.col("total_profit") >= 0, "Profitable").otherwise("Loss-Making"))
    )


def geo_summary(nodes: DataFrame) -> DataFrame:
    """Symmetric colour range and centre of the map."""
    return nodes.agg(
        F.greatest(F.abs(F.min("total_profit")), F.abs(F.max("total_profit"))).alias("color_range"),
        mean("latitude").alias("center_latitude"),
        mean("longitude").alias("center_longitude"),
        F.count("*").alias("nodes"),
    )


def geo_markers(nodes: DataFrame) -> DataFrame:
    """Marker radius by order count, within limits, and the layer a marker belongs to."""
    radius = F.col("order_count") / F.lit(float(MARKER_ORDERS_PER_UNIT))
    return nodes.withColumn(
        "radius", F.least(F.greatest(radius, F.lit(MARKER_MIN)), F.lit(MARKER_MAX))
    ).withColumn("color", F.when(F.col("total_profit") >= 0, "green").otherwise("red"))
