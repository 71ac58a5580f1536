"""Customer and product segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profitlens.config import DEFAULTS
from profitlens.functions.arithmetic import min_max, ratio_or_zero, total
from profitlens.functions.dates import whole_days
from profitlens.functions.ordered import QUARTERS, quantiles, quartile_score, running_totals
from profitlens.operators.aggregates import order_count

# Lowest total score of each segment.
RFM_LABELS = ((10, "Champions"), (8, "Loyal"), (6, "Potential Loyalist"), (4, "At Risk"))
RFM_LOWEST = "Lost"


def rfm_base(tx: DataFrame) -> DataFrame:
    """Last order, number of orders and sales per customer; no last order without dates."""
    dates = [F.max("order_date").alias("last_order")] if "order_date" in tx.columns else []
    return (
        tx.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(*dates, order_count(tx).alias("frequency"), total("sales").alias("monetary"))
    )


def rfm_segments(base: DataFrame) -> DataFrame:
    """Quartile scores and segment per customer, from ``rfm_base``.

    Recency counts the days up to the last order of all. ``base`` is read
    several times: stage it when it is costly to compute.
    """
    if "last_order" in base.columns:
        snapshot = base.agg(F.max("last_order")).scalar()
        base = base.withColumn("recency", whole_days(F.col("last_order"), snapshot)).drop("last_order")
    measures = [c for c in ("recency", "frequency", "monetary") if c in base.columns]
    edges = quantiles(base, measures, QUARTERS)
    # Few days since the last order is good, few orders and low sales are not.
    scored = base.withColumns({
        f"{c}_score": quartile_score(F.col(c), edges[c], lowest_first=c != "recency") for c in measures
    })
    points = F.lit(0)
    for c in measures:
        points = points + F.coalesce(F.col(f"{c}_score"), F.lit(0))
    label = F
    for lowest, name in RFM_LABELS:
        label = label.when(F.col("rfm_total") >= lowest, name)
    return scored.withColumn("rfm_total", points).withColumn("rfm_segment", label.otherwise(RFM_LOWEST))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("customers"))


def share_of_base(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage of all rows per value."""
    base = df.agg(F.count("*")).scalar()
    return value_counts(df, column).withColumn("share_pct", F.col("customers") / base * 100)


# Names of the value classes.
VIP, BLEEDER, LOW_VALUE, STANDARD = (
    "VIP (High Value)",
    "Bleeder (High Vol, Loss)",
    "Low Value (Drain)",
    "Standard",
)


def customer_segmentation(customers: DataFrame, quantile: float = DEFAULTS.bleeder_quantile) -> DataFrame:
    """Value matrix: high or low sales against profit or loss. ``customers`` is read twice."""
    high = F.col("total_sales") >= F.lit(quantiles(customers, ["total_sales"], (quantile,))["total_sales"][0])
    gain = F.col("total_profit") > 0
    return customers.withColumn(
        "segment_class",
        F.when(high & gain, VIP).when(high & ~gain, BLEEDER).when(~high & ~gain, LOW_VALUE).otherwise(STANDARD),
    )


def bleeder_count(segmented: DataFrame) -> DataFrame:
    return segmented.agg(F.count_if(F.col("segment_class") == BLEEDER).alias("n_bleeders"))


def customer_tier(customers: DataFrame) -> DataFrame:
    """VIP, Loyal or Occasional by sales and orders."""
    sales, orders = F.col("total_sales"), F.col("order_count")
    return customers.withColumn(
        "tier",
        F.when((sales > 5000) & (orders >= 10), "VIP").when(sales > 1000, "Loyal").otherwise("Occasional"),
    )


# --- products ---------------------------------------------------------------


def product_margin(products: DataFrame) -> DataFrame:
    """Profit over sales, 0 without sales."""
    return products.withColumn("margin", ratio_or_zero(F.col("total_profit"), F.col("total_sales")))


def product_efficiency(products: DataFrame) -> DataFrame:
    """Efficiency index: 0.4 margin + 0.3 profit per unit + 0.3 volume share, each scaled to 0..1."""
    units = products.agg(total("units_sold")).scalar()
    rated = (
        product_margin(products)
        .withColumn("profit_density", F.col("profit_per_unit"))
        .withColumn("volume_contribution", F.try_divide(F.col("units_sold"), units))
    )
    weights = {"margin": 0.4, "profit_density": 0.3, "volume_contribution": 0.3}
    span = rated.agg(
        F.struct(*[f(c).alias(f"{n}_{c}") for c in weights for n, f in (("min", F.min), ("max", F.max))])
    ).scalar()
    index = sum(
        (F.lit(w) * min_max(F.col(c), span[f"min_{c}"], span[f"max_{c}"]) for c, w in weights.items()),
        F.lit(0.0),
    )
    return rated.withColumn("product_efficiency_index", index)


# Names of the quadrants.
STARS, NICHE, CASH_COWS, DOGS = (
    "Stars (High Vol, High Margin)",
    "Niche (Low Vol, High Margin)",
    "Cash Cows (High Vol, Low Margin)",
    "Dogs (Low Vol, Low Margin)",
)


def product_quadrants(products: DataFrame, min_sales: float = 1000.0) -> DataFrame:
    """Quadrant by median units and median margin of the products that sell enough."""
    selling = product_margin(products).filter(F.col("total_sales") > min_sales)
    medians = quantiles(selling, ["units_sold", "margin"], (0.5,))
    volume = F.col("units_sold") >= F.lit(medians["units_sold"][0])
    margin = F.col("margin") >= F.lit(medians["margin"][0])
    return selling.withColumn(
        "quadrant",
        F.when(volume & margin, STARS).when(~volume & margin, NICHE).when(volume & ~margin, CASH_COWS).otherwise(DOGS),
    )


MONEY = "decimal(38,12)"  # running totals add up exactly, wherever the slices are cut


# --- concentration ------------------------------------------------------------


def pareto_curve(customers: DataFrame) -> DataFrame:
    """Cumulative profit share of the profitable customers, best first."""
    winners = (
        customers.filter(F.col("total_profit") > 0)
        .select("customer_id", "total_profit")
        .withColumn("_one", F.lit(1).cast("bigint"))
        .withColumn("_money", F.col("total_profit").cast(MONEY))
    )
    whole = winners.agg(total("total_profit")).scalar()
    return (
        running_totals(
            winners,
            by="total_profit",
            totals={"_money": "_cumulative", "_one": "customer_rank"},
            tie="customer_id",
            descending=True,
        )
        .withColumn("cumulative_profit", F.col("_cumulative").cast("double"))
        .withColumn("cumulative_pct", F.col("cumulative_profit") / whole)
        .select("customer_id", "total_profit", "customer_rank", "cumulative_profit", "cumulative_pct")
    )


def pareto_pct(customers: DataFrame, target: float = DEFAULTS.pareto_target) -> DataFrame:
    """Percentage of all customers that bring the target share of positive profit."""
    base = customers.agg(F.count("*")).scalar()
    return (
        pareto_curve(customers)
        .agg(F.count_if(F.col("cumulative_pct") <= target).alias("pareto_customers"))
        .withColumn(
            "pareto_pct",
            F.round(F.coalesce(F.try_divide(F.col("pareto_customers"), base), F.lit(0.0)) * 100, 2),
        )
    )


# Class labels.
ABC_A, ABC_B, ABC_C = "A (Top 70%)", "B (70–90%)", "C (Bottom 10%)"


def abc_classification(
    products: DataFrame, a_share: float = DEFAULTS.abc_a_share, b_share: float = DEFAULTS.abc_b_share
) -> DataFrame:
    """Class by cumulative share of the profit of all products, best first.

    Loss makers are part of the whole, so the share can pass 1 and fall again.
    """
    whole = products.agg(total("total_profit")).scalar()
    share = F.try_divide(F.col("_cumulative").cast("double"), whole)
    return (
        running_totals(
            products.withColumn("_money", F.col("total_profit").cast(MONEY)),
            by="total_profit",
            totals={"_money": "_cumulative"},
            tie="product_name",
            descending=True,
        )
        .withColumn("cumulative_profit_pct", share)
        .drop("_money", "_cumulative")
        .withColumn(
            "abc_class",
            F.when(F.col("cumulative_profit_pct") <= a_share, ABC_A)
            .when(F.col("cumulative_profit_pct") <= b_share, ABC_B)
            .otherwise(ABC_C),
        )
    )


def abc_summary(classified: DataFrame) -> DataFrame:
    return classified.groupBy("abc_class").agg(
        F.count("*").alias("products"), total("total_profit").alias("total_profit")
    )


# --- traffic lights -------------------------------------------------------------


def _light(value: Column, red_below: float, amber_below: float) -> Column:
    return (
        F.when(value < red_below, "red").when(value < amber_below, "amber").when(value.isNotNull(), "green")
    )


def region_margin_band(regions: DataFrame) -> DataFrame:
    return regions.withColumn("band", _light(F.col("profit_margin_pct"), 10.0, 20.0))


def health_band(categories: DataFrame) -> DataFrame:
    """The score runs from 0 to 1, the limits are on a scale of 100."""
    return categories.withColumn("band", _light(F.col("health_score") * 100, 33.0, 66.0))


def elasticity_band(elasticity: DataFrame) -> DataFrame:
    return elasticity.withColumn("band", _light(F.col("discount_profit_correlation"), -0.065, -0.060))
