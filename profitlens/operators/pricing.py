"""Discount policy: curves, revenue at risk and what-if caps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profitlens.config import DEFAULTS
from profitlens.functions.arithmetic import mean, percent_or_zero, ratio, total

BRACKETS_PER_UNIT = 20  # brackets of five percent

# Buckets of the simulator as (upper bound included, label), from -0.01 exclusive.
DISCOUNT_BUCKETS = (
    (0.05, "0–5%"),
    (0.10, "5–10%"),
    (0.15, "10–15%"),
    (0.20, "15–20%"),
    (0.25, "20–25%"),
    (0.30, "25–30%"),
    (0.50, "30–50%"),
    (1.00, "50%+"),
)
BUCKETS_ABOVE = -0.01

# Caps of the sensitivity table.
CAP_SCENARIOS = (0.05, 0.10, 0.15, 0.20, 0.25, 0.30, 0.35, 0.40)


def discount_curve(tx: DataFrame) -> DataFrame:
    """Mean profit per five-percent bracket ``(low, high]``; undiscounted rows are in none."""
    # Rounding takes away the float noise of rate * 20 at the bracket edges.
    bracket = F.ceil(F.round(F.col("discount_rate") * BRACKETS_PER_UNIT, 6)).cast("bigint")
    return (
        tx.filter((F.col("discount_rate") > 0) & (F.col("discount_rate") <= 1))
        .groupBy(bracket.alias("bracket"))
        .agg(mean("profit").alias("avg_profit"))
        .select(
            ((F.col("bracket") - 1) / F.lit(float(BRACKETS_PER_UNIT))).alias("bracket_low"),
            (F.col("bracket") / F.lit(float(BRACKETS_PER_UNIT))).alias("bracket_high"),
            "avg_profit",
        )
    )


def discount_sensitivity(tx: DataFrame, up_to: float = 0.30) -> DataFrame:
    """Volume, margin and revenue per discount rate rounded to five percent."""
    return (
        tx.filter(F.col("discount_rate") <= up_to)
        .groupBy((F.round(F.col("discount_rate") * BRACKETS_PER_UNIT) / BRACKETS_PER_UNIT).alias("discount_bracket"))
        .agg(
            F.count("*").alias("order_count"),
            ratio(total("profit_ratio"), F.count("*")).alias("avg_margin"),
            total("sales").alias("total_revenue"),
        )
        .orderBy("discount_bracket")
    )


def discount_buckets(tx: DataFrame) -> DataFrame:
    """Orders and profit per simulator bucket; undiscounted rows are in the first."""
    rate = F.round("discount_rate", 6)
    bucket = F
    for i, (upper, _) in enumerate(DISCOUNT_BUCKETS):
        bucket = bucket.when((rate > BUCKETS_ABOVE) & (rate <= upper), i + 1)
    labels = F.array(*[F.lit(label) for _, label in DISCOUNT_BUCKETS])
    return (
        tx.withColumn("bucket_no", bucket)
        .filter(F.col("bucket_no").isNotNull())
        .groupBy("bucket_no")
        .agg(
            F.count("profit").alias("orders"),
            total("profit").alias("total_profit"),
            mean("profit").alias("avg_profit"),
        )
        .filter(F.col("orders") > 0)
        .select(
            F.get(labels, F.col("bucket_no") - 1).alias("discount_bucket"),
            "bucket_no", "orders", "total_profit", "avg_profit",
        )
    )


def beyond_cap(cap: float) -> Column:
    """Sales given away by discounts above the cap."""
    over = F.col("discount_rate") > cap
    return total(F.when(over, F.col("sales") * (F.col("discount_rate") - cap)))


def revenue_at_risk(tx: DataFrame, cap: float = DEFAULTS.discount_cap) -> DataFrame:
    """Sales given away beyond the cap."""
    return tx.agg(beyond_cap(cap).alias("revenue_at_risk"))


def discount_whatif(tx: DataFrame, cap: float = DEFAULTS.discount_cap) -> DataFrame:
    """Profit now, and if no discount went beyond the cap."""
    sums = tx.agg(
        total("profit").alias("current_profit"),
        F.count("*").alias("orders"),
        F.count_if(F.col("discount_rate") > cap).alias("breaching_orders"),
        beyond_cap(cap).alias("recovered"),
    )
    return sums.select(
        "current_profit",
        "breaching_orders",
        percent_or_zero(F.col("breaching_orders"), F.col("orders")).alias("breach_pct"),
        "recovered",
        (F.col("current_profit") + F.col("recovered")).alias("simulated_profit"),
        (F.col("recovered") / F.greatest(F.abs("current_profit"), F.lit(1.0)) * 100).alias("recovery_rate_pct"),
    )


def cap_sensitivity(
    tx: DataFrame, caps: Sequence[float] = CAP_SCENARIOS, selected: float | None = None
) -> DataFrame:
    """Breaching orders and recovery per cap: one pass, whatever the number of caps."""
    sums = tx.agg(
        F.count("*").alias("orders"),
        *[F.count_if(F.col("discount_rate") > cap).alias(f"n{i}") for i, cap in enumerate(caps)],
        *[beyond_cap(cap).alias(f"r{i}") for i, cap in enumerate(caps)],
    )
    current = DEFAULTS.discount_cap if selected is None else selected
    rows = F.array(*[
        F.struct(
            F.lit(cap).alias("cap"),
            F.col(f"n{i}").alias("breaching_orders"),
            percent_or_zero(F.col(f"n{i}"), F.col("orders")).alias("affected_pct"),
            F.col(f"r{i}").alias("estimated_recovery"),
            F.lit(abs(cap - current) < 0.005).alias("is_current_policy"),
        )
        for i, cap in enumerate(caps)
    ])
    return sums.select(F.inline(rows))


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Counts in equal-width bins between the smallest and largest value.

    Reads the column twice: stage it when it is costly to compute.
    """
    df = df.filter(F.col(value).isNotNull())
    span = df.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high"))).scalar()
    width = (span["high"] - span["low"]) / F.lit(float(bins))
    # A constant column has no width: everything is in the first bin.
    position = F.coalesce(F.floor(F.try_divide(F.col(value) - span["low"], width)), F.lit(0))
    return (
        df.groupBy(F.least(position, F.lit(bins - 1)).cast("bigint").alias("bin"))
        .agg(F.count("*").alias("orders"))
        .select(
            "bin",
            (span["low"] + F.col("bin") * width).alias("bin_low"),
            (span["low"] + (F.col("bin") + 1) * width).alias("bin_high"),
            "orders",
        )
    )
