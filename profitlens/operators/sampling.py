"""A random sample of fixed size, and estimates from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from profitlens.config import DEFAULTS
from profitlens.functions.arithmetic import percent_or_zero, total
from profitlens.operators.filters import kept_columns
from profitlens.session import stage

# Columns the sample keeps.
SAMPLE_COLUMNS = (
    "discount_rate",
    "profit",
    "sales",
    "customer_segment",
    "category_name",
    "product_name",
    "market",
    "profit_ratio",
    "margin_band",
    "shipping_mode",
    "quantity",
    "late_delivery_risk",
)

ROW_IDENTITY = ("customer_id", "order_id", "product_name", "order_date", "ship_date", "quantity", "sales", "discount_rate")

HASH_DIGITS = 13  # hexadecimal digits of the md5: as many bits as a double holds exactly
HASH_RANGES = 1 << 16


def row_share(columns: Sequence[str], seed: int) -> Column:
    """A number in 0..1 that depends only on the row's own values, so a retried task agrees with itself."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in columns], F.lit(str(seed)))
    digits = F.conv(F.substring(F.md5(text), 1, HASH_DIGITS), 16, 10)
    return digits.cast("double") / F.lit(16.0**HASH_DIGITS)


def sample_rows(
    df: DataFrame, rows: int, seed: int = DEFAULTS.seed, identity: Sequence[str] = ROW_IDENTITY
) -> DataFrame:
    """Exactly ``min(rows, count)`` rows, the same ones each time.

    Counting rows per range of the row hash tells up to which range enough rows
    are found, so only about ``rows`` rows, not the table, meet in the final sort.
    """
    identity = [c for c in identity if c in df.columns]
    ranged = df.withColumn("_share", row_share(identity, seed)).withColumn(
        "_range", F.floor(F.col("_share") * HASH_RANGES)
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # At most HASH_RANGES + 1 rows; staged, so that each pass is planned on its own.
    sizes = stage(ranged.groupBy("_range").agg(F.count("*").alias("n")), "hash_ranges")
    last = (
        sizes.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .filter(F.col("before") < rows)
        .agg(F.max("_range"))
    )
    return (
        ranged.filter(F.col("_range") <= last.scalar())
        .orderBy("_share", *identity)
        .limit(rows)
        .drop("_share", "_range")
    )


def ui_sample(
    df: DataFrame, rows: int = DEFAULTS.sample_rows, seed: int = DEFAULTS.seed, columns: Sequence[str] = SAMPLE_COLUMNS
) -> DataFrame:
    """The columns of the sample that charts are drawn from."""
    return kept_columns(sample_rows(df, rows, seed), columns)


def sample_scaled_kpis(
    sample: DataFrame, selection: DataFrame, full_rows: Column
) -> DataFrame:
    """Estimate of a selection's totals: sample sums times full rows over sample rows, with standard errors.

    The error is that of a total over a random sample without replacement, in
    which rows outside of the selection count as 0; it is 0 for a whole table.
    """
    rows = sample.agg(F.count("*")).scalar()
    sums = selection.agg(
        *[value for c in ("sales", "profit") for value in (total(c).alias(c), total(F.col(c) * F.col(c)).alias(f"{c}_squares"))],
        F.count("*").alias("n"),
    ).withColumns({"rows": rows, "full": full_rows, "scale": F.try_divide(full_rows, rows)})

    def error(c: str) -> Column:
        spread = F.try_divide(F.col(f"{c}_squares") - F.try_divide(F.col(c) * F.col(c), F.col("rows")), F.col("rows") - 1)
        left_out = 1 - F.try_divide(F.col("rows"), F.col("full"))
        return F.col("full") * F.sqrt(F.greatest(F.try_divide(left_out * spread, F.col("rows")), F.lit(0.0)))

    return sums.select(
        (F.col("sales") * F.col("scale")).alias("estimated_revenue"),
        error("sales").alias("revenue_error"),
        (F.col("profit") * F.col("scale")).alias("estimated_profit"),
        error("profit").alias("profit_error"),
        percent_or_zero(F.col("profit"), F.col("sales")).alias("margin_pct"),
        F.floor(F.col("n") * F.col("scale")).cast("bigint").alias("estimated_orders"),
    )
