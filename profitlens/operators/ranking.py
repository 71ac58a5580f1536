"""Top and bottom lists: sorted by a measure, ties by the key, cut at n."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from profitlens.functions.arithmetic import total


def top(df: DataFrame, measure: str, key: str, n: int, lowest: bool = False) -> DataFrame:
    """The n best rows; each task keeps n rows, nothing is sorted as a whole."""
    order = F.col(measure).asc() if lowest else F.col(measure).desc()
    return df.orderBy(order, key).limit(n)


def ranked(df: DataFrame, measure: str, key: str) -> DataFrame:
    """All rows, best first."""
    return df.orderBy(F.col(measure).desc(), key)


def loss_products(products: DataFrame, n: int = 12) -> DataFrame:
    return top(products.filter(F.col("total_profit") < 0), "total_profit", "product_name", n, lowest=True)


def loss_products_total(products: DataFrame) -> DataFrame:
    """Number and loss of all loss-making products."""
    return products.filter(F.col("total_profit") < 0).agg(
        F.count("*").alias("loss_products"), total("total_profit").alias("total_loss")
    )


def abc_top_products(classified: DataFrame, n: int = 3) -> DataFrame:
    """Best n products per class.

    The limit reaches the window, so each task passes on n rows per class
    instead of whole classes.
    """
    best = Window.partitionBy("abc_class").orderBy(F.col("total_profit").desc(), "product_name")
    return (
        classified.select("abc_class", "product_name", "total_profit")
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= n)
    )


def above(df: DataFrame, score: str, threshold: float) -> DataFrame:
    return df.filter(F.col(score) >= threshold)


def high_risk_orders(scored: DataFrame, score: str, threshold: float, keys: list[str], n: int = 20) -> DataFrame:
    """The n riskiest rows from the threshold up."""
    return above(scored, score, threshold).orderBy(F.col(score).desc(), *keys).limit(n)


def high_risk_revenue(scored: DataFrame, score: str, revenue: str, threshold: float = 0.5) -> DataFrame:
    """How many customers reach the threshold and what they bring in."""
    risky = F.col(score) >= threshold
    return scored.agg(
        F.count_if(risky).alias("high_risk_customers"),
        total(F.when(risky, F.col(revenue))).alias("revenue_at_risk"),
    )


# --- display ---------------------------------------------------------------------


def dollars(value: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(value, 0))


def percent_text(value: Column, digits: int = 2) -> Column:
    return F.format_string(f"%.{digits}f%%", value)


def market_scorecard(markets: DataFrame) -> DataFrame:
    return ranked(markets, "profit_margin_pct", "market")


def formatted_scorecard(markets: DataFrame) -> DataFrame:
    """The scorecard as display text."""
    return market_scorecard(markets).select(
        "market",
        dollars(F.col("total_sales")).alias("total_sales"),
        dollars(F.col("total_profit")).alias("total_profit"),
        F.format_number("order_count", 0).alias("order_count"),
        percent_text(F.col("profit_margin_pct")).alias("profit_margin_pct"),
    )
