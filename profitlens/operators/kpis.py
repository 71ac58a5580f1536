"""Company-wide KPIs, trends, customer value and category health."""

from __future__ import annotations

import math
from fractions import Fraction
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from profitlens.config import DEFAULTS
from profitlens.functions.arithmetic import (
    PARTIALS,
    exact_sum,
    mean,
    min_max_soft,
    partial_sums,
    pearson,
    percent_or_zero,
    ratio,
    total,
)
from profitlens.functions.dates import month_number, month_of
from profitlens.operators.aggregates import order_count
from profitlens.session import stage


LARGEST_FACTOR = float(1 << 43)


def macro_kpis(tx: DataFrame) -> DataFrame:
    """Revenue, profit, margins, order value, customers and orders in one row.

    Each row counts once for its category, with the amounts, once for its
    customer and once for its order. Grouped by those keys, mostly before the
    shuffle, they give category means and distinct counts in a single pass.
    """
    undiscounted = F.col("discount_rate") == 0
    nothing = F.lit(None).cast("double")
    amounts = {
        "revenue": F.col("sales"),
        "profit": F.col("profit"),
        "revenue0": F.when(undiscounted, F.col("sales")),
        "profit0": F.when(undiscounted, F.col("profit")),
        "benefit": F.col("benefit_per_order") if "benefit_per_order" in tx.columns else nothing,
    }
    category = F.col("category_name") if "category_name" in tx.columns else F.lit(None)
    profit_ratio = F.col("profit_ratio") if "profit_ratio" in tx.columns else nothing
    kind, by_category, by_customer, by_order = F.col("kind"), 0, 1, 2
    kinds = [by_category, by_customer] + ([by_order] if "order_id" in tx.columns else [])
    number = F.when(kind == by_customer, F.col("customer_id"))
    if by_order in kinds:
        number = number.when(kind == by_order, F.col("order_id"))
    grouped = (
        tx.withColumn("kind", F.explode(F.array(*[F.lit(k) for k in kinds])))
        .groupBy(
            "kind",
            F.when(kind == by_category, category.cast("string")).alias("text"),
            number.cast("bigint").alias("number"),
        )
        .agg(
            *[total(F.when(kind == by_category, value)).alias(name) for name, value in amounts.items()],
            mean(F.when(kind == by_category, profit_ratio)).alias("margin"),
            F.count("*").alias("rows"),
        )
    )

    def distinct(key: int) -> Column:
        return F.count_if((kind == key) & F.col("number").isNotNull())

    rows = F.coalesce(F.sum(F.when(kind == by_category, F.col("rows"))), F.lit(0))
    sums = grouped.agg(
        *[total(name).alias(name) for name in amounts],
        mean(F.when(F.col("text").isNotNull(), F.col("margin"))).alias("category_margin"),
        distinct(by_customer).alias("customers"),
        (distinct(by_order) if by_order in kinds else rows).alias("orders"),
    )
    margin = percent_or_zero(F.col("profit"), F.col("revenue"))
    margin0 = percent_or_zero(F.col("profit0"), F.col("revenue0"))
    benefit = F.col("benefit") if "benefit_per_order" in tx.columns else nothing
    return sums.select(
        F.round("revenue", 2).alias("total_revenue"),
        F.round("profit", 2).alias("total_profit"),
        F.round(margin, 4).alias("profit_margin_pct"),
        F.round(margin0, 4).alias("margin_zero_discount_pct"),
        F.round(margin0 - margin, 4).alias("discount_impact_ratio_pct"),
        F.round(F.coalesce(F.col("category_margin"), F.lit(0.0)) * 100, 4).alias("average_category_margin_pct"),
        F.round(F.coalesce(ratio(F.col("revenue"), F.col("orders")), F.lit(0.0)), 2).alias("average_order_value"),
        F.col("customers").alias("n_unique_customers"),
        F.col("orders").alias("n_orders"),
        benefit.alias("benefit_per_order_total"),
        F.round(benefit - F.col("profit"), 2).alias("benefit_vs_profit_delta"),
    )


def monthly_totals(tx: DataFrame) -> DataFrame:
    return (
        tx.withColumn("month", month_of(F.col("order_date")))
        .filter(F.col("month").isNotNull())
        .groupBy("month")
        .agg(
            total("sales").alias("monthly_revenue"),
            total("profit").alias("monthly_profit"),
            F.count("sales").alias("order_count"),
        )
    )


def _growth_pct(column: str, order: Window) -> Column:
    return (F.try_divide(F.col(column), F.lag(column).over(order)) - 1) * 100


def monthly_trend(tx: DataFrame) -> DataFrame:
    """Totals per month with growth over the previous month present; null after a zero month."""
    return growth(monthly_totals(tx))


def growth(months: DataFrame) -> DataFrame:
    """Monthly totals with growth over the previous month present."""
    by_month = Window.orderBy("month")  # one row per month: small by nature
    return months.withColumns({
        "mom_revenue_growth_pct": _growth_pct("monthly_revenue", by_month),
        "mom_profit_growth_pct": _growth_pct("monthly_profit", by_month),
    })


def rolling_trend(tx: DataFrame, months: int = 3) -> DataFrame:
    """Mean revenue and profit over the last months present."""
    last = Window.orderBy("month").rowsBetween(1 - months, Window.currentRow)
    return monthly_totals(tx).select(
        "month",
        "monthly_revenue",
        "monthly_profit",
        F.avg("monthly_revenue").over(last).alias("rolling_revenue"),
        F.avg("monthly_profit").over(last).alias("rolling_profit"),
    )


def running_best(df: DataFrame, order: str, value: str) -> DataFrame:
    """Best value so far, for short series such as months or tuning trials."""
    so_far = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("best_so_far", F.max(value).over(so_far))


def cohort_retention(tx: DataFrame) -> DataFrame:
    """Customers by month of first order who order again k months later.

    Rows shrink to one per customer and month before anything else, so the
    window over a customer holds at most one row per month.
    """
    active = (
        tx.select("customer_id", month_of(F.col("order_date")).alias("month"))
        .dropna()
        .distinct()
        .withColumn("cohort", F.min("month").over(Window.partitionBy("customer_id")))
    )
    counted = active.groupBy(
        "cohort", (month_number(F.col("month")) - month_number(F.col("cohort"))).alias("months_later")
    ).agg(F.count("*").alias("customers"))
    cohort = Window.partitionBy("cohort")
    size = F.max(F.when(F.col("months_later") == 0, F.col("customers"))).over(cohort)
    return counted.withColumn("cohort_size", size).withColumn(
        "retention", F.col("customers") / F.col("cohort_size")
    )


def customer_clv(tx: DataFrame, churn_max_orders: int = DEFAULTS.churn_max_orders) -> DataFrame:
    """Customer lifetime value: profit * (1 + ln(1 + orders)), and who ordered rarely."""
    base = (
        tx.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            total("sales").alias("total_revenue"),
            total("profit").alias("total_profit"),
            order_count(tx).alias("order_count"),
            mean("discount_rate").alias("avg_discount"),
        )
    )
    score = F.col("total_profit") * (1 + F.log1p(F.col("order_count").cast("double")))
    return base.withColumn("clv_score", score).withColumn(
        "churn_risk", F.col("order_count") <= churn_max_orders
    )


def category_health(tx: DataFrame) -> DataFrame:
    """0.6 scaled margin + 0.4 scaled volume per category, 0 to 1."""
    base = stage(
        tx.filter(F.col("category_name").isNotNull())
        .groupBy("category_name")
        .agg(
            total("sales").alias("total_revenue"),
            total("profit").alias("total_profit"),
            mean("profit_ratio").alias("avg_profit_ratio"),
            F.count("sales").alias("volume"),
        ),
        "category_health",
    )
    span = base.agg(
        F.struct(*[
            f(c).cast("double").alias(f"{name}_{c}")
            for c in ("avg_profit_ratio", "volume")
            for name, f in (("min", F.min), ("max", F.max))
        ])
    ).scalar()

    def scaled(c: str) -> Column:
        return min_max_soft(F.col(c).cast("double"), span[f"min_{c}"], span[f"max_{c}"])

    return base.withColumn(
        "health_score", F.round(0.6 * scaled("avg_profit_ratio") + 0.4 * scaled("volume"), 4)
    )


def segment_elasticity(tx: DataFrame) -> DataFrame:
    """Correlation of discount rate and profit per customer segment."""
    return (
        tx.filter(F.col("customer_segment").isNotNull())
        .groupBy("customer_segment")
        .agg(pearson("discount_rate", "profit").alias("discount_profit_correlation"))
    )


# Names of the bridge steps, in order.
BRIDGE_STEPS = ("Gross Revenue", "Costs & COGS", "Discount Leak", "Net Profit")


def margin_bridge(kpis: DataFrame) -> DataFrame:
    """From revenue to profit in four steps, out of the one-row KPI table."""
    revenue, profit = F.col("total_revenue"), F.col("total_profit")
    leak = F.col("discount_impact_ratio_pct") / 100 * revenue
    amounts = (revenue, -(revenue - profit - leak), -leak, profit)
    steps = F.array(*[
        F.struct(F.lit(i + 1).alias("step_no"), F.lit(name).alias("step"), amount.alias("amount"))
        for i, (name, amount) in enumerate(zip(BRIDGE_STEPS, amounts))
    ])
    return kpis.select(F.inline(steps))


CRITICAL_LOSS_PCT = 20.0


def loss_order_share(tx: DataFrame) -> DataFrame:
    """Share of loss-making rows in percent, and whether it is critical."""
    losses = F.count_if(F.col("profit") < 0)
    return tx.agg(F.count("*").alias("orders"), losses.alias("loss_orders")).select(
        "orders",
        "loss_orders",
        percent_or_zero(F.col("loss_orders"), F.col("orders")).alias("loss_share_pct"),
        (percent_or_zero(F.col("loss_orders"), F.col("orders")) > CRITICAL_LOSS_PCT).alias("is_critical"),
    )


def filtered_kpis(tx: DataFrame) -> DataFrame:
    """Headline numbers of a selection of rows (see ``cross_filter``), exact for any selection."""
    sums = tx.agg(
        total("sales").alias("revenue"),
        total("profit").alias("profit"),
        F.countDistinct("customer_id").alias("customers"),
        (order_count(tx) if "order_id" in tx.columns else F.count("*")).alias("orders"),
    )
    return headline(sums)


def headline(sums: DataFrame) -> DataFrame:
    """Margin and order value beside (revenue, profit, customers, orders)."""
    return sums.select(
        "revenue",
        "profit",
        percent_or_zero(F.col("profit"), F.col("revenue")).alias("margin_pct"),
        F.coalesce(ratio(F.col("revenue"), F.col("orders")), F.lit(0.0)).alias("average_order_value"),
        "customers",
        "orders",
    )


def discount_leak(kpis: DataFrame, selection: DataFrame) -> DataFrame:
    """Revenue of a selection lost to discounts, at the company-wide discount impact.

    ``kpis`` is the one-row KPI table, staged or read from where it was written.
    """
    impact = kpis.select("discount_impact_ratio_pct").scalar()
    return selection.withColumn("discount_leak", F.col("revenue") * impact / 100)


def correlation_matrix(
    tx: DataFrame,
    columns: tuple[str, ...] = ("discount_rate", "profit", "sales", "quantity", "profit_ratio"),
) -> DataFrame:
    """All pairwise correlations as a long table, from one pass that copies no row.

    Rows are grouped by which of the columns they have, so that the sums of a
    group serve all pairs whose columns it has. Values and products are summed
    as whole numbers and put together as fractions: the result is the same
    for any partitioning. At most 2^columns rows reach the driver. Values of 2^43
    and more, whose products ``total`` does not take, count as missing.
    """
    columns = tuple(c for c in columns if c in tx.columns)
    pairs = list(combinations_with_replacement(range(len(columns)), 2))
    numbers = tx.select(*[F.when(F.abs(F.col(c).cast("double")) < LARGEST_FACTOR, F.col(c).cast("double")).alias(f"x{i}") for i, c in enumerate(columns)])
    has = sum((F.when(F.col(f"x{i}").isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i in range(len(columns))), F.lit(0))
    sums = [s for i in range(len(columns)) for s in partial_sums(f"x{i}", f"s{i}")[:-1]]
    products = [s for i, j in pairs for s in partial_sums(F.col(f"x{i}") * F.col(f"x{j}"), f"p{i}_{j}")[:-1]]
    groups = numbers.groupBy(has.alias("has")).agg(F.count("*").alias("n"), *sums, *products).collect()

    def exact(name: str, i: int, j: int) -> Fraction:
        both = 1 << i | 1 << j
        return sum((exact_sum([int(g[f"{name}_{kind}"]) for kind in PARTIALS[:-1]]) for g in groups if g["has"] & both == both), Fraction(0))

    found = []
    for i, j in pairs:
        n = sum(g["n"] for g in groups if g["has"] & (1 << i | 1 << j) == 1 << i | 1 << j)

        def moment(a: int, b: int, n: int = n, i: int = i, j: int = j) -> Fraction:
            return exact(f"p{a}_{b}", i, j) * n - exact(f"s{a}", i, j) * exact(f"s{b}", i, j)

        spread, shared = moment(i, i) * moment(j, j), moment(i, j)
        value = math.copysign(math.sqrt(shared * shared / spread), shared) if spread else None
        found += [(columns[a], columns[b], value) for a, b in dict.fromkeys([(i, j), (j, i)])]
    return tx.sparkSession.createDataFrame(found, "x string, y string, correlation double")


def discount_profit_correlation(tx: DataFrame) -> DataFrame:
    return tx.agg(F.round(pearson("discount_rate", "profit"), 4).alias("discount_profit_correlation"))
