"""All registered queries: name -> function of (session, data folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from profitlens.config import Thresholds
from profitlens.functions.arithmetic import total
from profitlens.ml import features as mlf
from profitlens.ml import attribution, importance, metrics, models, report, tuning
from profitlens.operators import aggregates, cleaning, cube, filters, kpis, pricing, ranking, sampling, segments
from profitlens.plans import batch, refresh
from profitlens.plans import models as training
from profitlens.session import stage, staged_path
from profitlens.sources import csv, star, tables

Query = Callable[[SparkSession, str], DataFrame]

# The test discounts end at 10 %, so policy queries use a cap inside that range.
CAP = 0.05
LOW_CAPS = (0.02, 0.03, 0.04, 0.05, 0.06, 0.07, 0.08)
ACCENTS = " é Übergröße ñ"
MONEY_KEYS = ["customer_id", "order_id", "product_name", "sales", "discount_rate", "ship_date"]

_registry: dict[str, Query] = {}


def query(name: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        _registry[name or function.__name__] = function
        return function

    return add


def all_queries() -> dict[str, Query]:
    return dict(_registry)


# --- shared inputs ------------------------------------------------------------

tx = star.transactions


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return stage(aggregates.customer_agg(tx(spark, folder), usual=()), "customers")


def products(spark: SparkSession, folder: str) -> DataFrame:
    items = tx(spark, folder, "product_name", "sales", "profit", "quantity", "discount_rate")
    return stage(aggregates.product_agg(items), "products")


def efficient_products(spark: SparkSession, folder: str) -> DataFrame:
    return segments.product_efficiency(products(spark, folder))


def rfm(spark: SparkSession, folder: str) -> DataFrame:
    return segments.rfm_segments(stage(segments.rfm_base(tx(spark, folder)), "rfm_base"))


def with_faults(spark: SparkSession, folder: str) -> DataFrame:
    """Order items with faults derived from their quantity: copies, missing sales, wrong totals."""
    rows = tx(spark, folder).withColumns({
        "sales": F.when(F.col("quantity") != 49, F.col("sales")),
        "order_item_total": F.col("order_item_total") + F.when(F.col("quantity") == 48, 1.0).otherwise(0.0),
    })
    copies = F.when(F.col("quantity") == 50, 2).otherwise(1)
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")


FAULTY_COLUMNS = (
    "customer_id", "order_id", "product_name", "quantity", "unit_price", "discount_amount",
    "discount_rate", "order_item_total", "sales", "profit", "ship_date",
)


def faulty(spark: SparkSession, folder: str) -> DataFrame:
    return with_faults(spark, folder).select(*FAULTY_COLUMNS)


def order_checksum() -> Column:
    """Tells sets of rows apart; the remainder keeps the sum small for any number of rows."""
    return F.coalesce(F.sum(F.pmod("order_id", F.lit(1_000_003))), F.lit(0))


def row_summary(df: DataFrame) -> DataFrame:
    """Totals that tell which rows a filter kept."""
    return df.agg(
        F.count("*").alias("rows"),
        order_checksum().alias("order_id_sum"),
        total("sales").alias("sales_sum"),
        total("profit").alias("profit_sum"),
        total("discount_amount").alias("discount_sum"),
    )


def rule_score(df: DataFrame) -> DataFrame:
    """A risk score by rule, in place of a fitted one: half for a loss, the rest by discount."""
    return df.withColumn(
        "risk_score",
        F.round(F.when(F.col("profit") < 0, 0.5).otherwise(0.0) + F.col("discount_rate") * 5, 6),
    )


def customer_rule_score(table: DataFrame) -> DataFrame:
    return table.withColumn(
        "ltv_score", F.round(F.col("order_count") / (F.col("order_count") + 10), 6)
    )


# --- sources and sinks ----------------------------------------------------------


@query()
def csv_scan(spark, folder):
    path = staged_path(spark, "transactions.csv")
    columns = [
        "customer_id", "order_id", "product_name", "market", "order_date", "quantity", "sales",
        "profit", "discount_rate", "late_delivery_risk",
    ]
    csv.write_transactions_csv(tx(spark, folder).select(*columns), path)
    return csv.read_transactions_csv(spark, path).withColumn("order_date", F.col("order_date").cast("string"))


@query()
def csv_encodings(spark, folder):
    """Names beyond ASCII from a folder in which one file is Latin-1 and the other UTF-8, told apart value by value."""
    named = tx(spark, folder, "customer_id", "order_id", "product_name", "sales").withColumn("product_name", F.concat("product_name", F.lit(ACCENTS)))
    path = staged_path(spark, "encodings")
    for name, rest in (("ISO-8859-1", 0), ("UTF-8", 1)):
        csv.write_transactions_csv(named.filter(F.pmod("order_id", F.lit(2)) == rest), f"{path}/{name}", name)
    found = csv.read_transactions_csv(spark, f"{path}/*")
    return found.groupBy("product_name").agg(F.count("*").alias("rows"), total("sales").alias("total_sales"))


@query()
def orphan_keys(spark, folder):
    return star.orphans(spark, folder)


@query()
def normalise_columns(spark, folder):
    raw = tx(spark, folder).select(
        F.col("customer_id").alias("Customer_ID"),
        F.col("benefit_per_order").alias("Benefit_Per_Order"),
        F.col("profit").alias("ORDER PROFIT PER ORDER"),
    )
    named = csv.normalise_columns(raw)
    return named.groupBy("customer_id").agg(
        total("benefit_per_order").alias("benefit_per_order"),
        total("profit").alias("profit"),
    )


@query()
def typed_transactions(spark, folder):
    source = tx(spark, folder)
    text = source.select(
        F.col("order_id").cast("string").alias("order_id"),
        F.when(F.col("quantity") == 49, "n/a")
        .when(F.col("quantity") == 48, "NaN")
        .otherwise(F.col("quantity").cast("string"))
        .alias("quantity"),
        F.col("sales").cast("string").alias("sales"),
        F.when(F.col("late_delivery_risk") == 1, "1").otherwise("no").alias("late_delivery_risk"),
        "market",
    )
    # Widened for the comparison: a frame with missing integers differs by engine.
    return csv.cast_tolerant(text).withColumn("late_delivery_risk", F.col("late_delivery_risk").cast("double"))


@query()
def parquet_roundtrip(spark, folder):
    target = staged_path(spark, "out")
    return spark.read.parquet(tables.write_table(aggregates.market_agg(tx(spark, folder)), target, "market_agg"))


@query()
def narrow_floats(spark, folder):
    narrow = tables.narrow_floats(tx(spark, folder).select("order_id", "sales", "profit"))
    return narrow.select("order_id", F.col("sales").cast("double"), F.col("profit").cast("double"))


@query()
def view_catalog(spark, folder):
    target = staged_path(spark, "aggregations")
    items = tx(spark, folder)
    tables.write_table(aggregates.market_agg(items), target, "market_agg")
    tables.write_table(aggregates.shipping_agg(items), target, "shipping_agg")
    tables.register_views(spark, tables.list_tables(spark, target))
    return tables.run_sql(
        spark,
        "SELECT 'market_agg' AS view_name, market AS key, total_sales, order_count FROM market_agg "
        "UNION ALL SELECT 'shipping_agg', shipping_mode, total_sales, order_count FROM shipping_agg",
    )


@query()
def sql_query(spark, folder):
    tx(spark, folder).createOrReplaceTempView("transactions")
    return tables.run_sql(
        spark,
        "SELECT market, count(*) AS orders, sum(sales) AS total_sales FROM transactions "
        "WHERE sales > :min_sales AND customer_segment = :segment GROUP BY market",
        {"min_sales": 1000.0, "segment": "BUILDING"},
    )


@query()
def preview(spark, folder):
    return tables.preview(tx(spark, folder).select(*MONEY_KEYS[:-1], "profit"), [*MONEY_KEYS[:-1], "profit"], 100)


@query()
def ui_sample(spark, folder):
    rows = cleaning.with_margin_band(tx(spark, folder))
    return sampling.ui_sample(rows)


# --- cleaning, filters, projections -----------------------------------------------


@query()
def dedup_rows(spark, folder):
    return row_summary(cleaning.drop_duplicate_rows(faulty(spark, folder)))


@query()
def drop_missing(spark, folder):
    return row_summary(cleaning.drop_missing(faulty(spark, folder)))


@query()
def normalise_text(spark, folder):
    named = star.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.lit("  "), F.lower("c_name"), F.lit(" ")).alias("customer_city"),
    )
    return cleaning.normalise_text(named)


@query()
def parse_dates(spark, folder):
    moment = F.col("o_orderdate")
    written = star.table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.pmod("o_orderkey", F.lit(10)) == 0, "not a date")
        .when(F.pmod("o_orderkey", F.lit(10)) == 1, F.date_format(moment, "M/d/yyyy H:mm"))
        .otherwise(F.date_format(moment, "yyyy-MM-dd HH:mm:ss"))
        .alias("order_date"),
    )
    return cleaning.parse_dates(written, ["order_date"]).select(
        F.col("o_orderkey").alias("order_id"), F.col("order_date").cast("string").alias("order_date")
    )


@query()
def financial_validation(spark, folder):
    return (
        cleaning.tag_financials(faulty(spark, folder))
        .groupBy("finval_ok")
        .agg(F.count("*").alias("rows"), order_checksum().alias("order_id_sum"))
    )


@query()
def financial_filter(spark, folder):
    return row_summary(cleaning.filter_financials(faulty(spark, folder)))


def measures(spark: SparkSession, folder: str) -> DataFrame:
    """What the outlier rules look at, joined once: they read it several times."""
    return stage(tx(spark, folder, "order_id", "sales", "profit", "discount_amount"), "measures")


@query()
def outliers_zscore(spark, folder):
    return row_summary(cleaning.outliers_zscore(measures(spark, folder)))


@query()
def outliers_iqr(spark, folder):
    return row_summary(cleaning.outliers_iqr(measures(spark, folder), factor=1.5))


@query()
def outliers_iqr_default(spark, folder):
    """The default factor on sales with a long tail, where it takes rows out."""
    scaled = F.col("sales") / 10_000
    tailed = measures(spark, folder).withColumn("sales", scaled * scaled * scaled * scaled * scaled * scaled)
    return row_summary(cleaning.outliers_iqr(stage(tailed, "long_tail")))


@query()
def outliers_adaptive(spark, folder):
    return row_summary(cleaning.outliers_adaptive(measures(spark, folder)))


@query()
def outliers_adaptive_iqr(spark, folder):
    """A low z-score limit removes too many rows, so the quartile rule decides."""
    return row_summary(cleaning.outliers_adaptive(measures(spark, folder), Thresholds(zscore_limit=2.0, iqr_factor=1.0)))


@query()
def cleaning_report(spark, folder):
    return cleaning.cleaning_report(faulty(spark, folder))


@query()
def clean_transactions(spark, folder):
    return row_summary(cleaning.clean(faulty(spark, folder)))


@query()
def margin_band(spark, folder):
    banded = cleaning.with_margin_band(tx(spark, folder))
    return banded.groupBy("margin_band").agg(F.count("*").alias("orders"), order_checksum().alias("order_id_sum"))


@query()
def delivery_delay(spark, folder):
    delayed = cleaning.with_delivery_delay(tx(spark, folder))
    return delayed.groupBy("delivery_delay_days").agg(F.count("*").alias("orders"))


@query()
def delivery_overrun(spark, folder):
    return cleaning.with_delivery_overrun(tx(spark, folder)).groupBy("shipping_mode").agg(
        F.sum("delivery_overrun_days").alias("overrun_days"),
        F.min("delivery_overrun_days").alias("min_overrun"),
        F.max("delivery_overrun_days").alias("max_overrun"),
    )


SELECTION = {"customer_segment": ["BUILDING", "MACHINERY"], "market": ["ASIA", "EUROPE"], "category_name": []}


@query()
def cross_filter(spark, folder):
    return row_summary(filters.cross_filter(tx(spark, folder), **SELECTION))


@query()
def filter_options(spark, folder):
    return filters.filter_options(tx(spark, folder))


@query()
def policy_breach_orders(spark, folder):
    return filters.tag_policy_breach(tx(spark, folder), CAP).groupBy("policy").agg(
        F.count("*").alias("orders"), total("profit").alias("profit")
    )


@query()
def policy_breach_rows(spark, folder):
    return filters.policy_breaches(tx(spark, folder), 0.09).select(
        "customer_id", "order_id", "product_name", "sales", "profit", "discount_rate"
    )


@query()
def nonnegative_sales(spark, folder):
    shifted = tx(spark, folder).withColumn("sales", F.round(F.col("sales") - 1000, 4))
    return row_summary(cleaning.nonnegative_sales(shifted))


@query()
def formatted_scorecard(spark, folder):
    return ranking.formatted_scorecard(aggregates.market_agg(tx(spark, folder)))


# --- joins --------------------------------------------------------------------------


@query()
def transactions_join(spark, folder):
    return tx(spark, folder).groupBy("market", "customer_segment", "category_name", "department_name").agg(
        F.count("*").alias("items"),
        total("sales").alias("sales"),
        total("profit").alias("profit"),
        F.sum("late_delivery_risk").alias("late"),
    )


@query()
def customer_with_segment(spark, folder):
    return aggregates.customer_with_segment(tx(spark, folder))


@query()
def score_lookup_join(spark, folder):
    base = customers(spark, folder)
    scores = customer_rule_score(base).select("customer_id", "ltv_score").filter(F.col("ltv_score") >= 0.4)
    return base.join(scores, "customer_id").select("customer_id", "total_sales", "order_count", "ltv_score")


# --- aggregates ------------------------------------------------------------------------


@query()
def macro_kpis(spark, folder):
    return kpis.macro_kpis(tx(spark, folder))


@query()
def monthly_trend(spark, folder):
    return kpis.monthly_trend(tx(spark, folder))


@query()
def customer_clv(spark, folder):
    return kpis.customer_clv(tx(spark, folder))


@query()
def category_health(spark, folder):
    return kpis.category_health(tx(spark, folder, "category_name", "sales", "profit", "profit_ratio"))


@query()
def segment_elasticity(spark, folder):
    return kpis.segment_elasticity(tx(spark, folder, "customer_segment", "discount_rate", "profit"))


@query()
def customer_agg(spark, folder):
    return aggregates.customer_agg(tx(spark, folder))


@query()
def customer_modes(spark, folder):
    return aggregates.customer_modes(tx(spark, folder), ("customer_segment", "shipping_mode", "category_name"))


@query()
def category_agg(spark, folder):
    return aggregates.category_agg(tx(spark, folder, "category_name", "sales", "profit", "profit_ratio", "quantity"))


@query()
def product_agg(spark, folder):
    return aggregates.product_agg(tx(spark, folder, "product_name", "sales", "profit", "quantity", "discount_rate"))


@query()
def market_agg(spark, folder):
    return aggregates.market_agg(tx(spark, folder))


@query()
def region_agg(spark, folder):
    return aggregates.region_agg(tx(spark, folder))


@query()
def country_agg(spark, folder):
    return aggregates.country_agg(tx(spark, folder))


@query()
def places_agg(spark, folder):
    return aggregates.places_agg(tx(spark, folder))


@query()
def shipping_agg(spark, folder):
    return aggregates.shipping_agg(cleaning.with_delivery_overrun(tx(spark, folder)))


@query()
def geo_nodes(spark, folder):
    return aggregates.geo_nodes(tx(spark, folder))


@query()
def geo_summary(spark, folder):
    return aggregates.geo_summary(aggregates.geo_nodes(tx(spark, folder)))


@query()
def geo_markers(spark, folder):
    return aggregates.geo_markers(aggregates.geo_nodes(tx(spark, folder)))


@query()
def correlation_matrix(spark, folder):
    return kpis.correlation_matrix(tx(spark, folder, "discount_rate", "profit", "sales", "quantity", "profit_ratio"))


@query()
def discount_profit_correlation(spark, folder):
    return kpis.discount_profit_correlation(tx(spark, folder, "discount_rate", "profit"))


@query()
def profit_histogram(spark, folder):
    return pricing.histogram(stage(tx(spark, folder, "profit").select("profit"), "profit"), "profit", 60)


@query()
def loss_histogram(spark, folder):
    return pricing.histogram(stage(tx(spark, folder, "profit").select("profit").filter(F.col("profit") < 0), "losses"), "profit", 30)


@query()
def loss_order_share(spark, folder):
    return kpis.loss_order_share(tx(spark, folder, "profit"))


@query()
def margin_bridge(spark, folder):
    return kpis.margin_bridge(kpis.macro_kpis(tx(spark, folder)))


@query()
def filtered_kpis(spark, folder):
    return kpis.filtered_kpis(filters.cross_filter(tx(spark, folder), **SELECTION))


@query()
def filtered_discount_leak(spark, folder):
    items = tx(spark, folder)
    selection = kpis.filtered_kpis(filters.cross_filter(items, **SELECTION))
    return kpis.discount_leak(stage(kpis.macro_kpis(items), "macro_kpis"), selection)


@query()
def sample_scaled_kpis(spark, folder):
    items = tx(spark, folder).select(*sampling.ROW_IDENTITY, "profit", "customer_segment", "market")
    sample = stage(sampling.sample_rows(items, 15000), "ui_sample")
    full = stage(items.agg(F.count("*").alias("n")), "full_rows").scalar()
    return sampling.sample_scaled_kpis(sample, filters.cross_filter(sample, **SELECTION), full)


@query()
def cohort_retention(spark, folder):
    return kpis.cohort_retention(tx(spark, folder))


@query()
def rolling_trend(spark, folder):
    return kpis.rolling_trend(tx(spark, folder))


@query()
def running_best(spark, folder):
    months = kpis.monthly_totals(tx(spark, folder)).select("month", "monthly_revenue")
    return kpis.running_best(months, "month", "monthly_revenue")


# --- pricing ---------------------------------------------------------------------------


@query()
def discount_curve(spark, folder):
    return pricing.discount_curve(tx(spark, folder, "discount_rate", "profit", "sales"))


@query()
def discount_sensitivity(spark, folder):
    return pricing.discount_sensitivity(tx(spark, folder, "discount_rate", "profit_ratio", "sales"))


@query()
def discount_buckets(spark, folder):
    return pricing.discount_buckets(tx(spark, folder, "discount_rate", "profit"))


@query()
def revenue_at_risk(spark, folder):
    return pricing.revenue_at_risk(tx(spark, folder, "discount_rate", "profit", "sales"), CAP)


@query()
def revenue_at_risk_default_cap(spark, folder):
    return pricing.revenue_at_risk(tx(spark, folder, "discount_rate", "profit", "sales"))


@query()
def discount_whatif(spark, folder):
    return pricing.discount_whatif(tx(spark, folder, "discount_rate", "profit", "sales"), CAP)


@query()
def cap_sensitivity(spark, folder):
    return pricing.cap_sensitivity(tx(spark, folder, "discount_rate", "profit", "sales"), LOW_CAPS, CAP)


@query()
def cap_sensitivity_default_caps(spark, folder):
    return pricing.cap_sensitivity(tx(spark, folder, "discount_rate", "profit", "sales"))


# --- segments ----------------------------------------------------------------------------


@query()
def rfm_segments(spark, folder):
    return rfm(spark, folder)


@query()
def rfm_no_dates(spark, folder):
    base = segments.rfm_base(tx(spark, folder).drop("order_date"))
    return segments.rfm_segments(stage(base, "rfm_base"))


@query()
def rfm_distribution(spark, folder):
    return segments.value_counts(rfm(spark, folder), "rfm_segment")


@query()
def rfm_share(spark, folder):
    return segments.share_of_base(stage(rfm(spark, folder), "rfm"), "rfm_segment")


@query()
def customer_segmentation(spark, folder):
    return segments.customer_segmentation(customers(spark, folder)).select(
        "customer_id", "total_sales", "total_profit", "segment_class"
    )


@query()
def segment_distribution(spark, folder):
    return segments.value_counts(segments.customer_segmentation(customers(spark, folder)), "segment_class")


@query()
def n_bleeders(spark, folder):
    return segments.bleeder_count(segments.customer_segmentation(customers(spark, folder)))


@query()
def median_customer_sales(spark, folder):
    table = customers(spark, folder)
    medians = segments.quantiles(table, ["total_sales", "total_profit"], (0.5,))
    return table.agg(
        F.count("*").alias("customers"),
        F.lit(medians["total_sales"][0]).alias("median_sales"),
        F.lit(medians["total_profit"][0]).alias("median_profit"),
    )


@query()
def customer_tier(spark, folder):
    return segments.customer_tier(customers(spark, folder)).select(
        "customer_id", "total_sales", "order_count", "tier"
    )


@query()
def product_margin(spark, folder):
    return segments.product_margin(aggregates.product_agg(tx(spark, folder, "product_name", "sales", "profit", "quantity", "discount_rate"))).select(
        "product_name", "total_sales", "total_profit", "margin"
    )


@query()
def product_efficiency(spark, folder):
    return efficient_products(spark, folder)


@query()
def product_quadrants(spark, folder):
    return segments.product_quadrants(products(spark, folder)).select(
        "product_name", "units_sold", "margin", "quadrant"
    )


@query()
def pareto_curve(spark, folder):
    return segments.pareto_curve(customers(spark, folder))


@query()
def pareto_pct(spark, folder):
    return segments.pareto_pct(customers(spark, folder))


@query()
def abc_classification(spark, folder):
    return segments.abc_classification(products(spark, folder)).select(
        "product_name", "total_profit", "cumulative_profit_pct", "abc_class"
    )


@query()
def abc_summary(spark, folder):
    return segments.abc_summary(segments.abc_classification(products(spark, folder)))


@query()
def abc_top_products(spark, folder):
    return ranking.abc_top_products(segments.abc_classification(products(spark, folder)))


@query()
def abc_top20(spark, folder):
    classified = segments.abc_classification(products(spark, folder))
    return ranking.top(classified, "total_profit", "product_name", 20).select(
        "product_name", "total_profit", "abc_class"
    )


@query()
def insights(spark, folder):
    items = tx(spark, folder)
    settings = Thresholds(discount_cap=CAP)
    found = batch.insights(customers(spark, folder), stage(rfm(spark, folder), "rfm"), items, settings)
    # as text, which both engines compare
    text = F.transform(F.map_entries("rfm_distribution"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return found.withColumn("rfm_distribution", F.array_join(text, "; "))


@query()
def kpi_document(spark, folder):
    items = tx(spark, folder)
    row = batch.kpi_document(kpis.macro_kpis(items), stage(kpis.segment_elasticity(items), "segment_elasticity"))
    return row.select("n_orders", F.explode("segment_discount_elasticity").alias("customer_segment", "discount_profit_correlation"))


@query()
def region_margin_band(spark, folder):
    return segments.region_margin_band(aggregates.region_agg(tx(spark, folder))).select(
        "order_region", "profit_margin_pct", "band"
    )


@query()
def health_band(spark, folder):
    return segments.health_band(kpis.category_health(tx(spark, folder, "category_name", "sales", "profit", "profit_ratio"))).select(
        "category_name", "health_score", "band"
    )


@query()
def elasticity_band(spark, folder):
    return segments.elasticity_band(kpis.segment_elasticity(tx(spark, folder, "customer_segment", "discount_rate", "profit")))


# --- top lists ------------------------------------------------------------------------------


@query()
def top_customers_profit(spark, folder):
    table = aggregates.customer_agg(tx(spark, folder), usual=())
    return ranking.top(table, "total_profit", "customer_id", 10).select("customer_id", "total_sales", "total_profit")


@query()
def bottom_customers(spark, folder):
    table = aggregates.customer_agg(tx(spark, folder), usual=())
    return ranking.top(table, "total_profit", "customer_id", 5, lowest=True).select("customer_id", "total_profit")


@query()
def customer_summary(spark, folder):
    table = aggregates.customer_agg(tx(spark, folder))
    return ranking.top(table, "total_sales", "customer_id", 100)


@query()
def top_products_pei(spark, folder):
    selling = efficient_products(spark, folder).filter(F.col("total_sales") > 1000)
    return ranking.top(selling, "product_efficiency_index", "product_name", 10).select(
        "product_name", "total_sales", "product_efficiency_index"
    )


@query()
def top_categories(spark, folder):
    return ranking.top(aggregates.category_agg(tx(spark, folder, "category_name", "sales", "profit", "profit_ratio", "quantity")), "total_profit", "category_name", 15)


@query()
def loss_products(spark, folder):
    return ranking.loss_products(aggregates.product_agg(tx(spark, folder, "product_name", "sales", "profit", "quantity", "discount_rate"))).select("product_name", "total_profit")


@query()
def loss_products_total(spark, folder):
    return ranking.loss_products_total(aggregates.product_agg(tx(spark, folder, "product_name", "sales", "profit", "quantity", "discount_rate")))


@query()
def high_risk_orders(spark, folder):
    scored = rule_score(tx(spark, folder)).select("risk_score", *MONEY_KEYS[:-1], "profit")
    return ranking.high_risk_orders(scored, "risk_score", 0.7, [*MONEY_KEYS[:-1], "profit"])


@query()
def risk_histogram(spark, folder):
    return pricing.histogram(stage(rule_score(tx(spark, folder)).select("risk_score"), "risk"), "risk_score", 50)


@query()
def top_ltv_customers(spark, folder):
    table = customer_rule_score(aggregates.customer_agg(tx(spark, folder), usual=()))
    return ranking.top(table, "ltv_score", "customer_id", 10).select(
        "customer_id",
        ranking.dollars(F.col("total_sales")).alias("total_sales"),
        "order_count",
        ranking.percent_text(F.col("ltv_score") * 100, 1).alias("ltv_score"),
    )


@query()
def high_risk_revenue(spark, folder):
    table = customer_rule_score(aggregates.customer_agg(tx(spark, folder), usual=()))
    return ranking.high_risk_revenue(table, "ltv_score", "total_sales", 0.5)


@query()
def market_scorecard(spark, folder):
    return ranking.market_scorecard(aggregates.market_agg(tx(spark, folder)))


@query()
def markets_by_profit(spark, folder):
    return ranking.ranked(aggregates.market_agg(tx(spark, folder)), "total_profit", "market")


@query()
def region_ranking(spark, folder):
    return ranking.ranked(aggregates.region_agg(tx(spark, folder)), "profit_margin_pct", "order_region")


@query()
def health_ranking(spark, folder):
    return ranking.ranked(kpis.category_health(tx(spark, folder, "category_name", "sales", "profit", "profit_ratio")), "health_score", "category_name")


# --- features, metrics and models --------------------------------------------------------------


@query()
def delivery_risk_features(spark, folder):
    table = mlf.delivery_risk_features(tx(spark, folder)).complete().table
    return table.groupBy("shipping_mode", "market", "label").agg(
        F.count("*").alias("rows"),
        *[
            total(c).alias(c)
            for c in ("discount_rate", "quantity", "unit_price", "disc_x_qty", "price_x_qty", "log_price")
        ],
    )


@query()
def ltv_features(spark, folder):
    features = mlf.ltv_features(tx(spark, folder))
    return features.table.select("customer_id", "total_sales", *features.features, "label")


@query()
def margin_risk_features(spark, folder):
    table = mlf.margin_risk_features(tx(spark, folder)).complete().table
    return table.groupBy("shipping_mode", "market", "customer_segment", "category_name", "label").agg(
        F.count("*").alias("rows"),
        total("discount_rate").alias("discount_rate"),
        total("unit_price").alias("unit_price"),
    )


@query()
def churn_features(spark, folder):
    features = mlf.churn_features(kpis.customer_clv(tx(spark, folder))).complete()
    return features.table.select("customer_id", *features.features, "label")


ENCODED = ("shipping_mode", "market", "customer_segment", "category_name", "order_status", "department_name")


@query()
def label_encode(spark, folder):
    coded = mlf.label_encode(tx(spark, folder).select(*ENCODED), ENCODED)
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("value"), F.col(f"{c}_code").alias("code")) for c in ENCODED
    ])
    combinations = coded.groupBy(*coded.columns).agg(F.count("*").alias("n"))
    return combinations.select(F.inline(pairs), "n").groupBy("column", "value", "code").agg(F.sum("n").alias("rows"))


@query()
def stratified_split(spark, folder):
    return mlf.split_summary(_staged(mlf.margin_risk_features(tx(spark, folder)).complete(), "margin_features"), 0.25)


@query()
def stratified_folds(spark, folder):
    features = _staged(mlf.margin_risk_features(tx(spark, folder)).complete(), "margin_features")
    return mlf.with_fold(features, 5).groupBy("fold", "label").agg(F.count("*").alias("rows"))


@query()
def delivery_risk_codes(spark, folder):
    """The coded categories of the delivery model, with the numbers of rows."""
    features = mlf.delivery_risk_features(tx(spark, folder)).complete()
    codes = mlf.category_codes(features.table, features.categorical)
    coded = mlf.with_codes(features.table, codes, features.categorical)
    return coded.groupBy("label", *[f"{c}_code" for c in ("shipping_mode", "market", "customer_segment", "order_status")]).agg(
        F.count("*").alias("rows"), F.sum("category_name_code").alias("category_codes"), F.sum("department_name_code").alias("department_codes")
    )


def _late_score(spark, folder):
    return rule_score(tx(spark, folder)).select("risk_score", "late_delivery_risk", "discount_rate", "sales")


@query()
def roc_auc(spark, folder):
    return metrics.roc_auc(_late_score(spark, folder), "sales", "late_delivery_risk")


@query()
def brier_score(spark, folder):
    return metrics.brier_score(_late_score(spark, folder), "risk_score", "late_delivery_risk")


@query()
def model_gates(spark, folder):
    items = tx(spark, folder).select((F.col("profit") < 0).cast("int").alias("loss"), "unit_price")
    margin = metrics.roc_auc(items.withColumn("score", -F.col("unit_price")), "score", "loss")
    table = mlf.ltv_features(tx(spark, folder)).table
    ltv = metrics.roc_auc(table, "order_count", "label")
    both = margin.select(F.col("auc").alias("margin_auc"), stage(ltv, "ltv_auc").scalar().alias("ltv_auc"))
    return both.withColumns(metrics.model_gates(F.col("margin_auc"), F.col("ltv_auc")))


def _staged(features: mlf.FeatureSet, name: str) -> mlf.FeatureSet:
    return features.with_table(stage(features.table, name))


def _in_bounds(score: str) -> Column:
    return F.coalesce(F.col(score).between(0.0, 1.0), F.lit(False))


_margin_models: dict[tuple[str, str], tuple[models.TreeModel, mlf.FeatureSet, DataFrame]] = {}


def _margin_model(spark: SparkSession, folder: str) -> tuple[models.TreeModel, mlf.FeatureSet, DataFrame]:
    """The full margin model of a folder; the queries of one application share the fit."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _margin_models:
        _margin_models[key] = training.fit_margin_risk(tx(spark, folder))
    return _margin_models[key]


@query()
def margin_risk_scores(spark, folder):
    """The full model: how many items of either kind have a score, and whether flags and AUC are as they should be."""
    scored, described = training.margin_risk_scores(*_margin_model(spark, folder))
    auc = stage(described.select("holdout_auc"), "margin_auc").scalar()
    return scored.groupBy((F.col("profit") < 0).alias("is_loss")).agg(
        F.count("*").alias("rows"),
        total("sales").alias("sales_sum"),
        F.count_if(_in_bounds("margin_risk_probability")).alias("in_bounds"),
        F.count_if((F.col("margin_risk_probability") > 0.5) == (F.col("margin_risk_flag") == 1)).alias("flags_agree"),
    ).withColumn("auc_reaches_target", auc > metrics.MARGIN_AUC_TARGET)


@query()
def margin_importance(spark, folder):
    """The report row of the full margin model over all order items, with the gain of each feature, categories among them."""
    _, described = training.margin_risk_scores(*_margin_model(spark, folder))
    return described.select(
        "model",
        F.col("settings")["trees"].alias("trees"),
        F.col("settings")["depth"].alias("depth"),
        "holdout_auc",
        F.explode("feature_importance").alias("feature", "gain"),
    )


@query()
def margin_attributions(spark, folder):
    """How much each feature moves the margin of the full model, on average over all order items."""
    model, features, _ = _margin_model(spark, folder)
    return attribution.mean_attributions(attribution.explain(model, features.table, ["label"]), features)


@query()
def margin_attribution_sums(spark, folder):
    """For how many items of either kind the attributions and the base value add up to the margin."""
    model, features, _ = _margin_model(spark, folder)
    explained = attribution.explain(model, features.table, ["profit"])
    gap = F.abs(F.aggregate("attributions", F.col("base_value"), lambda total, a: total + a) - F.col("margin"))
    return explained.groupBy((F.col("profit") < 0).alias("is_loss")).agg(
        F.count("*").alias("rows"),
        F.count_if(gap <= 1e-9).alias("adding_up"),
        F.count_if(F.size("attributions") == len(features.features)).alias("with_all_features"),
    )


@query()
def churn_scores(spark, folder):
    """The full model over all customers; nobody is scored where too few order rarely."""
    clv = stage(kpis.customer_clv(tx(spark, folder)), "customer_clv")
    found = training.score_churn(clv)
    everyone = clv.select("customer_id", "total_revenue", "order_count", F.col("churn_risk").cast("int").alias("churn_risk"))
    if found is None:
        return everyone.withColumn("scored", F.lit(False))
    scores = found[0].select("customer_id", "churn_probability")
    return everyone.join(scores, "customer_id", "left").withColumn("scored", _in_bounds("churn_probability")).drop("churn_probability")


def _churn_model(spark: SparkSession, folder: str) -> tuple[models.TreeModel, mlf.FeatureSet, DataFrame]:
    """The full churn model, its features, and the rows held out."""
    features = _staged(mlf.churn_features(kpis.customer_clv(tx(spark, folder))).complete(), "churn_features")
    train, test = mlf.holdout_split(features, training.CHURN_TEST_SHARE)
    return models.fit_trees(features.with_table(train), models.CHURN_RISK), features, test


def _churn_features(spark: SparkSession, folder: str) -> mlf.FeatureSet | None:
    """All customers, or nothing where too few order rarely for a model."""
    features = _staged(mlf.churn_features(kpis.customer_clv(tx(spark, folder))).complete(), "churn_features")
    return features if mlf.enough_data(features, 50, training.MIN_CHURN_POSITIVES) else None


def _churn_model(features: mlf.FeatureSet) -> tuple[models.TreeModel, DataFrame]:
    """The full churn model, and the rows held out."""
    train, test = mlf.holdout_split(features, training.CHURN_TEST_SHARE)
    return models.fit_trees(features.with_table(train), models.CHURN_RISK), test


def _one_row(spark: SparkSession, **values: Column) -> DataFrame:
    return spark.range(1).select(*[value.alias(name) for name, value in values.items()])


@query()
def feature_importance(spark, folder):
    """Gains of the full churn model: the feature with the largest, how many are listed, and their sum; null without a model."""
    features = _churn_features(spark, folder)
    if features is None:
        return _one_row(spark, top_feature=F.lit(None).cast("string"), features=F.lit(0).cast("bigint"), gains=F.lit(0.0))
    gains = models.feature_importance(_churn_model(features)[0], features)
    return gains.agg(
        F.max_by("feature", "importance").alias("top_feature"), F.count_distinct("feature").alias("features"), total("importance").alias("gains")
    )


@query()
def permutation_importance(spark, folder):
    """Fifteen permutations of each feature of the full churn model, on the rows held out; null without a model."""
    features = _churn_features(spark, folder)
    if features is None:
        nothing = F.lit(0).cast("bigint")
        return _one_row(spark, top_feature=F.lit(None).cast("string"), features=nothing, in_bounds=nothing)
    model, test = _churn_model(features)
    found = importance.permutation_importance(model.score, features.with_table(test))
    return found.agg(
        F.max_by("feature", "importance").alias("top_feature"),
        F.count_distinct("feature").alias("features"),
        F.count_if(F.abs("importance") <= 1).alias("in_bounds"),
    )


@query()
def model_report(spark, folder):
    """The report of the full churn model: its settings, its features, and its AUC on the rows held out; no row without a model."""
    features = _churn_features(spark, folder)
    written = staged_path(spark, "model_report.json")
    described = spark.createDataFrame([], report.REPORT_SCHEMA)
    if features is not None:
        model, test = _churn_model(features)
        described = report.report_trees(model, test, features, models.CHURN_RISK, "customer_churn")
    tables.write_json(described, written)
    found = spark.read.schema(report.REPORT_SCHEMA).json(written)
    return found.select(
        "model",
        F.col("settings")["trees"].alias("trees"),
        F.col("settings")["depth"].alias("depth"),
        F.size("feature_importance").cast("bigint").alias("features"),
        F.round("holdout_auc", 1).alias("holdout_auc"),
    )


@query()
def cross_validated_auc(spark, folder):
    """The full churn settings on five stratified folds: mean AUC, and its deviation, to one decimal; null without a model."""
    features = _churn_features(spark, folder)
    if features is None:
        nothing = F.lit(None).cast("double")
        return _one_row(spark, cv_mean=nothing, cv_std=nothing)
    found = report.cross_validated_auc(features, models.CHURN_RISK)
    return found.select(F.round("cv_mean", 1).alias("cv_mean"), F.round("cv_std", 1).alias("cv_std"))


# Settings at the small end of what the searches draw from: no search ran for these rows.
DELIVERY_SETTINGS = models.TreeSettings(trees=tuning.DELIVERY_SPACE.trees[0], depth=tuning.DELIVERY_SPACE.depth[0], learning_rate=0.1, min_leaf_rows=5)
LTV_SETTINGS = models.TreeSettings(trees=tuning.LTV_SPACE.trees[0], depth=tuning.LTV_SPACE.depth[0], learning_rate=0.1, min_leaf_rows=5)


def _calibrated_summary(features: mlf.FeatureSet, settings: models.TreeSettings, single: str) -> DataFrame:
    """Calibrated scores of all rows by label, and whether they rank better than one feature does."""
    train, _ = mlf.holdout_split(features.complete(), 0.20)
    model = models.fit_calibrated(features.with_table(train), settings)
    scored = stage(model.score(features.table, "probability").select("probability", "label", single), "calibrated_scores")
    alone = stage(metrics.roc_auc(scored, single, "label"), "feature_auc").scalar()
    learnt = stage(metrics.roc_auc(scored, "probability", "label"), "model_auc").scalar()
    better = F.abs(learnt - 0.5) >= F.abs(alone - 0.5)
    return scored.groupBy("label").agg(F.count("*").alias("rows"), F.count_if(_in_bounds("probability")).alias("in_bounds")).withColumns(
        {"feature_auc": alone, "better_than_feature": better}
    )


@query()
def delivery_risk_scores(spark, folder):
    """Probabilities of late delivery for all order items, out-of-fold calibrated."""
    items = tx(spark, folder, *mlf.DELIVERY_NUMERIC, *mlf.DELIVERY_CATEGORICAL, *sampling.ROW_IDENTITY, "late_delivery_risk")
    return _calibrated_summary(_staged(mlf.delivery_risk_features(items), "delivery_features"), DELIVERY_SETTINGS, "discount_rate")


@query()
def ltv_scores(spark, folder):
    """Probabilities of high sales for all customers, out-of-fold calibrated."""
    return _calibrated_summary(_staged(mlf.ltv_features(tx(spark, folder)), "ltv_features"), LTV_SETTINGS, "order_count")


HPO_TRIALS, HPO_FOLDS = 12, 5


@query()
def hpo_pruning(spark, folder):
    """Which trial stops after which fold: trials weigh the discount against the price to tell losses, folds are orders by number."""
    items = tx(spark, folder, "order_id", "discount_rate", "unit_price", "profit").select(
        F.pmod("order_id", F.lit(HPO_FOLDS)).cast("int").alias("fold"), "discount_rate", "unit_price", (F.col("profit") < 0).cast("int").alias("label")
    )
    # items that no trial tells apart are counted once, before each is dealt to the trials
    counted = stage(items.groupBy(*items.columns).agg(F.count("*").alias("rows")), "counted_items")
    trials = F.explode(F.sequence(F.lit(0), F.lit(HPO_TRIALS - 1)))
    scored = counted.select(trials.alias("trial"), *counted.columns)
    score = F.pmod(F.col("trial") * 5, F.lit(HPO_TRIALS)) * 1000 * F.col("discount_rate") - F.col("unit_price")
    aucs = stage(metrics.roc_auc(scored.withColumn("score", score), "score", "label", group=("trial", "fold"), rows="rows", cheap=True), "fold_aucs")
    outcome = tuning.StoppingRule().outcome(aucs, HPO_FOLDS)
    return outcome.select("trial", F.col("stopped_after").isNotNull().alias("stopped"), "folds_run", "mean_auc")


@query()
def calibrated_model_scores(spark, folder):
    """Out-of-fold calibrated scores of the full churn settings for every customer."""
    features = _staged(mlf.churn_features(kpis.customer_clv(tx(spark, folder))), "churn_features")
    scored = models.fit_calibrated(features, models.CHURN_RISK).score(features.table, "probability")
    return scored.select("customer_id", "churn_risk", _in_bounds("probability").alias("scored"))


@query()
def calibrated_scores(spark, folder):
    """A rule score calibrated to loss frequencies, with the rows of each score."""
    rows = tx(spark, folder).select(
        (F.lit(1.0) / (F.lit(1.0) + F.round(F.col("unit_price") / 50))).alias("score"),
        (F.col("profit") < 0).cast("int").alias("label"),
    )
    rows = stage(rows, "rule_scores")
    calibration = models.fit_calibration(rows, "score", "label")
    calibration.setFeaturesCol("score")
    calibration.setPredictionCol("probability")
    counted = rows.groupBy("score").agg(F.count("*").alias("rows"), F.sum("label").alias("losses"))
    return calibration.transform(counted)


# --- tables that are kept ----------------------------------------------------------

SELECTION = {"customer_segment": ["BUILDING", "MACHINERY"], "market": ["ASIA", "EUROPE"]}


@query()
def routed_kpis(spark, folder):
    """The headline numbers of every subset of three filters, from a cube that was written."""
    items = tx(spark, folder, *cube.MEASURES, *cube.KEYS.values(), *filters.FILTER_DIMENSIONS)
    path = staged_path(spark, "cube")
    cube.write_cube(cube.build_cube(items), path)
    kept = cube.read_cube(spark, path)
    return _every_selection(kept)


def _every_selection(kept: cube.Cube) -> DataFrame:
    # as many categories as begin with a letter that some share
    categories = kept.sums.filter(F.col("level") == kept.level(["category_name"])).filter("category_name < 'M'")
    names = [r["category_name"] for r in categories.select("category_name").orderBy("category_name").collect()]
    wanted = {**SELECTION, "category_name": names}
    rows = None
    for chosen in range(1 << len(wanted)):
        own = {d: values for i, (d, values) in enumerate(sorted(wanted.items())) if chosen >> i & 1}
        row = cube.routed_kpis(kept, **own).withColumn("filters", F.lit("+".join(own)))
        rows = row if rows is None else rows.unionByName(row)
    return rows


@query()
def refreshed_totals(spark, folder):
    """Result tables merged from partial totals, after three loads in odd order, one of them twice."""
    columns = {k for keys in refresh.PARTIAL_KEYS.values() for k in keys} | {m for ms in refresh.MEASURES.values() for m in ms}
    items = tx(spark, folder, "order_date", "ship_date", "scheduled_days", *sorted(columns - {"delivery_overrun_days"}))
    loads, path = staged_path(spark, "loads"), staged_path(spark, "refresh")
    dealt = items.withColumn("part", F.pmod(F.month("order_date"), F.lit(3)))
    dealt.write.partitionBy("part").parquet(loads)
    arrived = spark.read.schema(dealt.schema).parquet(loads)
    for number in (2, 0, 2, 1):
        refresh.load(arrived.filter(F.col("part") == number).drop("part"), path, unit="month", kept=True)
    found = {
        "monthly": refresh.monthly_trend(spark, path).select(
            F.col("month").alias("key"), F.col("monthly_revenue").alias("total_sales"), F.col("monthly_profit").alias("total_profit"),
            F.col("mom_revenue_growth_pct").alias("detail"),
        ),
        "category": refresh.category_agg(spark, path).select(F.col("category_name").alias("key"), "total_sales", "total_profit", F.col("revenue_share").alias("detail")),
        "product": refresh.product_agg(spark, path).select(F.col("product_name").alias("key"), "total_sales", "total_profit", F.col("profit_per_unit").alias("detail")),
        "shipping": refresh.shipping_agg(spark, path).select(F.col("shipping_mode").alias("key"), "total_sales", "total_profit", F.col("avg_overrun_days").alias("detail")),
    }
    for name, key in (("market", "market"), ("region", "order_region")):
        found[name] = refresh.place_agg(spark, path, key).select(F.col(key).alias("key"), "total_sales", "total_profit", F.col("profit_margin_pct").alias("detail"))
    rows = None
    for name, table in found.items():
        named = table.withColumn("result", F.lit(name))
        rows = named if rows is None else rows.unionByName(named)
    return rows


@query()
def clustered_selection(spark, folder):
    """A selection from order items written in a folder per market, in the order of segment and category."""
    path = tables.write_clustered(
        tx(spark, folder), staged_path(spark, "clustered"), "transactions", ["market"], ["customer_segment", "category_name"], files=4
    )
    return row_summary(filters.cross_filter(spark.read.parquet(path), **SELECTION))


@query()
def bucketed_customer_join(spark, folder):
    """Customer totals, lifetime value and segment from three tables bucketed by customer."""
    return _bucketed_customers(spark, folder)


def _bucketed_customers(spark: SparkSession, folder: str, buckets: int = 8) -> DataFrame:
    items = stage(tx(spark, folder, "customer_id", "order_id", "sales", "profit", "discount_rate", "profit_ratio", "order_date"), "items")
    made = {
        "totals": aggregates.customer_agg(items, usual=()).select("customer_id", "total_sales", "order_count"),
        "value": kpis.customer_clv(items).select("customer_id", "clv_score", "churn_risk"),
        "segments": segments.rfm_segments(stage(segments.rfm_base(items), "rfm_base")).select("customer_id", "rfm_segment"),
    }
    path = staged_path(spark, "bucketed")
    number = path.split("/")[-2]  # a name that no other table has
    kept = {name: tables.write_bucketed(df, f"{path}/{name}", f"bucketed_{name}_{number}", "customer_id", buckets) for name, df in made.items()}
    return kept["totals"].join(kept["value"].hint("merge"), "customer_id").join(kept["segments"].hint("merge"), "customer_id")
