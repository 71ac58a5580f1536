"""The whole batch: clean once, then write every result table from the clean one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profitlens.config import DEFAULTS, Thresholds
from profitlens.operators import aggregates, cleaning, kpis, pricing, sampling, segments
from profitlens.session import stage, staging
from profitlens.sources.tables import write_json, write_table


def as_map(df: DataFrame, key: str, value: str) -> DataFrame:
    """One row with one map, sorted by key; for tables with a row per label."""
    entries = F.array_sort(F.collect_list(F.struct(key, value)))
    return df.filter(F.col(value).isNotNull()).agg(F.map_from_entries(entries).alias("entries"))


def kpi_document(kpis_row: DataFrame, elasticity: DataFrame) -> DataFrame:
    """The KPI row with the discount elasticity of each segment nested in it."""
    nested = as_map(elasticity, "customer_segment", "discount_profit_correlation")
    return kpis_row.withColumn("segment_discount_elasticity", nested.scalar())


def insights(customers: DataFrame, rfm: DataFrame, tx: DataFrame, settings: Thresholds = DEFAULTS) -> DataFrame:
    """The headline findings in one row, each a scalar of its own staged table."""
    segmented = stage(
        segments.customer_segmentation(customers, settings.bleeder_quantile).select("segment_class"), "segment_classes"
    )
    pareto = stage(segments.pareto_pct(customers, settings.pareto_target), "pareto")
    distribution = as_map(segments.value_counts(rfm, "rfm_segment"), "rfm_segment", "customers")
    return (
        tx.agg(
            F.round(pricing.beyond_cap(settings.discount_cap), 2).alias("revenue_at_risk"),
            F.round(kpis.pearson("discount_rate", "profit"), 4).alias("discount_profit_correlation"),
        )
        .withColumn("pareto_pct", pareto.select("pareto_pct").scalar())
        .withColumn("n_bleeders", segments.bleeder_count(segmented).scalar())
        .withColumn("rfm_distribution", distribution.scalar())
    )


def result_tables(tx: DataFrame, settings: Thresholds = DEFAULTS) -> dict[str, DataFrame]:
    """Every result table by name, from a clean order-item table.

    The per-customer and per-product tables are staged: several results are
    built on each, and they are much smaller than the order items.
    """
    rows = cleaning.with_delivery_overrun(cleaning.with_margin_band(tx))
    customers = stage(aggregates.customer_agg(tx), "customer_agg")
    products = stage(aggregates.product_agg(tx), "product_agg")
    rfm = stage(segments.rfm_segments(stage(segments.rfm_base(tx), "rfm_base")), "rfm_segments")
    tables = {
        "customer_agg": customers,
        "customer_clv": kpis.customer_clv(tx, settings.churn_max_orders),
        "rfm_segments": rfm,
        "segmented_customers": segments.customer_segmentation(customers, settings.bleeder_quantile),
        "pareto_curve": segments.pareto_curve(customers),
        "product_agg": products,
        "product_agg_advanced": segments.product_efficiency(products),
        "abc_classification": segments.abc_classification(products, settings.abc_a_share, settings.abc_b_share),
        "macro_kpis": kpis.macro_kpis(tx),
        "insights": insights(customers, rfm, tx, settings),
        "discount_curve": pricing.discount_curve(tx),
        "correlation_matrix": kpis.correlation_matrix(tx),
        "ui_sample": sampling.ui_sample(rows, settings.sample_rows, settings.seed),
    }
    if "order_date" in tx.columns:
        tables["monthly_trend"] = kpis.monthly_trend(tx)
    if "category_name" in tx.columns:
        tables["category_agg"] = aggregates.category_agg(tx)
        tables["category_health"] = kpis.category_health(tx)
    if "customer_segment" in tx.columns:
        tables["segment_elasticity"] = kpis.segment_elasticity(tx)
    keys = {"market_agg": "market", "region_agg": "order_region"}
    keys = {name: key for name, key in keys.items() if key in tx.columns}
    if keys:
        places = stage(aggregates.places_agg(tx, tuple(keys.values())), "places")
        for name, key in keys.items():
            tables[name] = places.filter(F.col("dimension") == key).withColumnRenamed("value", key).drop("dimension")
    if "shipping_mode" in tx.columns:
        tables["shipping_agg"] = aggregates.shipping_agg(rows)
    if {"latitude", "longitude"} <= set(tx.columns):
        tables["spatial_nodes_agg"] = aggregates.geo_nodes(tx)
    return tables


def run_batch(raw: DataFrame, folder: str, settings: Thresholds = DEFAULTS, narrow: bool = False) -> list[str]:
    """Clean ``raw`` and write the report, the transactions and all result tables below ``folder``."""
    spark = raw.sparkSession
    with staging(spark):
        rows, report = cleaning.clean_with_report(raw, settings)
        write_json(report, f"{folder}/cleaning_report.json")
        paths = [write_table(rows, folder, "transactions")]
        tx = spark.read.parquet(paths[0])
        tables = result_tables(tx, settings)
        for name, table in tables.items():
            paths.append(write_table(table, folder, name, narrow))
        written = {name: spark.read.parquet(path) for name, path in zip(["transactions", *tables], paths, strict=True)}
        document = written["macro_kpis"]
        if "segment_elasticity" in written:
            document = kpi_document(document, written["segment_elasticity"])
        write_json(document, f"{folder}/macro_kpis.json")
        write_json(written["insights"], f"{folder}/insights.json")
    return paths
