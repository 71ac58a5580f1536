"""Rounding for the comparison of queries with their SQL.

Operators and SQL state plain sums, means and ratios. Two engines add doubles
in different orders, so what is compared is rounded, on both sides alike:
amounts at four decimals, everything else at eight. Values are shifted by an
eighth of the last place or so before: quotients of amounts often lie half-way
between two decimals, where the last bit would decide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AMOUNTS = set(
    (
        "amount average_category_margin_pct average_order_value avg_profit benefit_per_order "
        "benefit_per_order_total best_so_far bin_high bin_low clv_score color_range cumulative_profit "
        "current_profit customer_value_index disc_x_qty discount_leak discount_sum estimated_profit estimated_recovery estimated_revenue "
        "log_price longitude median_profit median_sales mom_profit_growth_pct monetary monthly_profit "
        "monthly_revenue price_x_qty profit profit_density profit_per_unit profit_sum quantity recovered "
        "revenue revenue_at_risk rolling_profit rolling_revenue sales sales_sum simulated_profit "
        "revenue_error profit_error total_loss total_profit total_revenue total_sales unit_price units_sold"
    ).split()
)

#: The double columns of each compared query.
DOUBLES = {
    "ui_sample": "discount_rate profit sales profit_ratio quantity",
    "sample_scaled_kpis": "estimated_revenue estimated_profit margin_pct revenue_error profit_error",
    "stratified_split": "positive_share",
    "kpi_document": "discount_profit_correlation",
    "margin_risk_scores": "sales_sum",
    "churn_scores": "total_revenue",
    "feature_importance": "gains",
    "hpo_pruning": "mean_auc",
    "csv_encodings": "total_sales",
    "delivery_risk_scores": "feature_auc",
    "ltv_scores": "feature_auc",
    "routed_kpis": "revenue profit margin_pct average_order_value",
    "refreshed_totals": "total_sales total_profit detail",
    "clustered_selection": "sales_sum profit_sum discount_sum",
    "bucketed_customer_join": "total_sales clv_score",
    "calibrated_scores": "score probability",
    "csv_scan": "quantity sales profit discount_rate",
    "normalise_columns": "benefit_per_order profit",
    "typed_transactions": "quantity sales late_delivery_risk",
    "parquet_roundtrip": "total_sales total_profit profit_margin_pct",
    "narrow_floats": "sales profit",
    "view_catalog": "total_sales",
    "sql_query": "total_sales",
    "preview": "sales discount_rate profit",
    "dedup_rows": "sales_sum profit_sum discount_sum",
    "drop_missing": "sales_sum profit_sum discount_sum",
    "financial_filter": "sales_sum profit_sum discount_sum",
    "outliers_zscore": "sales_sum profit_sum discount_sum",
    "outliers_iqr_default": "sales_sum profit_sum discount_sum",
    "outliers_iqr": "sales_sum profit_sum discount_sum",
    "outliers_adaptive": "sales_sum profit_sum discount_sum",
    "outliers_adaptive_iqr": "sales_sum profit_sum discount_sum",
    "clean_transactions": "sales_sum profit_sum discount_sum",
    "cross_filter": "sales_sum profit_sum discount_sum",
    "policy_breach_orders": "profit",
    "policy_breach_rows": "sales profit discount_rate",
    "nonnegative_sales": "sales_sum profit_sum discount_sum",
    "transactions_join": "sales profit",
    "customer_with_segment": "total_sales total_profit avg_discount avg_profit_ratio customer_value_index",
    "score_lookup_join": "total_sales ltv_score",
    "macro_kpis":
        "total_revenue total_profit profit_margin_pct margin_zero_discount_pct discount_impact_ratio_pct "
        "average_category_margin_pct average_order_value benefit_per_order_total benefit_vs_profit_delta",
    "monthly_trend": "monthly_revenue monthly_profit mom_revenue_growth_pct mom_profit_growth_pct",
    "customer_clv": "total_revenue total_profit avg_discount clv_score",
    "category_health": "total_revenue total_profit avg_profit_ratio health_score",
    "segment_elasticity": "discount_profit_correlation",
    "customer_agg": "total_sales total_profit avg_discount avg_profit_ratio customer_value_index",
    "category_agg": "total_sales total_profit avg_profit_ratio units_sold revenue_share hhi_contribution",
    "product_agg": "total_sales total_profit units_sold avg_discount profit_per_unit",
    "market_agg": "total_sales total_profit profit_margin_pct",
    "region_agg": "total_sales total_profit profit_margin_pct",
    "country_agg": "total_sales total_profit profit_margin_pct",
    "places_agg": "total_sales total_profit profit_margin_pct",
    "shipping_agg": "total_sales total_profit avg_overrun_days profit_margin_pct",
    "geo_nodes": "latitude longitude total_profit total_sales",
    "geo_summary": "color_range center_latitude center_longitude",
    "geo_markers": "latitude longitude total_profit total_sales radius",
    "correlation_matrix": "correlation",
    "discount_profit_correlation": "discount_profit_correlation",
    "profit_histogram": "bin_low bin_high",
    "loss_histogram": "bin_low bin_high",
    "loss_order_share": "loss_share_pct",
    "margin_bridge": "amount",
    "filtered_kpis": "revenue profit margin_pct average_order_value",
    "filtered_discount_leak": "revenue profit margin_pct average_order_value discount_leak",
    "cohort_retention": "retention",
    "rolling_trend": "monthly_revenue monthly_profit rolling_revenue rolling_profit",
    "running_best": "monthly_revenue best_so_far",
    "discount_curve": "bracket_low bracket_high avg_profit",
    "discount_sensitivity": "discount_bracket avg_margin total_revenue",
    "discount_buckets": "total_profit avg_profit",
    "revenue_at_risk": "revenue_at_risk",
    "revenue_at_risk_default_cap": "revenue_at_risk",
    "discount_whatif": "current_profit breach_pct recovered simulated_profit recovery_rate_pct",
    "cap_sensitivity": "cap affected_pct estimated_recovery",
    "cap_sensitivity_default_caps": "cap affected_pct estimated_recovery",
    "rfm_segments": "monetary",
    "rfm_no_dates": "monetary",
    "rfm_share": "share_pct",
    "customer_segmentation": "total_sales total_profit",
    "median_customer_sales": "median_sales median_profit",
    "customer_tier": "total_sales",
    "product_margin": "total_sales total_profit margin",
    "product_efficiency":
        "total_sales total_profit units_sold avg_discount profit_per_unit margin profit_density "
        "volume_contribution product_efficiency_index",
    "product_quadrants": "units_sold margin",
    "pareto_curve": "total_profit cumulative_profit cumulative_pct",
    "pareto_pct": "pareto_pct",
    "abc_classification": "total_profit cumulative_profit_pct",
    "abc_summary": "total_profit",
    "abc_top_products": "total_profit",
    "abc_top20": "total_profit",
    "insights": "revenue_at_risk discount_profit_correlation pareto_pct",
    "region_margin_band": "profit_margin_pct",
    "health_band": "health_score",
    "elasticity_band": "discount_profit_correlation",
    "top_customers_profit": "total_sales total_profit",
    "bottom_customers": "total_profit",
    "customer_summary": "total_sales total_profit avg_discount avg_profit_ratio customer_value_index",
    "top_products_pei": "total_sales product_efficiency_index",
    "top_categories": "total_sales total_profit avg_profit_ratio units_sold revenue_share hhi_contribution",
    "loss_products": "total_profit",
    "loss_products_total": "total_loss",
    "high_risk_orders": "risk_score sales discount_rate profit",
    "risk_histogram": "bin_low bin_high",
    "high_risk_revenue": "revenue_at_risk",
    "market_scorecard": "total_sales total_profit profit_margin_pct",
    "markets_by_profit": "total_sales total_profit profit_margin_pct",
    "region_ranking": "total_sales total_profit profit_margin_pct",
    "health_ranking": "total_revenue total_profit avg_profit_ratio health_score",
    "delivery_risk_features": "discount_rate quantity unit_price disc_x_qty price_x_qty log_price",
    "ltv_features": "total_sales avg_discount order_count",
    "margin_risk_features": "discount_rate unit_price",
    "churn_features": "total_revenue total_profit order_count avg_discount clv_score",
    "roc_auc": "auc",
    "brier_score": "brier",
    "model_gates": "margin_auc ltv_auc",
}


def digits(column: str) -> int:
    return 4 if column in AMOUNTS else 8


def shift(column: str) -> float:
    return 0.1234567 * 10.0 ** -digits(column)


def rounded(df: DataFrame, query: str) -> DataFrame:
    columns = DOUBLES.get(query, "").split()
    # adding zero takes the sign from a negative zero
    return df.withColumns({c: F.round(F.col(c) + F.lit(shift(c)), digits(c)) + F.lit(0.0) for c in columns}) if columns else df


def rounded_sql(text: str, query: str) -> str:
    columns = DOUBLES.get(query, "").split()
    if not columns:
        return text
    shown = ", ".join(f"round({c} + {shift(c)!r}::double, {digits(c)}) + 0::double AS {c}" for c in columns)
    return f"SELECT * REPLACE ({shown}) FROM (\n{text}\n)"
