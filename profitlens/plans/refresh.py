"""Result tables that follow new loads without a rebuild.

A load brings whole days of order items. It replaces the partial totals of its
days and nothing else, so loads may come in any order and any of them twice.
Results are merged from the partials: the order items of earlier loads are not
read again. Sums are kept as whole numbers, so the results equal those of a
full rebuild to the last bit.

``unit`` is the width of a partition, ``day`` or ``month``; a load then has to
bring whole units. A load without rows of a day leaves that day as it is.
Rows without an order date are in the partition of the missing day.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from profitlens.functions.arithmetic import merged_count, merged_mean, merged_total, partial_sums, percent, ratio, ratio_or_zero, total
from profitlens.operators.cleaning import with_delivery_overrun
from profitlens.operators.kpis import growth
from profitlens.session import stage

UNITS = {"day": 10, "month": 7}  # characters of a yyyy-MM-dd date

#: Keys of each partial table; results with other keys are merged from the one that holds them.
PARTIAL_KEYS = {
    "places": ("market", "order_region", "order_country", "shipping_mode", "category_name"),
    "products": ("product_name",),
}
#: Measures that are summed, per partial table.
MEASURES = {
    "places": ("sales", "profit", "profit_ratio", "quantity", "delivery_overrun_days"),
    "products": ("sales", "profit", "quantity", "discount_rate"),
}
#: Partial tables whose keys have nearly as many values in a unit as there are rows.
MANY_KEYS = ("products",)
ROWS_A_TASK = 1 << 17
MISSING_DAY = "none"


def partial_totals(tx: DataFrame, table: str, unit: str = "day") -> DataFrame:
    """(unit, keys, partial sums) of the order items."""
    return _summed(_in_units(tx, unit), table)


def _in_units(tx: DataFrame, unit: str) -> DataFrame:
    day = F.col("order_date").cast("date").cast("string")
    return with_delivery_overrun(tx).withColumn("unit", F.coalesce(F.substring(day, 1, UNITS[unit]), F.lit(MISSING_DAY)))


def _present(rows: DataFrame, names: Sequence[str]) -> list[str]:
    return [c for c in names if c in rows.columns]


def _summed(rows: DataFrame, table: str, *further: str) -> DataFrame:
    sums = [p for m in _present(rows, MEASURES[table]) for p in partial_sums(m, m)]
    return rows.groupBy("unit", *further, *_present(rows, PARTIAL_KEYS[table])).agg(*sums)


def _dealt(rows: DataFrame, table: str) -> DataFrame:
    """Partial totals by one shuffle, of the narrow rows; a task has few units, and a large unit several tasks.

    Where few rows share their keys, sums made before a shuffle are nearly as
    many as the rows and several times as wide.
    """
    keys = _present(rows, PARTIAL_KEYS[table])
    sizes = stage(rows.groupBy("unit").agg(F.count("*").alias("unit_rows")), "unit_rows")
    tasks = ceil((sizes.agg(F.sum("unit_rows")).first()[0] or 1) / ROWS_A_TASK)
    piece = F.pmod(F.xxhash64(*keys), F.ceil(F.col("unit_rows") / ROWS_A_TASK)).alias("piece")
    needed = rows.join(sizes, "unit").select("unit", piece, *keys, *_present(rows, MEASURES[table]))
    return _summed(needed.repartition(tasks, "unit", "piece"), table, "piece").drop("piece")


def load(tx: DataFrame, folder: str, unit: str = "day", kept: bool = False) -> None:
    """Replace the partial totals of the units that the load holds.

    The rows are read once or twice per partial table. They are staged for that,
    unless they are ``kept`` in files as they are and cost no more than a read.
    """
    rows = _in_units(tx if kept else stage(tx, "load"), unit)
    for table, keys in PARTIAL_KEYS.items():
        if table in MANY_KEYS and _present(rows, keys):
            totals = _dealt(rows, table)
        else:
            # small units share a task, a large one is cut
            totals = _summed(rows, table).hint("rebalance", F.col("unit"))
        totals.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("unit").parquet(_path(folder, table))


def _path(folder: str, table: str) -> str:
    return f"{folder.rstrip('/')}/partials_{table}.parquet"


def _partials(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.option("basePath", _path(folder, table)).parquet(_path(folder, table)).withColumn("unit", F.col("unit").cast("string"))


def _of(partials: DataFrame, key: str | Column, name: str) -> DataFrame:
    """Totals per value of the key, with the columns that the one-pass operators return."""
    has = {m for m in ("sales", "profit", "profit_ratio", "quantity", "discount_rate", "delivery_overrun_days") if f"{m}_n" in partials.columns}
    found = {"total_sales": merged_total("sales"), "total_profit": merged_total("profit"), "order_count": merged_count("sales")}
    extra = {
        "avg_profit_ratio": ("profit_ratio", merged_mean), "units_sold": ("quantity", merged_total),
        "avg_discount": ("discount_rate", merged_mean), "avg_overrun_days": ("delivery_overrun_days", merged_mean),
    }
    found |= {column: made(m) for column, (m, made) in extra.items() if m in has}
    shown = partials.withColumn(name, F.col(key) if isinstance(key, str) else key).filter(F.col(name).isNotNull())
    return shown.groupBy(name).agg(*[value.alias(column) for column, value in found.items()])


def _margin(totals: DataFrame) -> DataFrame:
    return totals.withColumn("profit_margin_pct", percent(F.col("total_profit"), F.col("total_sales")))


def monthly_trend(spark: SparkSession, folder: str) -> DataFrame:
    month = F.when(F.col("unit") != MISSING_DAY, F.substring("unit", 1, 7))  # a unit begins with its month
    totals = _of(_partials(spark, folder, "places"), month, "month")
    named = totals.select(
        "month", F.col("total_sales").alias("monthly_revenue"), F.col("total_profit").alias("monthly_profit"), "order_count"
    )
    return growth(named)


def category_agg(spark: SparkSession, folder: str) -> DataFrame:
    totals = stage(_of(_partials(spark, folder, "places"), "category_name", "category_name"), "category_totals")
    share = ratio(F.col("total_sales"), totals.agg(total("total_sales")).scalar())
    columns = ["category_name", "total_sales", "total_profit", "avg_profit_ratio", "units_sold"]
    return totals.select(*columns, share.alias("revenue_share")).withColumn("hhi_contribution", F.col("revenue_share") * F.col("revenue_share"))


def product_agg(spark: SparkSession, folder: str) -> DataFrame:
    # a product has a row per unit at most: nothing to add up before the shuffle
    partials = _partials(spark, folder, "products").repartition("product_name")
    totals = _of(partials, "product_name", "product_name").drop("order_count")
    columns = ["product_name", "total_sales", "total_profit", "units_sold", "avg_discount"]
    return totals.select(*columns, ratio_or_zero(F.col("total_profit"), F.col("units_sold")).alias("profit_per_unit"))


def place_agg(spark: SparkSession, folder: str, key: str) -> DataFrame:
    """Per market, region or country."""
    return _margin(_of(_partials(spark, folder, "places"), key, key).select(key, "total_sales", "total_profit", "order_count"))


def shipping_agg(spark: SparkSession, folder: str) -> DataFrame:
    totals = _of(_partials(spark, folder, "places"), "shipping_mode", "shipping_mode")
    columns = ["shipping_mode", "total_sales", "total_profit", "order_count", *[c for c in ("avg_overrun_days",) if c in totals.columns]]
    return _margin(totals.select(*columns))
