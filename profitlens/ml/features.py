"""Feature tables for the risk models.

A feature table keeps all columns and rows of its source. Models learn from the
rows that are ``complete`` and score every row: a missing number counts as 0
there, a missing text as a category of its own.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from profitlens.config import DEFAULTS
from profitlens.functions.arithmetic import finite, zero_if_not_finite
from profitlens.functions.ordered import at_ranks, quantiles
from profitlens.operators.aggregates import customer_agg
from profitlens.operators.sampling import ROW_IDENTITY, row_share
from profitlens.session import stage

MISSING_TEXT = "nan"  # Fixed value: the category of a missing value.


@dataclass(frozen=True)
class FeatureSet:
    """A table with the names of its feature columns."""

    table: DataFrame
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    label: str
    identity: tuple[str, ...]

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric + self.categorical

    def with_table(self, table: DataFrame) -> FeatureSet:
        return FeatureSet(table, self.numeric, self.categorical, self.label, self.identity)

    def complete(self) -> FeatureSet:
        """Only the rows whose features and label are all there."""
        known = F.col(self.label).isNotNull()
        for c in self.numeric:
            known = known & finite(F.col(c).cast("double")).isNotNull()
        for c in self.categorical:
            known = known & F.col(c).isNotNull()
        return self.with_table(self.table.filter(known))


def as_category(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(MISSING_TEXT))


def _present(df: DataFrame, columns: tuple[str, ...]) -> tuple[str, ...]:
    return tuple(c for c in columns if c in df.columns)


# The features of each model.
DELIVERY_NUMERIC = ("discount_rate", "quantity", "unit_price", "sales")
DELIVERY_CATEGORICAL = ("shipping_mode", "market", "customer_segment", "category_name", "order_status", "department_name")
MARGIN_NUMERIC = ("discount_rate", "quantity", "unit_price")
MARGIN_CATEGORICAL = ("shipping_mode", "market", "customer_segment", "category_name")
LTV_NUMERIC = ("avg_discount", "order_count")
LTV_CATEGORICAL = ("customer_segment", "market", "order_region")
CHURN_NUMERIC = ("total_revenue", "total_profit", "order_count", "avg_discount", "clv_score")


def delivery_risk_features(tx: DataFrame) -> FeatureSet:
    """Order items with prices, interactions and categories; the label is a late delivery."""
    if "late_delivery_risk" not in tx.columns:
        raise ValueError("late_delivery_risk is missing")
    numeric = _present(tx, DELIVERY_NUMERIC)
    derived = {}
    if {"discount_rate", "quantity"} <= set(numeric):
        derived["disc_x_qty"] = F.col("discount_rate") * F.col("quantity")
    if {"unit_price", "quantity"} <= set(numeric):
        derived["price_x_qty"] = F.col("unit_price") * F.col("quantity")
    if "unit_price" in numeric:
        derived["log_price"] = F.log1p("unit_price")
    categories = {c: as_category(c) for c in _present(tx, DELIVERY_CATEGORICAL)}
    table = tx.withColumns({**derived, **categories, "label": F.col("late_delivery_risk").cast("int")})
    return FeatureSet(table, (*numeric, *derived), tuple(categories), "label", _present(tx, ROW_IDENTITY))


def margin_risk_features(tx: DataFrame) -> FeatureSet:
    """Order items with seven columns known before the sale; the label is a loss."""
    numeric, categorical = _present(tx, MARGIN_NUMERIC), _present(tx, MARGIN_CATEGORICAL)
    table = tx.withColumn("label", (F.col("profit") < 0).cast("int"))
    return FeatureSet(table, numeric, categorical, "label", _present(tx, ROW_IDENTITY))


def ltv_features(tx: DataFrame, quantile: float = 0.75) -> FeatureSet:
    """Customers with habits and usual place; the label is high sales, which is no feature itself."""
    base = stage(customer_agg(tx, usual=LTV_CATEGORICAL), "ltv_base")
    high = F.lit(quantiles(base, ["total_sales"], (quantile,))["total_sales"][0])
    categorical = _present(base, LTV_CATEGORICAL)
    table = base.withColumns({
        **{c: zero_if_not_finite(F.col(c).cast("double")) for c in LTV_NUMERIC},
        **{c: as_category(c) for c in categorical},
        "label": (F.col("total_sales") >= high).cast("int"),
    })
    return FeatureSet(table, LTV_NUMERIC, categorical, "label", ("customer_id",))


def churn_features(clv: DataFrame) -> FeatureSet:
    """Customers with their lifetime value; the label is having ordered rarely."""
    numeric = _present(clv, CHURN_NUMERIC)
    table = clv.withColumns({
        **{c: F.col(c).cast("double") for c in numeric}, "label": F.col("churn_risk").cast("int"),
    })
    return FeatureSet(table, numeric, (), "label", ("customer_id",))


def category_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, code): the alphabetical number of each text, counted without bringing the texts together.

    Distinct texts are dealt out in ranges; a text's code is its number within
    its range plus all texts in the ranges before.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), as_category(c).alias("value")) for c in columns])
    distinct = df.select(F.inline(pairs)).distinct().repartitionByRange("column", "value")
    ranged = stage(distinct.withColumn("range", F.spark_partition_id()), "categories")
    before = Window.partitionBy("column").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("column", "range").agg(F.count("*").alias("n"))  # a row per column and range
    offsets = sizes.select("column", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("column", "range").orderBy("value")
    numbered = ranged.withColumn("number", F.row_number().over(inside)).join(offsets, ["column", "range"])
    code = (F.col("before") + F.col("number") - 1).cast("bigint")
    return stage(numbered.select("column", "value", code.alias("code")), "category_codes")


def with_codes(df: DataFrame, codes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_code`` for each column; text without a code gets -1. Sizes decide how the codes are joined."""
    for c in columns:
        own = codes.filter(F.col("column") == c).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
        df = df.join(own, as_category(c) == F.col("_value"), "left").withColumn(f"{c}_code", F.coalesce("_code", F.lit(-1)))
        df = df.drop("_value", "_code")
    return df


def label_encode(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Replace nothing but missing text, add an integer code column per text column."""
    text = df.withColumns({c: as_category(c) for c in columns})
    return with_codes(text, category_codes(text, columns), columns)


def share_cuts(features: FeatureSet, shares: Sequence[float], seed: int) -> tuple[Column, list[Column]]:
    """The row's hash, and for each share the hash up to which that share of the rows of the row's label lies.

    Shares are exact per label, to the row: the cut is the hash of the last row
    inside. Copies of a row have one hash and stay together.
    """
    hashed, label = row_share(features.identity, seed), F.col(features.label)
    names = {0: "_of_0", 1: "_of_1"}
    # read several times, and a hash of eight columns costs more than a number that was kept
    values = stage(features.table.select(*[F.when(label == k, hashed).alias(name) for k, name in names.items()]), "hashes")
    rows = values.agg(*[F.count(name).alias(name) for name in names.values()]).first().asDict()
    inside = {name: [math.floor(rows[name] * s + 0.5) for s in shares] for name in names.values()}
    found = at_ranks(values, rows, {name: [n - 1 for n in own if n] for name, own in inside.items()})
    cuts = []
    for i in range(len(shares)):
        at = {k: found[name][inside[name][i] - 1] if inside[name][i] else -1.0 for k, name in names.items()}
        cuts.append(F.when(label == 1, at[1]).otherwise(at[0]))
    return hashed, cuts


def holdout_split(
    features: FeatureSet, test_share: float, seed: int = DEFAULTS.seed
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows, stratified by label, the same each time. The table is read several times: stage it."""
    hashed, (cut,) = share_cuts(features, (test_share,), seed)
    return features.table.filter(hashed > cut), features.table.filter(hashed <= cut)


def with_fold(features: FeatureSet, folds: int, seed: int = DEFAULTS.seed) -> DataFrame:
    """Fold number 0..folds-1, stratified by label, independent of the holdout split."""
    hashed, cuts = share_cuts(features, [i / folds for i in range(1, folds)], seed + 1)
    number = sum(((hashed > cut).cast("int") for cut in cuts), F.lit(0))
    return features.table.withColumn("fold", number)


def split_summary(features: FeatureSet, test_share: float, seed: int = DEFAULTS.seed) -> DataFrame:
    """Rows and positive share on both sides of the split."""
    train, test = holdout_split(features, test_share, seed)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part").agg(F.count("*").alias("rows"), F.avg("label").alias("positive_share"))


def enough_data(features: FeatureSet, min_rows: int, min_positives: int = 1) -> bool:
    """Whether there are more rows than the minimum, and both classes."""
    rows, positives = features.table.agg(
        F.count("*"), F.coalesce(F.sum(F.col(features.label)), F.lit(0))
    ).first()
    return rows > min_rows and min_positives <= positives < rows
