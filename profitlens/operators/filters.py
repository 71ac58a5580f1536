"""Selections, policy breaches, and the options a user can select from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profitlens.config import DEFAULTS

FILTER_DIMENSIONS = ("customer_segment", "category_name", "market")


def cross_filter(df: DataFrame, **selected: Sequence[str]) -> DataFrame:
    """Rows whose value is among the selected ones, per dimension; an empty selection keeps all."""
    for column, values in selected.items():
        if values and column in df.columns:
            df = df.filter(F.col(column).isin(list(values)))
    return df


def matching(df: DataFrame, selection: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose values are in a selection table.

    On a table partitioned by these columns the selection is looked up first,
    and only the partitions it names are read.
    """
    return df.join(selection.select(*columns).distinct(), list(columns), "left_semi")


def filter_options(df: DataFrame, dimensions: Sequence[str] = FILTER_DIMENSIONS) -> DataFrame:
    """Distinct values per dimension, in one pass over the rows."""
    pairs = F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in dimensions if d in df.columns
    ])
    return (
        # Distinct combinations first: they are few, so few rows are unfolded.
        df.select(*[d for d in dimensions if d in df.columns])
        .distinct()
        .select(F.inline(pairs))
        .filter(F.col("value").isNotNull())
        .distinct()
        .orderBy("dimension", "value")
    )


def tag_policy_breach(df: DataFrame, cap: float = DEFAULTS.discount_cap) -> DataFrame:
    """``violation`` above the cap, ``compliant`` up to it."""
    rate = F.col("discount_rate")
    return df.withColumn(
        "policy", F.when(rate > cap, "violation").when(rate <= cap, "compliant")
    )


def policy_breaches(df: DataFrame, cap: float = DEFAULTS.discount_cap) -> DataFrame:
    return df.filter(F.col("discount_rate") > cap)


def kept_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns the table has."""
    return df.select(*[c for c in wanted if c in df.columns])
