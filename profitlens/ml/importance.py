"""Permutation importance without collecting or numbering rows in one place."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profitlens.config import DEFAULTS
from profitlens.functions.ordered import running_totals
from profitlens.ml.features import FeatureSet
from profitlens.ml.metrics import roc_auc
from profitlens.operators.sampling import row_share
from profitlens.session import stage


def permutation_importance(
    scorer: Callable[[DataFrame, str], DataFrame],
    features: FeatureSet,
    repeats: int = 15,
    n: int = 10,
    seed: int = DEFAULTS.seed,
) -> DataFrame:
    """Loss of AUC when one feature is replaced by that of another row.

    ``scorer(table, name)`` adds the model's probability under that name.

    Rows are numbered in hash order. In each repeat a row takes its replacement
    values from the row a fixed distance further on, round the end: a
    permutation in random order, and an equi-join on a unique number.
    """
    columns = list(features.features)
    table = features.table.select(
        *columns,
        features.label,
        row_share(features.identity, seed + 2).alias("_order"),
        F.concat_ws("|", *[F.col(c).cast("string") for c in features.identity]).alias("_key"),
        F.lit(1).cast("bigint").alias("_one"),
    )
    numbered = stage(
        running_totals(stage(table, "holdout"), by="_order", totals={"_one": "_row"}, tie="_key")
        .select("_row", features.label, *columns),
        "numbered",
    )
    rows = numbered.agg(F.count("*")).scalar()
    # Distances spread over the table, never 0 for more rows than repeats.
    distance = F.floor(rows * F.col("repeat") / F.lit(repeats + 1)).cast("bigint")
    shifted = numbered.withColumn(
        "repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats)))
    ).withColumn("_other", F.pmod(F.col("_row") - 1 + distance, rows) + 1)
    others = numbered.select(F.col("_row").alias("_other"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    variants = F.array(*[
        F.struct(
            F.lit(changed).alias("feature"),
            *[F.col(f"_new_{c}" if c == changed else c).alias(c) for c in columns],
        )
        for changed in columns
    ])
    changed = shifted.join(others, "_other").select("repeat", features.label, F.inline(variants))
    permuted = roc_auc(scorer(changed, "_p"), "_p", features.label, group=("repeat", "feature"))
    base = stage(roc_auc(scorer(numbered, "_p"), "_p", features.label), "base_auc").scalar()
    return (
        permuted.groupBy("feature")
        .agg((base - F.avg("auc")).alias("importance"))
        .orderBy(F.col("importance").desc(), "feature")
        .limit(n)
    )
