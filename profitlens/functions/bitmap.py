"""Membership of hashed keys in a bitmap of bounded size, as column expressions.

A key that was put in is always found; others are found rarely, the more often
the fuller the bitmap is. Use it where a wrong hit costs work and no result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profitlens.session import stage

MOST_WORDS = 1 << 17
WORDS_A_KEY = 0.25  # sixteen bits


def _place_and_mask(key: Column, words: int) -> tuple[Column, Column]:
    """A word, and four bits in it."""
    mask = F.lit(0).cast("bigint")
    for shift in (0, 6, 12, 18):
        bit = F.shiftrightunsigned(key, shift).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit))
    return F.pmod(F.shiftrightunsigned(key, 24), F.lit(words)).cast("int"), mask


@dataclass(frozen=True)
class Bitmap:
    """A staged table of one row, the words; rows meet it as a scalar subquery, without a join."""

    table: DataFrame
    words: int

    @classmethod
    def of(cls, keys: DataFrame, key: str, rows: int, most_words: int = MOST_WORDS) -> Bitmap:
        """From a column of 64-bit hashes, about ``rows`` of them; never more than ``most_words`` words (1 MB)."""
        words = max(1, min(most_words, int(rows * WORDS_A_KEY)))
        place, mask = _place_and_mask(F.col(key), words)
        filled = keys.select(place.alias("place"), mask.alias("mask"))
        every = keys.sparkSession.range(words).select(F.col("id").cast("int").alias("place"), F.lit(0).cast("bigint").alias("mask"))
        merged = filled.unionByName(every).groupBy("place").agg(F.bit_or("mask").alias("mask"))
        ordered = F.transform(F.array_sort(F.collect_list(F.struct("place", "mask"))), lambda w: w["mask"])
        return cls(stage(merged.agg(ordered.alias("words")), "bitmap"), words)

    def may_hold(self, key: Column) -> Column:
        place, mask = _place_and_mask(key, self.words)
        return F.get(self.table.scalar(), place).bitwiseAND(mask) == mask


def divided(df: DataFrame, may_hold: Column) -> tuple[DataFrame, DataFrame]:
    """The rows that a bitmap may hold, and the others.

    Asked once per row, in a projection. As a mere filter it would be pushed
    into the joins that made ``df``, and be computed there several times over; a
    filter on a partition number stays where it is.
    """
    asked = df.select("*", may_hold.alias("_held"), F.spark_partition_id().alias("_place"))
    parts = (asked.filter((F.col("_held") == wanted) & (F.col("_place") >= 0)).drop("_held", "_place") for wanted in (True, False))
    return next(parts), next(parts)
