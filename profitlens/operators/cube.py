"""Headline numbers of any selection from a cube, without reading order items.

The cube has two tables. ``sums`` keeps the exact partial sums of each cell;
``sets`` keeps the customers and orders of each cell as bitmaps, one per 32,768
consecutive ids, so that distinct counts of several cells merge without
counting anybody twice. Both hold a cell set per subset of the dimensions
(``level``: a bit per dimension that is summed up) and are partitioned by it. A
selection is answered from the level that has its filtered dimensions and no
others: the smallest cell set that covers it.

Ids are whole numbers; the closer they lie together, the smaller the bitmaps. A
null id counts for no set, a null dimension is a cell of its own that no
selected value meets.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profitlens.functions.arithmetic import merged_sums, merged_total, partial_sums
from profitlens.operators.filters import FILTER_DIMENSIONS, cross_filter
from profitlens.operators.kpis import headline
from profitlens.session import stage

MEASURES = ("sales", "profit")
KEYS = {"customer": "customer_id", "order": "order_id"}
IDS_A_TASK = 1 << 19
BITMAPS_A_TASK = 1 << 12  # 16 MB a level


@dataclass(frozen=True)
class Cube:
    """(level, dimensions, rows, partial sums) and (level, dimensions, kind, bucket, bitmap)."""

    sums: DataFrame
    sets: DataFrame
    dimensions: tuple[str, ...]

    def level(self, filtered: Sequence[str]) -> int:
        """A bit per dimension, the last one lowest, set where it is summed up."""
        return _level(self.dimensions, filtered)


def _level(dimensions: Sequence[str], filtered: Sequence[str]) -> int:
    return sum(1 << i for i, d in enumerate(reversed(dimensions)) if d not in filtered)


def _grouping_sets(dimensions: Sequence[str]) -> list[list]:
    return [[F.col(c) for c in chosen] for n in range(len(dimensions), -1, -1) for chosen in combinations(dimensions, n)]


def build_cube(tx: DataFrame, dimensions: tuple[str, ...] = FILTER_DIMENSIONS) -> Cube:
    """All levels; only the finest cells are made from order items, the others are merged from them."""
    dimensions = tuple(d for d in dimensions if d in tx.columns)
    kinds = {kind: key for kind, key in KEYS.items() if key in tx.columns}
    finest = tx.groupBy(*dimensions).agg(F.count("*").alias("rows"), *[p for m in MEASURES for p in partial_sums(m, m)])
    finest = stage(finest, "finest_cells")
    level = F.grouping_id().cast("int").alias("level")
    sums = finest.groupingSets(_grouping_sets(dimensions), *dimensions).agg(
        level, F.sum("rows").alias("rows"), *[p for m in MEASURES for p in merged_sums(m)]
    )
    members = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(key).cast("bigint").alias("id")) for kind, key in kinds.items()])
    shown = tx.select(*dimensions, F.inline(members)).filter(F.col("id").isNotNull()).distinct()
    cell = ["kind", "bucket", *dimensions]
    placed = shown.select("kind", F.bitmap_bucket_number("id").alias("bucket"), *dimensions, F.bitmap_bit_position("id").alias("bit"))
    # Ids are brought to their cell before a bitmap is made: made where the rows lie, there would be one per task and cell.
    rows = (finest.agg(F.sum("rows")).first()[0] or 0) * len(kinds)
    bitmaps = placed.repartition(_parts(rows, IDS_A_TASK), *cell).groupBy(*cell).agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    return Cube(sums, _merged_sets(stage(bitmaps, "finest_sets"), dimensions), dimensions)


def _merged_sets(finest: DataFrame, dimensions: tuple[str, ...]) -> DataFrame:
    """The bitmaps of all levels; those of a bucket meet once, and no task has more than about ``BITMAPS_A_TASK``."""
    always = ("kind", "bucket")
    met = finest.repartition(_parts(finest.count(), BITMAPS_A_TASK), *always)
    sets = None
    for n in range(len(dimensions), -1, -1):
        for chosen in combinations(dimensions, n):
            cells = met if chosen == dimensions else met.groupBy(*always, *chosen).agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
            shown = [F.col(d) if d in chosen else F.lit(None).cast(finest.schema[d].dataType).alias(d) for d in dimensions]
            cells = cells.select(*always, *shown, F.lit(_level(dimensions, chosen)).alias("level"), "bitmap")
            sets = cells if sets is None else sets.unionByName(cells)
    return sets


def _parts(rows: int, most: int) -> int:
    return max(1, ceil(rows / most))


def write_cube(cube: Cube, folder: str) -> None:
    # A level's cells lie together, so that few files are read for it. Tasks that merge sets hold a bounded number of them and
    # write them; to collect them anew would go by compressed size, which is far less than what a nearly empty bitmap takes in memory.
    for name, table in (("cube_sums", cube.sums.hint("rebalance", F.col("level"))), ("cube_sets", cube.sets)):
        table.write.mode("overwrite").partitionBy("level").parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_cube(spark: SparkSession, folder: str, dimensions: tuple[str, ...] = FILTER_DIMENSIONS) -> Cube:
    sums, sets = (spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet") for name in ("cube_sums", "cube_sets"))
    return Cube(sums, sets, tuple(d for d in dimensions if d in sums.columns))


def routed_kpis(cube: Cube, **selected: Sequence[str]) -> DataFrame:
    """What ``filtered_kpis`` says of the selected order items; an empty selection keeps all of a dimension."""
    wanted = {d: values for d, values in selected.items() if values and d in cube.dimensions}
    level = cube.level(list(wanted))
    cells = cross_filter(cube.sums.filter(F.col("level") == level), **wanted)
    sets = cross_filter(cube.sets.filter(F.col("level") == level), **wanted)
    merged = sets.groupBy("kind", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    sizes = merged.agg(*[F.coalesce(F.sum(F.when(F.col("kind") == kind, F.bitmap_count("bitmap"))), F.lit(0)).alias(kind) for kind in KEYS])
    distinct = sizes.select(F.struct(*KEYS)).scalar()
    has_orders = not cube.sets.filter("kind = 'order'").isEmpty()
    totals = cells.agg(
        *[merged_total(m).alias(name) for m, name in zip(MEASURES, ("revenue", "profit"), strict=True)],
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
    )
    counted = totals.withColumn("customers", distinct["customer"]).withColumn("orders", distinct["order"] if has_orders else F.col("rows"))
    return headline(counted)
