"""Running totals and exact quantiles over tables of any size.

There is one way for every size. Ordered values are cut into slices at
quantiles of a sample. For a running total each slice is summed, the slice sums
are accumulated, and the total inside a slice starts from what the slices
before it add up to. For a quantile the slices are counted, and only the one
that holds the wanted rank is sorted, after it has been cut again as long as it
is too large for one task. Where the cuts fall changes only the balance between
tasks, never the result.

A value that many rows share would fill one slice. Such a value is a cut
itself, and the rows equal to a cut form slices of their own, divided by the
leading digits of the md5 of the row key. Ties are ordered by that md5 for
this reason.

The tables are read several times: stage them when they are costly to compute.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from profitlens.functions.arithmetic import null_if_nan

SLICE_ROWS = 1_000_000  # what one task sorts
SAMPLE_ROWS = 4_000_000  # what the cuts are taken from
SKETCH_ACCURACY = 100_000
LEAST_SLICES = 16
SEED = 42


def slice_count(rows: int) -> int:
    """Slices of about a quarter of what one task sorts."""
    return max(LEAST_SLICES, math.ceil(4 * rows / SLICE_ROWS))


def tie_digits(rows: int) -> int:
    """Leading hexadecimal digits that divide even a value shared by all rows into slices for one task."""
    return max(1, math.ceil(math.log(max(1, 4 * rows / SLICE_ROWS), 16)) + 1)


def sample_cuts(
    df: DataFrame, rows: int, columns: Sequence[str], shares: Sequence[float], accuracy: int = SKETCH_ACCURACY
) -> dict[str, list[float]]:
    """Approximate quantiles of each column, sorted and distinct.

    A sample of bounded size keeps the sketches small that meet in one task,
    and at most one number per share comes to the driver.
    """
    sample = df if rows <= SAMPLE_ROWS else df.sample(SAMPLE_ROWS / rows, SEED)
    found = sample.agg(
        *[F.percentile_approx(F.col(c).cast("double"), list(shares), accuracy).alias(c) for c in columns]
    ).first()
    return {c: sorted(set(found[c] or [])) for c in columns}


def with_slices(df: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """Add ``_slice_<column>``, the slice a value falls in, and ``_at_cut_<column>``.

    Values equal to a cut have a slice of their own, between their neighbours.
    """
    cut = {c: edges for c, edges in cuts.items() if edges}
    added = {f"_at_or_below_{c}": F.lit(0) for c in cuts if c not in cut}
    if cut:
        infinity = float("inf")
        df = Bucketizer(
            splitsArray=[[-infinity, *edges, infinity] for edges in cut.values()],
            inputCols=list(cut),
            outputCols=[f"_at_or_below_{c}" for c in cut],
            handleInvalid="keep",
        ).transform(df)
    df = df.withColumns({**added, **{f"_at_or_below_{c}": F.col(f"_at_or_below_{c}").cast("int") for c in cut}})
    for c, edges in cuts.items():
        position, at_cut = F.col(f"_at_or_below_{c}"), F.lit(False)
        if edges:
            sorted_edges = F.expr(f"array({', '.join(f'double({edge!r})' for edge in edges)})")
            at_cut = F.coalesce(F.get(sorted_edges, position - 1) == F.col(c).cast("double"), F.lit(False))
        df = df.withColumn(f"_at_cut_{c}", at_cut).withColumn(
            f"_slice_{c}", position * 2 - F.col(f"_at_cut_{c}").cast("int")
        )
    return df


def _with_slice(df: DataFrame, by: str, tie: str | None, cuts: Sequence[float], digits: int = 2) -> DataFrame:
    sliced = with_slices(df, {by: list(cuts)}).withColumnRenamed(f"_slice_{by}", "_slice")
    if tie is None:
        return sliced.withColumn("_tie_slice", F.lit(0))
    first_digits = F.conv(F.substring("_tie", 1, digits), 16, 10).cast("int")
    return sliced.withColumn("_tie", F.md5(F.col(tie).cast("string"))).withColumn(
        "_tie_slice", F.when(F.col(f"_at_cut_{by}"), first_digits).otherwise(F.lit(0))
    )


def with_value_slices(df: DataFrame, by: str) -> DataFrame:
    """Add ``_slice``, the number of the range of values that a row falls in, and ``_at_cut``, whether that is a single value.

    There are as many ranges as the rows ask for. Rows without a value have to be gone.
    """
    rows = df.count()
    slices = slice_count(rows)
    cuts = sample_cuts(df, rows, [by], [i / slices for i in range(1, slices)], 20 * slices)[by]
    return with_slices(df, {by: cuts}).withColumnsRenamed({f"_slice_{by}": "_slice", f"_at_cut_{by}": "_at_cut"}).drop(f"_at_or_below_{by}")


def running_totals(
    df: DataFrame,
    by: str,
    totals: dict[str, str],
    tie: str | None = None,
    descending: bool = False,
    group: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """Add a running total of each column in ``totals`` (column -> name of the result).

    With ``group`` the totals run within each group; meant for a handful of
    groups that may each be large.

    Rows are ordered by ``by`` and, where several share a value, by the md5 of
    ``tie``. Without ``tie`` the values of ``by`` have to be distinct. Rows
    without a value are left out.
    """
    valued = df.filter(F.col(by).isNotNull())
    rows = valued.count()
    slices = slices or slice_count(rows)
    up_to_here = (Window.unboundedPreceding, Window.currentRow)
    order = [F.col(by).desc() if descending else F.col(by)] + (["_tie"] if tie else [])
    # slices need not be quite even
    cuts = sample_cuts(valued, rows, [by], [i / slices for i in range(1, slices)], 20 * slices)[by]
    sliced = _with_slice(valued, by, tie, cuts, tie_digits(rows))
    slice_order = F.col("_slice").desc() if descending else F.col("_slice")
    before = (
        Window.partitionBy(*group).orderBy(slice_order, "_tie_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    # A row per slice; both sides of the join below are dealt out by slice, as the window inside slices needs.
    sums = (
        sliced.groupBy(*group, "_slice", "_tie_slice")
        .agg(*[F.sum(c).alias(f"_in_{c}") for c in totals])
        .select(
            *group,
            "_slice",
            "_tie_slice",
            *[F.coalesce(F.sum(f"_in_{c}").over(before), F.lit(0)).alias(f"_before_{c}") for c in totals],
        )
    )
    inside = Window.partitionBy(*group, "_slice", "_tie_slice").orderBy(*order).rowsBetween(*up_to_here)
    return (
        sliced.join(sums, [*group, "_slice", "_tie_slice"])
        .withColumns({name: F.col(f"_before_{c}") + F.sum(c).over(inside) for c, name in totals.items()})
        .select(*df.columns, *totals.values())
    )


# Cuts around a wanted share: as fine as the sample is uncertain there, out to
# where the true quantile can no longer be.
CUT_STEP = 6e-5
CUTS_EACH_SIDE = 16


@dataclass
class Stretch:
    """An open interval of a column's values that holds wanted ranks: ``before`` rows lie below, ``rows`` in it."""

    column: str
    low: float = -math.inf
    high: float = math.inf
    before: int = 0
    rows: int = 0
    ranks: list[int] = field(default_factory=list)

    def holds(self) -> Column:
        value, inside = F.col(self.column), F.col(self.column).isNotNull()
        if math.isfinite(self.low):
            inside = inside & (value > F.lit(self.low))
        return inside & (value < F.lit(self.high)) if math.isfinite(self.high) else inside


def _narrowed(values: DataFrame, stretches: list[Stretch], shares: Sequence[float], found: dict) -> list[Stretch]:
    """Cut stretches at sampled quantiles and count: ranks that fall on a cut are found, the others in a narrower stretch."""
    columns = sorted({s.column for s in stretches})
    held = {c: [s for s in stretches if s.column == c] for c in columns}
    inside = {c: F.lit(False) for c in columns}
    for s in stretches:
        inside[s.column] = inside[s.column] | s.holds()
    # each value only where it is still open
    values = values.select(*[F.when(inside[c], F.col(c)).alias(c) for c in columns])
    cuts = sample_cuts(values, max(sum(s.rows for s in own) for own in held.values()), columns, shares)
    bounds = {c: {b for s in held[c] for b in (s.low, s.high) if math.isfinite(b)} for c in columns}
    cuts = {c: sorted(bounds[c].union(cuts[c])) for c in columns}
    pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).alias("value"), F.col(f"_slice_{c}").alias("slice")) for c in columns]
    counted = with_slices(values, cuts).select(F.inline(F.array(*pairs))).filter("value is not null").groupBy("metric", "slice").count()
    sizes = {(r["metric"], r["slice"]): r["count"] for r in counted.collect()}  # two rows per cut at most
    narrower = []
    for stretch in stretches:
        edges = cuts[stretch.column]
        first = 2 * edges.index(stretch.low) + 2 if math.isfinite(stretch.low) else 0
        last = 2 * edges.index(stretch.high) if math.isfinite(stretch.high) else 2 * len(edges)
        before = stretch.before
        for number in range(first, last + 1):
            rows = sizes.get((stretch.column, number), 0)
            ranks = [r for r in stretch.ranks if before <= r < before + rows]
            if ranks and number % 2:
                found[stretch.column].update(dict.fromkeys(ranks, edges[number // 2]))
            elif ranks:
                low = edges[number // 2 - 1] if number else -math.inf
                high = edges[number // 2] if number < 2 * len(edges) else math.inf
                narrower.append(Stretch(stretch.column, low, high, before, rows, ranks))
            before += rows
    return narrower


def _sorted_out(values: DataFrame, stretches: list[Stretch], found: dict) -> None:
    """Find the ranks of stretches that one task each can sort."""
    pairs = [
        F.struct(F.lit(i).alias("stretch"), F.when(s.holds(), F.col(s.column)).alias("value")) for i, s in enumerate(stretches)
    ]
    up_to_here = Window.partitionBy("stretch").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = (
        values.select(F.inline(F.array(*pairs))).filter("value is not null")
        .groupBy("stretch", "value").agg(F.count("*").alias("n")).withColumn("reached", F.sum("n").over(up_to_here))
    )
    wanted = F.lit(False)
    for i, s in enumerate(stretches):
        for rank in s.ranks:
            at = F.lit(rank - s.before)
            wanted = wanted | ((F.col("stretch") == i) & (F.col("reached") > at) & (F.col("reached") - F.col("n") <= at))
    for row in reached.filter(wanted).collect():  # a row per wanted rank at most
        s = stretches[row["stretch"]]
        hit = [r for r in s.ranks if row["reached"] - row["n"] <= r - s.before < row["reached"]]
        found[s.column].update(dict.fromkeys(hit, row["value"]))


def at_ranks(values: DataFrame, rows: dict[str, int], ranks: dict[str, Sequence[int]]) -> dict[str, dict[int, float]]:
    """The values at the given ranks (from 0) of each column's ascending order.

    ``rows`` counts each column's values. Cuts lie closely around each wanted
    rank first; a slice that still holds more than ``SLICE_ROWS`` is cut again.
    Only counts, cuts and results come to the driver, a bounded number per rank.
    """
    found: dict[str, dict[int, float]] = {c: {} for c in ranks}
    open_stretches = [Stretch(c, rows=rows[c], ranks=sorted(set(own))) for c, own in ranks.items() if own]
    around = sorted({
        min(1.0, max(0.0, rank / max(1, s.rows - 1) + i * CUT_STEP))
        for s in open_stretches for rank in s.ranks for i in range(-CUTS_EACH_SIDE, CUTS_EACH_SIDE + 1)
    })
    while open_stretches:
        open_stretches = _narrowed(values, open_stretches, around, found)
        ready = [s for s in open_stretches if s.rows <= SLICE_ROWS]
        if ready:
            _sorted_out(values, ready, found)
        open_stretches = [s for s in open_stretches if s.rows > SLICE_ROWS]
        around = [i / 256 for i in range(257)]
    return found


def quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> dict[str, list[float | None]]:
    """Exact quantiles with linear interpolation, as numbers to be used as literals that scans can push down.

    Null and NaN do not count.
    """
    values = df.select(*[null_if_nan(F.col(c).cast("double")).alias(c) for c in columns])
    rows = values.agg(*[F.count(c).alias(c) for c in columns]).first()
    places = {c: [(rows[c] - 1) * float(s) for s in shares] for c in columns if rows[c]}
    whole = {c: [edge(r) for r in own for edge in (math.floor, math.ceil)] for c, own in places.items()}
    found = at_ranks(values, {c: rows[c] for c in places}, whole)

    def between(column: str, place: float) -> float:
        low, high = found[column][math.floor(place)], found[column][math.ceil(place)]
        return low + (high - low) * (place - math.floor(place))

    return {c: [between(c, r) for r in places[c]] if c in places else [None] * len(shares) for c in columns}


QUARTERS = (0.0, 0.25, 0.5, 0.75, 1.0)
COLLAPSED_SCORE = 2


def quartile_score(value: Column, edges: Sequence[float | None], lowest_first: bool = True) -> Column:
    """Score 1..4 by the quartile a value falls in; 4..1 when the lowest values are best.

    A quartile includes its upper edge, so equal values share a score. When two
    edges coincide the whole column scores 2.
    """
    if len(set(edges)) < len(QUARTERS):
        return F.lit(COLLAPSED_SCORE)
    scores = (1, 2, 3, 4) if lowest_first else (4, 3, 2, 1)
    return (
        F.when(value <= edges[1], scores[0])
        .when(value <= edges[2], scores[1])
        .when(value <= edges[3], scores[2])
        .when(value.isNotNull(), scores[3])
    )
