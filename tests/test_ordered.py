"""Running totals and quantiles against brute force, with hot values and ties."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from profitlens.functions import ordered
from profitlens.functions.ordered import (
    QUARTERS,
    _with_slice,
    quantiles,
    quartile_score,
    running_totals,
    sample_cuts,
    with_slices,
)


def md5(value):
    return hashlib.md5(str(value).encode()).hexdigest()


def brute_force(rows, descending):
    ordered = sorted(rows, key=lambda r: (-r[1] if descending else r[1], md5(r[0])))
    so_far, result = 0.0, {}
    for key, value in ordered:
        so_far += value
        result[key] = so_far
    return result


def hot(n, seed):
    """A third of the rows share one value."""
    rng = random.Random(seed)
    return [(i, 7.0 if i % 3 == 0 else float(rng.randint(-500, 500))) for i in range(n)]


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize(
    "rows",
    [hot(3000, 1), [(i, 5.0) for i in range(500)], [(i, float(i)) for i in range(700)], [(1, 2.5)], []],
    ids=["hot value", "one value", "all distinct", "one row", "no rows"],
)
@pytest.mark.parametrize("slices", [None, 40])
def test_running_total_equals_one_ordered_pass(spark, rows, descending, slices):
    df = spark.createDataFrame(rows, "k long, v double").repartition(5)
    got = running_totals(df, "v", {"v": "sum_so_far"}, tie="k", descending=descending, slices=slices)
    assert got.columns == ["k", "v", "sum_so_far"]
    assert {r["k"]: r["sum_so_far"] for r in got.collect()} == pytest.approx(brute_force(rows, descending))


def test_a_hot_value_is_split_over_many_slices(spark):
    df = spark.createDataFrame(hot(6000, 2), "k long, v double")
    cuts = sample_cuts(df, 6000, ["v"], [i / 16 for i in range(1, 16)])["v"]
    sizes = [r["count"] for r in _with_slice(df, "v", "k", cuts).groupBy("_slice", "_tie_slice").count().collect()]
    assert max(sizes) < 6000 / 8


def test_running_total_per_group(spark):
    rows = [("a", float(i)) for i in range(50)] + [("b", float(i)) for i in range(30)]
    df = spark.createDataFrame(rows, "g string, v double").withColumn("one", F.lit(1).cast("long"))
    got = running_totals(df, "v", {"one": "n"}, group=("g",), slices=8).groupBy("g").agg(F.max("n")).collect()
    assert dict(got) == {"a": 50, "b": 30}


@pytest.mark.parametrize(
    "values",
    [
        [v for _, v in hot(2000, 3)],
        [1.0, 2.0, 2.0, 2.0, 3.0, 4.0, 5.0, 6.0],
        [3.0],
        [0.0] * 100 + [1.0],
        list(np.random.default_rng(4).normal(size=4001)),
    ],
    ids=["hot value", "ties", "one row", "nearly constant", "normal"],
)
def test_quantiles_interpolate_like_numpy(spark, values):
    shares = (0.0, 0.25, 0.5, 0.75, 0.9, 1.0)
    df = spark.createDataFrame([(float(v), float(-v)) for v in values] + [(None, None)], "x double, y double")
    got = quantiles(df.repartition(3), ["x", "y"], shares)
    assert got["x"] == pytest.approx(list(np.quantile(values, shares)), abs=1e-12)
    assert got["y"] == pytest.approx(list(np.quantile([-v for v in values], shares)), abs=1e-12)


@pytest.mark.parametrize("slice_rows", [1, 20, 1_000_000])
def test_quantiles_stay_exact_with_a_poor_sample_and_tight_slices(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(ordered, "SAMPLE_ROWS", 50)
    monkeypatch.setattr(ordered, "SLICE_ROWS", slice_rows)
    values = [v for _, v in hot(3000, 9)]
    df = spark.createDataFrame([(v, v / 7) for v in values], "x double, y double")
    got = quantiles(df, ["x", "y"], (0.1, 0.5, 0.97))
    assert got["x"] == pytest.approx(list(np.quantile(values, (0.1, 0.5, 0.97))), abs=1e-12)
    assert got["y"] == pytest.approx(list(np.quantile([v / 7 for v in values], (0.1, 0.5, 0.97))), abs=1e-12)


def test_nan_is_no_value(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double")
    assert quantiles(df, ["x"], (0.0, 0.5, 1.0))["x"] == [1.0, 2.0, 3.0]


def test_slices_follow_the_order_of_values(spark):
    values = [-3.0, -1.0, -0.5, 1e-7, 2.0, 2.5, 9.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    sliced = with_slices(df, {"v": [-1.0, 1e-7, 2.0]})
    got = [tuple(r) for r in sliced.orderBy("v").select("_slice_v", "_at_cut_v").collect()]
    assert got == [(0, False), (1, True), (2, False), (3, True), (5, True), (6, False), (6, False)]


def scores(spark, values, **options):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i long, v double")
    edges = quantiles(df, ["v"], QUARTERS)["v"]
    return [r["s"] for r in df.withColumn("s", quartile_score(F.col("v"), edges, **options)).orderBy("i").collect()]


def test_equal_values_share_a_quartile(spark):
    assert scores(spark, [1, 2, 2, 2, 3, 4, 5, 6]) == [1, 1, 1, 1, 3, 3, 4, 4]
    assert scores(spark, [1, 2, 2, 2, 3, 4, 5, 6], lowest_first=False) == [4, 4, 4, 4, 2, 2, 1, 1]


def test_no_values_no_quantiles(spark):
    df = spark.createDataFrame([(None, 1.0)], "x double, y double")
    assert quantiles(df, ["x", "y"], (0.5,)) == {"x": [None], "y": [1.0]}


def test_collapsed_edges_score_two(spark):
    assert scores(spark, [1, 1, 1, 1, 1, 2, 3, 9]) == [2] * 8
