"""Hard negatives by cover trees over norm-augmented candidates.

Components become whole numbers floor(scale * x). Each candidate gets one more
component, the root of M^2 minus its squared length, M being the largest length:
all candidates then lie on one sphere, and a larger inner product is a smaller
distance. A node's points lie within its covering radius r of its centre c, so
for an anchor at distance d of c their products lie between those at the
distances d + r and d - r. Bounds are computed level by level, a child never
exceeding its parent; the descent takes leaves in the order of their upper
bounds, skips nodes outside of every wanted window, stops where the bound falls
below the worst result kept, and verifies leaves in whole numbers.

The top of the tree is a bounded sample: every row goes to its nearest pivot. A
pivot's rows are cut by a hash into shards of bounded bytes, and each shard grows
a cover tree below it: level by level, centres of a node are chosen farthest first until
the next, smaller radius covers all of it; copies of one vector end in one leaf.

Anchors are searched in blocks of ``block`` anchors. A block meets all shards,
spread over so many tasks that the cluster is busy; a task reads its block first, then
one shard after the other, so it holds one block and one shard at a time, and its results
do not grow with the number of shards. Two searches are made: an anchor's positives, then
the windows that their scores open.

Edge cases: rows with a null label, a null vector, or null, NaN or infinite
components take no part; rows without key are no candidates and no anchors; an
anchor never meets rows of its own key, and only vectors of its own number of
dimensions; of several anchor rows with one key the smallest (label, vector) is
searched, repeated candidates count as rows, each with a rank; equal scores go
to the smaller key; components and scores beyond a long stop at its limits; a
label that no other row has opens no window; fewer rows than asked for return
all; an empty table returns nothing; other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from profitlens.llm.topk import LARGEST, exact_products
from profitlens.session import stage

SHARD = "dims int, shard string, keys binary, labels binary, vectors binary, centers binary, radii binary, parents binary, starts binary, ends binary"
FOUND = "anchor_id long, label long, slot int, other_id long, score long"
LOWEST = -(1 << 62)


@dataclass(frozen=True)
class MiningSettings:
    """``low`` and ``high`` are the window's hundredths of the positive score.

    ``sample`` bounds the rows that pivots are chosen from, ``shard_bytes`` and
    ``leaf`` the points of a tree and of its leaves, ``block`` the anchors of a task.
    """

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    scale: int = 256
    sample: int = 4_096
    pivots: int = 256
    shard_bytes: int = 1 << 21
    leaf: int = 32
    block: int = 1_024
    shrink: float = 1.3


@dataclass
class Tree:
    """A cover tree as arrays: parents precede children, leaves own a range of the points."""

    keys: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    centers: np.ndarray
    radii: np.ndarray
    parents: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def leaves(self) -> np.ndarray:
        inner = np.zeros(len(self.parents), bool)
        inner[self.parents[self.parents >= 0]] = True
        return np.flatnonzero(~inner)


def augmented(vectors: np.ndarray, largest: float) -> np.ndarray:
    """One more component, so that all have the length ``largest``."""
    rest = np.sqrt(np.maximum(0.0, largest * largest - (vectors * vectors).sum(axis=1)))
    return np.hstack([vectors, rest[:, None]])


def _distances(points: np.ndarray, center: np.ndarray) -> np.ndarray:
    apart = points - center
    return np.sqrt((apart * apart).sum(axis=1))


def farthest_first(points: np.ndarray, most: int, shrink: float = math.inf) -> tuple[list[int], np.ndarray]:
    """Centres until the first one's radius, divided by ``shrink``, covers all points or ``most`` are chosen; each point's centre."""
    chosen, owner = [0], np.zeros(len(points), np.int64)
    near = _distances(points, points[0])
    radius = near.max() / shrink
    while len(chosen) < most and near.max() > radius:
        new = int(near.argmax())
        apart = _distances(points, points[new])
        closer = apart < near
        owner[closer], near[closer] = len(chosen), apart[closer]
        chosen.append(new)
    return chosen, owner


def build(keys: np.ndarray, labels: np.ndarray, vectors: np.ndarray, largest: float, leaf: int, shrink: float) -> Tree:
    """Level by level: each node's points divide among centres that cover them with the next radius."""
    points = augmented(vectors, largest)
    order: list[np.ndarray] = []
    centers, radii, parents, starts, ends = [], [], [], [], []
    placed = 0
    level = [(np.arange(len(keys)), points.mean(axis=0), -1)]
    while level:
        below = []
        for own, center, parent in level:
            radius = float(_distances(points[own], center).max())
            centers.append(center)
            radii.append(radius)
            parents.append(parent)
            divided = []
            if len(own) > leaf and radius > 0:
                chosen, owner = farthest_first(points[own], max(2, len(own) // leaf), shrink)
                divided = [(own[owner == i], points[own[c]]) for i, c in enumerate(chosen)]
            if len(divided) > 1:
                below += [(part, c, len(centers) - 1) for part, c in divided]
                starts.append(0)
                ends.append(0)
            else:
                order.append(own)
                starts.append(placed)
                placed += len(own)
                ends.append(placed)
        level = below
    by_leaf = np.concatenate(order)
    return Tree(
        keys[by_leaf], labels[by_leaf], vectors[by_leaf], np.array(centers), np.array(radii),
        np.array(parents, np.int64), np.array(starts, np.int64), np.array(ends, np.int64),
    )


@dataclass
class Wanted:
    """One result list of an anchor: the best ``k`` rows with scores from ``low`` to ``high``."""

    k: int
    low: int
    high: int
    best: list[tuple[int, int]] = field(default_factory=list)  # (-score, key)

    def floor(self) -> int:
        """What a row has to reach."""
        return max(self.low, -self.best[-1][0]) if len(self.best) == self.k else self.low

    def offer(self, scores: np.ndarray, keys: np.ndarray) -> None:
        good = np.flatnonzero((scores >= self.floor()) & (scores <= self.high))
        if len(good) > self.k:
            good = good[np.lexsort((keys[good], -scores[good]))[: self.k]]
        if len(good):
            self.best = sorted(self.best + [(-int(s), int(c)) for s, c in zip(scores[good], keys[good], strict=True)])[: self.k]


@dataclass
class Anchor:
    key: int
    label: int
    vector: np.ndarray
    slots: list[int]
    wanted: list[Wanted]


def bounds(tree: Tree, anchors: np.ndarray, largest: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product that the points of each node can have with each anchor."""
    lengths = (anchors * anchors).sum(axis=1)
    flat = np.hstack([anchors, np.zeros((len(anchors), 1))])
    inner = flat @ tree.centers.T
    squares = lengths[:, None] + (tree.centers * tree.centers).sum(axis=1)[None, :] - 2 * inner
    d = np.sqrt(np.maximum(0.0, squares))
    # distances are roots of differences: their rounding is the root of the squares'
    scale = np.sqrt(lengths)[:, None] + largest
    slack = 1e-6 * scale + 1e-6
    near, far = np.maximum(0.0, d - tree.radii - slack), d + tree.radii + slack
    whole = lengths[:, None] + largest * largest
    margin = 1e-6 * scale * scale + 1e-6
    return (whole - far * far) / 2 - margin, (whole - near * near) / 2 + margin


def search(tree: Tree, anchors: list[Anchor], largest: float, same_label: bool, chunk: int = 256) -> None:
    """Take the tree's points into the wanted lists of the anchors."""
    lows, highs = bounds(tree, np.array([a.vector for a in anchors]), largest)
    for node in range(1, len(tree.parents)):  # parents come first
        up = tree.parents[node]
        np.minimum(highs[:, node], highs[:, up], out=highs[:, node])
        np.maximum(lows[:, node], lows[:, up], out=lows[:, node])
    leaves = tree.leaves()
    sizes = (tree.ends - tree.starts)[leaves]
    for i, anchor in enumerate(anchors):
        low, high = lows[i, leaves], highs[i, leaves]
        inside = np.zeros(len(leaves), bool)
        for w in anchor.wanted:
            inside |= (high >= w.floor()) & (low <= w.high)
        order = np.flatnonzero(inside)
        order = order[np.argsort(-high[order], kind="stable")]
        at = 0
        while at < len(order):
            if high[order[at]] < min(w.floor() for w in anchor.wanted):
                break  # best first: no later leaf reaches more
            end = at + max(1, int(np.searchsorted(np.cumsum(sizes[order[at:]]), chunk)))
            rows = np.concatenate([np.arange(tree.starts[n], tree.ends[n]) for n in leaves[order[at:end]]])
            rows = rows[((tree.labels[rows] == anchor.label) == same_label) & (tree.keys[rows] != anchor.key)]
            scores = exact_products(anchor.vector[None, :], tree.vectors[rows])[0]
            scores = np.clip(scores, -LARGEST, LARGEST).astype(np.int64)
            for w in anchor.wanted:
                w.offer(scores, tree.keys[rows])
            at = end


def _whole_rows(vectors: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """(key, label, dims, x, norm) of the rows that take part."""
    own = vectors.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{label}`").cast("long").alias("label"), F.col(f"`{vector}`").alias("v"))
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    own = own.dropna(subset=["key", "label", "v"]).filter(finite)
    whole = own.select("key", "label", F.size("v").alias("dims"), F.transform("v", lambda c: F.floor(c.cast("double") * scale).cast("double")).alias("x"))
    return whole.withColumn("norm", F.sqrt(F.aggregate("x", F.lit(0.0), lambda total, c: total + c * c)))


def _pivots(rows: DataFrame, largest: float, settings: MiningSettings) -> dict[int, np.ndarray]:
    """The top of the tree: centres, farthest first, of a bounded sample of each number of dimensions."""
    sample = rows.select("dims", "x").orderBy(F.xxhash64("key", "x")).limit(settings.sample).toArrow()
    dims, vectors = sample["dims"].to_numpy(), sample["x"].to_pylist()
    found = {}
    for n in sorted(set(dims.tolist())):
        own = [v for v, d in zip(vectors, dims.tolist(), strict=True) if d == n]
        points = augmented(np.array(own, float).reshape(len(own), n), largest)
        found[n] = points[farthest_first(points, settings.pivots)[0]]
    return found


def _with_cells(rows: DataFrame, pivots: dict[int, np.ndarray], largest: float) -> DataFrame:
    """Each row with its nearest pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, cell = batch.column(2).to_numpy(), np.zeros(batch.num_rows, np.int32)
            for n in sorted(set(dims.tolist()) & set(pivots)):
                at = np.flatnonzero(dims == n)
                points = augmented(batch.column(3).take(pa.array(at)).flatten().to_numpy().reshape(len(at), n), largest)
                apart = (pivots[n] * pivots[n]).sum(axis=1)[None, :] - 2 * points @ pivots[n].T
                cell[at] = apart.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], ["key", "label", "dims", "x", "cell"])

    return rows.select("key", "label", "dims", "x").mapInArrow(run, "key long, label long, dims int, x array<double>, cell int")


def _bytes(array: np.ndarray, kind: type) -> pa.Array:
    return pa.array([np.ascontiguousarray(array, kind).tobytes()], pa.binary())


def grow(rows: DataFrame, largest: float, settings: MiningSettings) -> DataFrame:
    """One row per shard with its cover tree."""
    celled = _with_cells(rows, _pivots(rows, largest, settings), largest)
    # a place in the written table divides a cell evenly even if one key holds it all
    celled = stage(celled.withColumn("place", F.monotonically_increasing_id()), "cells")
    parts = F.ceil(F.count("*") * (F.col("dims") + 1) * 8 / settings.shard_bytes)
    sizes = celled.groupBy("dims", "cell").agg(parts.alias("parts"))
    part = F.pmod(F.xxhash64("place"), F.col("parts"))
    dealt = celled.join(sizes, ["dims", "cell"]).select("key", "label", "dims", "x", F.concat_ws("-", "dims", "cell", part).alias("shard"))
    leaf, shrink = settings.leaf, settings.shrink

    def run(table: pa.Table) -> pa.Table:
        n, dims = table.num_rows, table["dims"][0].as_py()
        vectors = table["x"].combine_chunks().flatten().to_numpy().reshape(n, dims)
        tree = build(table["key"].to_numpy(), table["label"].to_numpy(), vectors, largest, leaf, shrink)
        longs = [_bytes(a, np.int64) for a in (tree.keys, tree.labels, tree.parents, tree.starts, tree.ends)]
        doubles = [_bytes(a, np.float64) for a in (tree.vectors, tree.centers, tree.radii)]
        columns = [pa.array([dims], pa.int32()), table["shard"].slice(0, 1).combine_chunks(), longs[0], longs[1], *doubles, *longs[2:]]
        return pa.Table.from_arrays(columns, [f.split()[0] for f in SHARD.split(", ")])

    return dealt.groupBy("shard").applyInArrow(run, SHARD)


def _tree(row: dict) -> Tree:
    keys, dims = np.frombuffer(row["keys"], np.int64), row["dims"]
    parents = np.frombuffer(row["parents"], np.int64)
    return Tree(
        keys, np.frombuffer(row["labels"], np.int64), np.frombuffer(row["vectors"]).reshape(len(keys), dims),
        np.frombuffer(row["centers"]).reshape(len(parents), dims + 1), np.frombuffer(row["radii"]), parents,
        np.frombuffer(row["starts"], np.int64), np.frombuffer(row["ends"], np.int64),
    )


def _searched(anchors: DataFrame, shards: DataFrame, blocks: int, n_shards: int, largest: float, k: int, same_label: bool) -> DataFrame:
    """The ``k`` best rows of each (anchor, slot) in its window, from anchors (key, label, x, slots, lows, highs)."""
    spark = anchors.sparkSession
    spread = max(1, min(n_shards, math.ceil(3 * spark.sparkContext.defaultParallelism / blocks)))
    block = F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")
    asking = anchors.select(block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("part"), F.lit("").alias("shard"), "key", "label", "x", "slots", "lows", "highs")
    part = F.pmod(F.xxhash64("shard"), F.lit(spread)).cast("int")
    held = shards.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), part.alias("part"), "*")
    units = asking.unionByName(held, allowMissingColumns=True).repartition(2 * blocks * spread, "block", "part")
    units = units.sortWithinPartitions("block", "part", "shard")  # a block's anchors come before its shards

    def results(anchors: dict[int, list[Anchor]]) -> Iterator[pa.RecordBatch]:
        rows = [(a.key, a.label, slot, c, -s) for own in anchors.values() for a in own for slot, w in zip(a.slots, a.wanted, strict=True) for s, c in w.best]
        if rows:
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["anchor_id", "label", "slot", "other_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, anchors = None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if (row["block"], row["part"]) != unit:
                    yield from results(anchors)
                    unit, anchors = (row["block"], row["part"]), {}
                if row["shard"]:
                    if row["dims"] in anchors:
                        search(_tree(row), anchors[row["dims"]], largest, same_label)
                else:
                    wanted = [Wanted(k, low, high) for low, high in zip(row["lows"], row["highs"], strict=True)]
                    anchors.setdefault(len(row["x"]), []).append(Anchor(row["key"], row["label"], np.array(row["x"], float), row["slots"], wanted))
        yield from results(anchors)

    found = units.mapInArrow(run, FOUND)
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "other_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    vectors: DataFrame, is_anchor: str, key: str = "vec_id", vector: str = "embedding", label: str = "label", settings: MiningSettings = MiningSettings()
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors that the SQL condition picks by ``key``."""
    rows = stage(_whole_rows(vectors, key, vector, label, settings.scale), "whole_vectors")
    largest = rows.agg(F.max("norm")).first()[0] or 0.0
    chosen = rows.withColumnRenamed("key", key).filter(is_anchor).withColumnRenamed(key, "key")
    anchors = stage(chosen.groupBy("key").agg(F.min(F.struct("label", "x")).alias("own")).select("key", "own.label", "own.x"), "anchors")
    blocks = max(1, math.ceil(anchors.count() / settings.block))
    shards = stage(grow(rows, largest, settings), "shards")
    n_shards = shards.count()
    all_scores = [F.array(F.lit(value).cast(kind)).alias(name) for name, value, kind in (("slots", 0, "int"), ("lows", LOWEST, "long"), ("highs", -LOWEST, "long"))]
    positives = _searched(anchors.select("*", *all_scores), shards, blocks, n_shards, largest, settings.positives, True)
    positives = stage(positives.select("anchor_id", F.col("rank").alias("slot"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    score = F.col("positive_score").cast("decimal(38, 0)")
    low, high = F.ceil(score * settings.low / 100), F.floor(score * settings.high / 100)
    windows = positives.withColumns({"low": low.cast("long"), "high": high.cast("long")}).filter("low <= high")
    windows = windows.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("slot", "low", "high"))).alias("w"))
    asking = anchors.join(windows, F.col("key") == F.col("anchor_id")).select(
        "key", "label", "x", F.col("w.slot").alias("slots"), F.col("w.low").alias("lows"), F.col("w.high").alias("highs")
    )
    negatives = _searched(asking, shards, blocks, n_shards, largest, settings.negatives, False)
    found = positives.join(negatives.drop("label"), ["anchor_id", "slot"])
    return found.select("anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
