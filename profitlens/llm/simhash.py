"""SimHash near-duplicates through vantage-point trees.

Fingerprints link if they differ in at most ``radius`` bits. The bits are cut
into ``parts`` stretches: two linked fingerprints differ in at most
radius // parts bits of some stretch, so a tree per stretch with that smaller
radius loses no link, and its triangle bounds exclude far more.

A tree splits the fingerprints of a shard by Hamming distance to a vantage
point: inner up to mu, outer beyond. Two values within the radius can lie on
both sides only if the inner one is farther than mu - radius from the vantage
point; those boundary values go to both sides. Every linked pair therefore
meets in a leaf, where all bits are compared. Trees are learnt on a bounded
sample of distinct fingerprints, which decides where shards end and not what is
found. A leaf returns a spanning forest of its links, and the forests of all
leaves are joined into components by alternating star contraction.

A leaf with more than ``leaf_limit`` fingerprints (a dense group that no vantage
point divides) is cut into blocks, and each pair of blocks is a task of its own.

Edge cases: null and empty texts have fingerprint zero and link like any other;
repeated rows and exact copies share a fingerprint and thus a component; a null
key belongs to a component but never names it, and a component without any key
is named null; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profitlens.llm.text import add_columns, columns_of
from profitlens.session import stage


@dataclass(frozen=True)
class SimHashSettings:
    """``sample`` bounds the fingerprints that trees are learnt on, the leaf sizes what a task holds."""

    shingle: int = 4
    radius: int = 4
    parts: int = 4
    leaf: int = 8_192
    leaf_limit: int = 65_536
    sample: int = 100_000


# --- fingerprints -------------------------------------------------------------


def fingerprint(data: bytes | None, shingle: int = 4) -> int:
    """Bit by bit the majority of the XXH64 hashes (seed 42) of a text's word shingles."""
    own = data.lower().split() if data else []
    if not own:
        return 0
    joined, count = b" ".join(own), max(1, len(own) - shingle + 1)
    sizes = np.fromiter(map(len, own), np.int64, len(own))
    ends = np.cumsum(sizes + 1) - 1
    firsts = (ends - sizes)[:count].tolist()
    lasts = ends[min(shingle, len(own)) - 1 :].tolist()
    hash64 = xxhash.xxh64_intdigest
    set_bits = np.zeros(64, np.int64)
    for start in range(0, count, 1 << 15):
        stop = start + (1 << 15)
        hashes = [hash64(joined[a:b], 42) for a, b in zip(firsts[start:stop], lasts[start:stop], strict=True)]
        octets = np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > count).tobytes(), "big")


def with_fingerprints(docs: DataFrame, text: str = "text", column: str = "fp", keep=None, shingle: int = 4) -> DataFrame:
    """``docs`` with the 64 fingerprint bits as a long."""

    def make():
        return lambda texts: [pa.array(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))]

    return add_columns(docs, text, make, T.StructType([T.StructField(column, T.LongType())]), keep)


# --- vantage-point trees ------------------------------------------------------


@dataclass(frozen=True)
class Node:
    """Inner up to ``mu`` bits from ``vantage``; a leaf has a number instead."""

    leaf: int = -1
    vantage: int = 0
    mu: int = 0
    inner: Node | None = None
    outer: Node | None = None


def _sides(values: np.ndarray, vantage: int, mu: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Which values the inner and the outer side need; boundary values both."""
    distance = np.bitwise_count(values ^ np.uint64(vantage)).astype(np.int64)
    return distance <= mu, distance > mu - radius


def best_split(values: np.ndarray, radius: int, rng: np.random.Generator) -> tuple[int, int] | None:
    """Vantage point and median distance whose larger side is smallest; None if none divides."""
    best, chosen = 0.9 * len(values), None
    for vantage in rng.choice(values, min(6, len(values)), replace=False):
        distance = np.bitwise_count(values ^ vantage).astype(np.int64)
        middle = int(np.median(distance))
        for mu in (middle - 1, middle):
            larger = max((distance <= mu).sum(), (distance > mu - radius).sum())
            if larger < best:
                best, chosen = larger, (int(vantage), mu)
    return chosen


def grow(values: np.ndarray, stand_for: float, radius: int, leaf: int, rng: np.random.Generator, leaves: list[int]) -> Node:
    """A tree over sampled values, each standing for so many; ``leaves`` counts leaf numbers."""
    split = best_split(values, radius, rng) if len(values) >= 16 and len(values) * stand_for > leaf else None
    if split is None:
        leaves.append(len(leaves))
        return Node(leaf=leaves[-1])
    inner, outer = _sides(values, *split, radius)
    return Node(
        -1, *split, grow(values[inner], stand_for, radius, leaf, rng, leaves), grow(values[outer], stand_for, radius, leaf, rng, leaves)
    )


def route(node: Node, values: np.ndarray, rows: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """Leaf number and the rows that belong to it; a row may be in several leaves."""
    if node.leaf >= 0:
        yield node.leaf, rows
    elif len(rows):
        inner, outer = _sides(values[rows], node.vantage, node.mu, radius)
        yield from route(node.inner, values, rows[inner], radius)
        yield from route(node.outer, values, rows[outer], radius)


def stretch(values: np.ndarray, part: int, parts: int) -> np.ndarray:
    """One of ``parts`` stretches of the 64 bits."""
    low, high = 64 * part // parts, 64 * (part + 1) // parts
    return (values >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)


# --- links within a leaf ------------------------------------------------------


def _close(some: np.ndarray, others: np.ndarray, radius: int) -> Iterator[tuple[slice, np.ndarray]]:
    """Closeness of all pairs, a bounded block of rows at a time."""
    step = max(1, (1 << 20) // max(1, len(others)))
    for start in range(0, len(some), step):
        rows = slice(start, start + step)
        yield rows, np.bitwise_count(some[rows, None] ^ others[None, :]) <= radius


def forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """(value, root) of every distinct value that has a link, except the roots."""
    partners = np.zeros(len(values), np.int64)
    for rows, close in _close(values, values, radius):
        partners[rows] = close.sum(axis=1)
    left, edges = values[partners > 1], []
    while len(left):
        root, frontier, left = left[0], left[:1], left[1:]
        while len(frontier) and len(left):
            near = np.zeros(len(left), bool)
            for _, close in _close(frontier, left, radius):
                near |= close.any(axis=0)
            frontier, left = left[near], left[~near]
            edges += [(int(v), int(root)) for v in frontier]
    return edges


def leaf_links(values: np.ndarray, part: int, settings: SimHashSettings, rng: np.random.Generator) -> list[tuple[int, int]]:
    """Spanning links of a leaf: the tree goes on inside it while vantage points divide it."""
    near, edges, open_parts = settings.radius // settings.parts, [], [values]
    while open_parts:
        values = open_parts.pop()
        own = stretch(values, part, settings.parts)
        split = best_split(own, near, rng) if len(values) > 1_024 else None
        if split is None:
            edges += forest(values, settings.radius)
        else:
            open_parts += [values[side] for side in _sides(own, *split, near)]
    return edges


# --- the operator -------------------------------------------------------------


def _trees(prints: DataFrame, settings: SimHashSettings, total: int) -> list[Node]:
    """A tree per stretch, learnt on a bounded sample of distinct fingerprints."""
    wanted = min(settings.sample, max(4_096, total // 200))
    share = min(1 << 30, int((1 << 30) * wanted / max(1, total)))
    sampled = prints.filter(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < share).toPandas()["fp"]
    values = np.sort(sampled.to_numpy(np.int64)).view(np.uint64)
    trees = []
    for part in range(settings.parts):
        rng, own = np.random.default_rng(part), stretch(values, part, settings.parts)
        trees.append(grow(own, total / max(1, len(values)), settings.radius // settings.parts, settings.leaf, rng, []))
    return trees


def _deal(prints: DataFrame, trees: list[Node], settings: SimHashSettings, blocks: dict[tuple[int, int], int] | None) -> DataFrame:
    """(part, leaf, a, b, fp) of each leaf a fingerprint visits; without blocks only (part, leaf, n)."""
    near = settings.radius // settings.parts

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            found = [(0, 0, 0)]  # so that no batch is without a row
            for part, tree in enumerate(trees):
                own = stretch(values, part, settings.parts)
                found += [(part, leaf, len(rows)) for leaf, rows in route(tree, own, np.arange(len(own)), near)]
            parts, leaves, sizes = (np.array(x, np.int64) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(parts), pa.array(leaves), pa.array(sizes)], ["part", "leaf", "n"])

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = batch.column(0).to_numpy()
            values = signed.view(np.uint64)
            for part, tree in enumerate(trees):
                own = stretch(values, part, settings.parts)
                for leaf, rows in route(tree, own, np.arange(len(own)), near):
                    cut = blocks.get((part, leaf), 1)
                    block = xxhash_mix(values[rows]) % np.uint64(cut)
                    for other in range(cut):
                        first, second = np.minimum(block, other), np.maximum(block, other)
                        columns = [np.full(len(rows), part), np.full(len(rows), leaf), first.astype(np.int64), second.astype(np.int64), signed[rows]]
                        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["part", "leaf", "a", "b", "fp"])

    if blocks is None:
        return prints.select("fp").mapInArrow(counted, "part long, leaf long, n long")
    return prints.select("fp").mapInArrow(dealt, "part long, leaf long, a long, b long, fp long")


def xxhash_mix(values: np.ndarray) -> np.ndarray:
    """Spread of fingerprints over blocks, whatever bits they share."""
    mixed = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return mixed >> np.uint64(33)


def links(prints: DataFrame, settings: SimHashSettings = SimHashSettings()) -> DataFrame:
    """Links (fp, root) that connect what is connected, from distinct fingerprints ``fp``."""
    total = prints.count()
    trees = _trees(prints, settings, total)
    sizes = _deal(prints, trees, settings, None).groupBy("part", "leaf").agg(F.sum("n").alias("n"))
    # bounded: a row per leaf that holds more than the limit, of trees grown on a bounded sample
    large = {(r["part"], r["leaf"]): math.ceil(2 * r["n"] / settings.leaf_limit) for r in sizes.filter(F.col("n") > settings.leaf_limit).collect()}
    shards = _deal(prints, trees, settings, large)

    def join_leaf(key, group):
        values = np.unique(group.column("fp").to_numpy()).view(np.uint64)
        edges = leaf_links(values, key[0].as_py(), settings, np.random.default_rng(0))
        pairs = np.unique(np.array(edges, np.uint64).reshape(-1, 2), axis=0).view(np.int64)
        return pa.table({"u": pairs[:, 0], "v": pairs[:, 1]}, schema=pa.schema([("u", pa.int64()), ("v", pa.int64())]))

    return shards.groupBy("part", "leaf", "a", "b").applyInArrow(join_leaf, "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(v, root): the smallest vertex of each linked vertex's component, by star contraction.

    A round gives every vertex the smallest neighbour of its larger, then of
    its smaller neighbours; it ends when a round changes nothing.
    """

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        if large:
            around = pairs.union(pairs.select("v", "u")).toDF("u", "v")
        else:
            around = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = around.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        joined = around.join(least, around["u"] == least["k"])
        if large:
            return joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        found = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
        return found.union(least.select(F.col("k").alias("u"), F.col("m").alias("v"))).filter("u != v").distinct()

    def state(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)))).first())

    edges = stage(edges.filter("u != v"), "links")
    known = state(edges)
    while True:
        edges = stage(star(star(edges, True), False), "stars")
        now = state(edges)
        if now == known:
            return edges.select(F.col("u").alias("v"), F.col("v").alias("root"))
        known = now


def classes(docs: DataFrame, key: str, text: str, settings: SimHashSettings) -> tuple[DataFrame, DataFrame]:
    """Rows (key, fp), and for each distinct fp its root and component_id; both written."""
    own = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    rows = stage(with_fingerprints(own, "text", keep=["key"], shingle=settings.shingle), "fingerprints")
    prints = stage(rows.groupBy("fp").agg(F.min("key").alias("least")), "distinct_fingerprints")
    roots = components(links(prints, settings))
    placed = prints.join(roots, prints["fp"] == roots["v"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = placed.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "of")
    found = placed.join(named, placed["root"] == named["of"]).select(F.col("fp").alias("print"), "root", "component_id")
    return rows, stage(found, "classes")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", settings: SimHashSettings = SimHashSettings()
) -> DataFrame:
    """(key, fp, component_id) of each row of ``docs``; component_id is the smallest key reached over links."""
    rows, placed = classes(docs, key, text, settings)
    found = rows.join(placed, rows["fp"] == placed["print"])
    return found.select(F.col("key").alias(key), "fp", "component_id")


def keep_one_each(
    docs: DataFrame, key: str = "doc_id", text: str = "text", settings: SimHashSettings = SimHashSettings()
) -> DataFrame:
    """One document of each component, with its own columns: that with the smallest key.

    Of several rows with that key, and of the rows of a component without any
    key, the one with the smallest hash stays.
    """
    rows, placed = classes(docs, key, text, settings)
    named = rows.join(placed, rows["fp"] == placed["print"]).filter(F.col("key") == F.col("component_id"))
    named = named.groupBy("key").agg(F.count("*").alias("_copies")).withColumnRenamed("key", "_id")
    kept, own = docs.join(named, F.col(f"`{key}`") == F.col("_id")), columns_of(docs)
    single = kept.filter("_copies = 1").select(*own)
    # few rows: repeated keys, and rows without key
    several = kept.filter("_copies > 1").select(*own).unionByName(docs.filter(F.col(f"`{key}`").isNull()))
    several = with_fingerprints(several, text, "_fp", shingle=settings.shingle)
    placed = placed.toDF("_print", "_root", "_component")
    several = several.join(placed, (F.col("_fp") == F.col("_print")) & F.col("_component").eqNullSafe(F.col(f"`{key}`")))
    ranked = several.withColumn("_rank", F.row_number().over(Window.partitionBy("_root").orderBy(F.xxhash64(*own))))
    return single.unionByName(ranked.filter("_rank = 1").select(*own))
