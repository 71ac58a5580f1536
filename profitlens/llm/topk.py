"""Exact top-k search by inner product, in integers.

Vectors become whole numbers floor(scale * x). They are ordered by descending
length; queries and vectors are turned by a rotation from the singular value
decomposition of a bounded sample, which gathers most of the length in the
first coordinates. A vector can beat a query's k-th best score only if its
length times the query's does; the sum over the first rotated coordinates plus
the product of what is left of both lengths (Cauchy-Schwarz) bounds it closer;
survivors are multiplied in full, in integers.

Queries are searched in blocks of ``query_block``, each sent to all tasks that
hold vectors. A block's first thresholds come from the ``head`` longest vectors;
tasks then raise their own as they go, and return what is not below them.
Nothing is cut by a cap: the k best of a query are taken from all returned rows.

Edge cases: vectors that are null or hold null, NaN or infinite components take
no part, neither do rows without key as queries; a query never meets rows of
its own key; vectors of another length are not comparable and never meet;
of several query rows with one key the smallest vector is searched, repeated
candidates count as rows; equal scores go to the smaller key; components and
scores beyond a long stop at its limits; fewer than k candidates return all; an empty
vector scores 0 with other empty ones; empty tables return nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profitlens.session import stage

EXACT = float(1 << 52)
LARGEST = (1 << 63) - 1


@dataclass(frozen=True)
class SearchSettings:
    """``sample`` bounds the rows the rotation is learnt on, ``head`` those that give first thresholds."""

    k: int = 5
    scale: int = 256
    query_block: int = 16_384
    head: int = 4_096
    sample: int = 4_096
    batch: int = 2_048


def integer_vectors(rows: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(key, x, norm): components floor(scale * x), of rows whose components are all finite."""
    own = rows.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{vector}`").alias("v")).filter("v is not null")
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    whole = own.filter(finite).select("key", F.transform("v", lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("x"))
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda total, x: total + x * x))
    return whole.select("key", "x", norm.alias("norm"))


def rotation(vectors: np.ndarray) -> np.ndarray:
    """Columns are the right singular vectors, strongest first: a full orthogonal basis."""
    return np.linalg.svd(vectors.T @ vectors)[0] if vectors.size else np.eye(vectors.shape[1])


def exact_products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products as integers; in floating point where it is exact."""
    if not len(queries) or not len(vectors):
        return np.zeros((len(queries), len(vectors)), np.int64)
    most = np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * max(1, queries.shape[1])
    if most < EXACT:
        return (queries @ vectors.T).astype(np.int64)
    return np.array([[sum(int(a) * int(b) for a, b in zip(q, v, strict=True)) for v in vectors.tolist()] for q in queries.tolist()], dtype=object)


class Searcher:
    """Queries of one number of dimensions, rotated, with the thresholds they have reached."""

    def __init__(self, keys: np.ndarray, queries: np.ndarray, turn: np.ndarray, k: int):
        self.keys, self.queries, self.turn, self.k = keys, queries, turn, k
        self.first = max(1, queries.shape[1] // 4) if queries.shape[1] else 0
        turned = queries @ turn
        self.lead = turned[:, : self.first]
        self.norms = np.sqrt((queries * queries).sum(axis=1))
        self.rest = np.sqrt(np.maximum(0.0, (turned[:, self.first :] ** 2).sum(axis=1)))
        self.best: list[list[tuple[int, int]]] = [[] for _ in keys]  # (-score, key), k at most
        self.threshold = np.full(len(keys), -np.inf)

    def offer(self, keys: np.ndarray, vectors: np.ndarray) -> None:
        """Take in vectors, longest first; each step drops pairs whose bound stays below the threshold."""
        norms = np.sqrt((vectors * vectors).sum(axis=1))
        order = np.argsort(-norms, kind="stable")
        for start in range(0, len(order), 512):
            rows = order[start : start + 512]
            # rounding of a product is far below this share of the two lengths
            slack = 1e-9 * self.norms * norms[rows[0]] + 1e-6
            open_queries = np.flatnonzero(self.norms * norms[rows[0]] + slack >= self.threshold)
            if not len(open_queries):
                break  # the vectors that follow are shorter still
            turned = vectors[rows] @ self.turn
            rest = np.sqrt(np.maximum(0.0, (turned[:, self.first :] ** 2).sum(axis=1)))
            bound = self.lead[open_queries] @ turned[:, : self.first].T + self.rest[open_queries, None] * rest[None, :]
            alive = bound + slack[open_queries, None] >= self.threshold[open_queries, None]
            hit = np.flatnonzero(alive.any(axis=1))
            if not len(hit):
                continue
            chosen = open_queries[hit]
            scores = exact_products(self.queries[chosen], vectors[rows])
            for i, query in enumerate(chosen.tolist()):
                self._keep(query, keys[rows], scores[i], alive[hit[i]])

    def _keep(self, query: int, keys: np.ndarray, scores: np.ndarray, alive: np.ndarray) -> None:
        good = np.flatnonzero(alive & (scores >= self.threshold[query]) & (keys != self.keys[query]))
        if not len(good):
            return
        found = self.best[query] + [(-max(-LARGEST, min(LARGEST, int(scores[j]))), int(keys[j])) for j in good.tolist()]
        self.best[query] = sorted(found)[: self.k]
        if len(self.best[query]) == self.k:
            self.threshold[query] = max(self.threshold[query], -self.best[query][-1][0])


def _groups(keys: list[int], vectors: list[list[float]]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Keys and matrix of the vectors of each number of dimensions."""
    found: dict[int, list[int]] = {}
    for i, v in enumerate(vectors):
        found.setdefault(len(v), []).append(i)
    return {n: (np.array([keys[i] for i in at], np.int64), np.array([vectors[i] for i in at], float).reshape(len(at), n)) for n, at in found.items()}


def _collected(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    held = rows.collect()
    return _groups([r["key"] for r in held], [r["x"] for r in held])


def search(
    vectors: DataFrame, is_query: str, key: str = "vec_id", vector: str = "embedding", settings: SearchSettings = SearchSettings()
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each row that the SQL condition picks by ``key``."""
    k = settings.k
    whole = integer_vectors(vectors, key, vector, settings.scale).filter("key is not null")
    whole = stage(whole.repartitionByRange(F.desc("norm"), "key").sortWithinPartitions(F.desc("norm"), "key"), "vectors_by_length")
    queries = whole.withColumnRenamed("key", key).filter(is_query).withColumnRenamed(key, "key")
    queries = stage(queries.groupBy("key").agg(F.min("x").alias("x")), "search_queries")
    blocks = max(1, math.ceil(queries.count() / settings.query_block))
    head = _collected(whole.orderBy(F.desc("norm"), "key").limit(settings.head).select("key", "x"))
    sample = _collected(whole.orderBy(F.xxhash64("key")).limit(settings.sample).select("key", "x"))
    turns = {dims: rotation(rows) for dims, (_, rows) in sample.items()}
    results = []
    for block in range(blocks):
        own = _collected(queries.filter(F.pmod(F.xxhash64("key"), F.lit(blocks)) == block).select("key", "x"))
        results.append(stage(_search_block(whole, own, head, turns, settings), "search_block"))
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("vec_id").alias(key), F.col("score").cast("long").alias("score"))


def _search_block(whole: DataFrame, queries: dict, head: dict, turns: dict, settings: SearchSettings) -> DataFrame:
    """The best candidates that each task finds for the queries of one block."""
    thresholds = {}
    for dims, (keys, rows) in queries.items():
        turns.setdefault(dims, np.eye(dims))
        searcher = Searcher(keys, rows, turns[dims], settings.k)
        if dims in head:
            searcher.offer(*head[dims])
        thresholds[dims] = searcher.threshold
    turns = {dims: turns[dims] for dims in queries}
    k, size = settings.k, settings.batch

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searchers = {}
        for dims, (keys, rows) in queries.items():
            searchers[dims] = Searcher(keys, rows, turns[dims], k)
            searchers[dims].threshold = thresholds[dims].copy()
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                for dims, (keys, rows) in _groups(part.column(0).to_pylist(), part.column(1).to_pylist()).items():
                    if dims in searchers:
                        searchers[dims].offer(keys, rows)
        for searcher in searchers.values():
            rows = [(int(q), vec, -score) for q, best in zip(searcher.keys, searcher.best, strict=True) for score, vec in best]
            columns = list(zip(*rows, strict=True)) if rows else [(), (), ()]
            arrays = [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["query_id", "vec_id", "score"])

    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("query_id", "vec_id", "score")])
    return whole.select("key", "x").mapInArrow(run, schema)
