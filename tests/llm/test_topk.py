import math
import random

import pytest

from profitlens.llm import topk

SCHEMA = "vec_id long, embedding array<float>, key string, x string, norm double"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", "x", 0.0) for r in rows], SCHEMA).repartition(3)


def plain(rows, divisor, k, scale=256):
    whole = []
    for key, v in rows:
        if key is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.append((key, [math.floor(scale * x) for x in v]))
    queries = {}
    for key, v in whole:
        if key % divisor == 0 and (key not in queries or v < queries[key]):
            queries[key] = v
    found = []
    for q, v in queries.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), c) for c, w in whole if c != q and len(w) == len(v))
        found += [(q, rank, c, -s) for rank, (s, c) in enumerate(scores[:k], 1)]
    return sorted(found)


def single(x):
    import struct

    return struct.unpack("f", struct.pack("f", x))[0]


@pytest.mark.parametrize("settings", [
    topk.SearchSettings(), topk.SearchSettings(k=3, query_block=4, head=5, sample=3, batch=16), topk.SearchSettings(k=1000),
])
def test_against_all_products(spark, settings):
    random.seed(4)
    rows = [(i, [single(random.gauss(0, random.choice([0.1, 1, 3]))) for _ in range(9)]) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(60)]  # ties
    found = topk.search(frame(spark, rows), "vec_id % 20 = 0", settings=settings).collect()
    assert sorted(tuple(r) for r in found) == plain(rows, 20, settings.k)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (1, [0.5, -1.0]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0]), (8, []), (10, []),
        (7, [0.0, 0.0]), (None, [1.0, 1.0]), (9, [2.0, 2.0]), (9, [2.0, 2.0]), (20, [-1.0, -1.0]), (20, [-1.0, -1.0]),
    ]
    found = topk.search(frame(spark, rows), "vec_id % 10 = 0").collect()
    assert sorted(tuple(r) for r in found) == plain(rows, 10, 5)
    huge = [(0, [3e38, 3e38]), (1, [3e38, 3e38]), (2, [-3e38, 3e38])]
    best = topk.search(frame(spark, huge), "vec_id = 0").collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in best][0] == (1, 1, (1 << 63) - 1)


def test_pruning_still_multiplies_little():
    import numpy as np

    rng = np.random.default_rng(0)
    vectors = np.floor(256 * rng.normal(size=(4000, 16)) * np.array([8.0] * 2 + [0.2] * 14))
    searcher = topk.Searcher(np.arange(5), vectors[:5], topk.rotation(vectors[:500]), 5)
    searcher.offer(np.arange(4000), vectors)
    for q in range(5):
        scores = sorted((-int(vectors[q] @ v), i) for i, v in enumerate(vectors) if i != q)[:5]
        assert searcher.best[q] == scores


def test_empty_table(spark):
    assert topk.search(frame(spark, []), "vec_id % 50 = 0").count() == 0
