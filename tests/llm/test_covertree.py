import math
import random

import numpy as np
import pytest

from profitlens.llm import covertree

SCHEMA = "vec_id long, embedding array<float>, label int, `key` string, x string, shard string, norm double"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", "x", "s", 0.0) for r in rows], SCHEMA).repartition(3)


def plain(rows, divisor, settings):
    """Every anchor against every row."""
    whole = []
    for key, v, label in rows:
        if None not in (key, v, label) and all(x is not None and math.isfinite(x) for x in v):
            whole.append((key, label, [math.floor(settings.scale * x) for x in v]))
    anchors = {}
    for key, label, v in whole:
        if key % divisor == 0:
            anchors[key] = min(anchors.get(key, (label, v)), (label, v))
    found = []
    for a, (label, v) in anchors.items():
        scored = sorted((-sum(p * q for p, q in zip(v, w, strict=True)), c, g == label) for c, g, w in whole if c != a and len(w) == len(v))
        positives = [(c, -s) for s, c, same in scored if same][: settings.positives]
        for positive, ps in positives:
            window = [(c, -s) for s, c, same in scored if not same and settings.low * ps <= -100 * s <= settings.high * ps]
            found += [(a, positive, rank, c, ps, s) for rank, (c, s) in enumerate(window[: settings.negatives], 1)]
    return sorted(found)


def single(x):
    return float(np.float32(x))


def clustered(n, dims, seed):
    random.seed(seed)
    middles = [[random.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    return [(i, [single(m + random.gauss(0, 0.4)) for m in random.choice(middles)], random.randrange(4)) for i in range(n)]


@pytest.mark.parametrize("settings", [
    covertree.MiningSettings(),
    covertree.MiningSettings(positives=2, negatives=3, sample=20, pivots=3, shard_bytes=2_000, leaf=4, block=5),
    covertree.MiningSettings(low=-50, high=120, negatives=400, shard_bytes=4_000, leaf=8, block=7),
])
def test_against_all_products(spark, settings):
    rows = clustered(400, 7, 1)
    rows += [(400 + i, rows[10][1], i % 3) for i in range(80)]  # a large group of copies: ties
    found = covertree.mine(frame(spark, rows), "vec_id % 20 = 0", settings=settings)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, found.collect())) == plain(rows, 20, settings)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 1), (1, [0.5, 1.0], 1), (2, None, 1), (3, [1.0, None], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [1.0], 1),
        (8, [], 1), (10, [], 1), (20, [], 2), (7, [0.0, 0.0], 2), (None, [1.0, 1.0], 2), (9, [1.0, 0.5], 2), (9, [1.0, 0.5], 2),
        (11, [0.4, 0.4], None), (30, [0.0, 0.0], 1), (40, [-1.0, -1.0], 2), (12, [0.25, 0.5], 3), (50, [0.3, 0.1], 7), (50, [0.3, 0.1], 7),
    ]
    settings = covertree.MiningSettings(leaf=2)
    found = covertree.mine(frame(spark, rows), "vec_id % 10 = 0", settings=settings)
    assert sorted(map(tuple, found.collect())) == plain(rows, 10, settings)
    assert covertree.mine(frame(spark, []), "vec_id % 10 = 0").count() == 0
    assert covertree.mine(frame(spark, rows[1:2]), "vec_id % 10 = 0").count() == 0


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(2)
    middles = rng.normal(size=(40, 16)) * 300
    vectors = np.floor(middles[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 16)) * 10)
    largest = float(np.sqrt((vectors * vectors).sum(axis=1)).max())
    tree = covertree.build(np.arange(4000), np.zeros(4000, np.int64), vectors, largest, 32, 1.3)
    leaves = tree.leaves()
    assert sorted(tree.keys.tolist()) == list(range(4000))
    assert sum((tree.ends - tree.starts)[leaves]) == 4000
    low, high = covertree.bounds(tree, vectors[:50], largest)
    products = vectors[:50] @ tree.vectors.T
    for leaf in leaves.tolist():
        own = products[:, tree.starts[leaf] : tree.ends[leaf]]
        assert (own <= high[:, [leaf]]).all() and (own >= low[:, [leaf]]).all()
    anchors = [covertree.Anchor(-1, 0, v, [0], [covertree.Wanted(5, covertree.LOWEST, -covertree.LOWEST)]) for v in vectors[:50]]
    looked = []
    offer = covertree.Wanted.offer
    try:
        covertree.Wanted.offer = lambda self, scores, keys: (looked.append(len(scores)), offer(self, scores, keys))[1]
        covertree.search(tree, anchors, largest, True)
    finally:
        covertree.Wanted.offer = offer
    assert sum(looked) < 50 * 4000 / 3  # most leaves are skipped
    for anchor, row in zip(anchors, vectors[:50] @ vectors.T, strict=True):
        assert anchor.wanted[0].best == sorted((-int(s), i) for i, s in enumerate(row))[:5]
