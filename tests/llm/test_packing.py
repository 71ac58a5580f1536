import random

import pytest

from profitlens.llm import packing
from tests.llm.odd import documents, nothing


def plain_best_fit(lengths, sources, clusters, capacity):
    """Looks at every bin each time."""
    bins, placed = [], []
    for length, source, cluster in zip(lengths, sources, clusters, strict=True):
        fitting = [
            (rest, i) for i, (rest, ss, cs) in enumerate(bins)
            if rest >= length and (source is None or source not in ss) and (cluster is None or cluster not in cs)
        ]
        if fitting:
            rest, i = min(fitting)
        else:
            rest, i = capacity, len(bins)
            bins.append((capacity, set(), set()))
        bins[i] = (rest - length, bins[i][1] | {source}, bins[i][2] | {cluster})
        placed.append((i, capacity - rest))
    return placed


@pytest.mark.parametrize("seed", range(20))
def test_tightest_compatible_bin(seed):
    random.seed(seed)
    n = random.randint(0, 120)
    lengths = sorted((random.randint(0, 40) for _ in range(n)), reverse=True)
    sources = [random.choice([None, "hot", "hot", "b", "c", "d"]) for _ in range(n)]
    clusters = [random.choice([None, *range(20)]) for _ in range(n)]
    assert list(zip(*packing.best_fit(lengths, sources, clusters, 50), strict=True)) == plain_best_fit(lengths, sources, clusters, 50)


def check_bins(rows, texts, capacity):
    """Every word of every document once, no bin too full, none with two documents of a source or copies of a text."""
    bins, found = {}, {}
    for r in rows:
        bins.setdefault(r["bin_id"], []).append(r)
        found.setdefault(r["doc_id"], []).append(r)
    for held in bins.values():
        held.sort(key=lambda r: r["bin_start"])
        assert sum(r["words"] for r in held) == held[0]["bin_words"] <= capacity
        assert len(held) == held[0]["bin_pieces"]
        at = 0
        for r in held:
            assert r["bin_start"] == at
            at += r["words"]
        named = [texts[r["doc_id"]][1] for r in held if texts[r["doc_id"]][1] is not None]
        copies = [texts[r["doc_id"]][0] for r in held if texts[r["doc_id"]][0]]
        assert len(named) == len(set(named)) and len(copies) == len(set(copies))
    for doc, pieces in found.items():
        size = len((texts[doc][0] or "").encode().split())
        pieces.sort(key=lambda r: r["first_word"])
        assert [r["piece"] for r in pieces] == list(range(pieces[0]["n_pieces"]))
        assert sum(r["words"] for r in pieces) == size
    assert set(found) == set(texts)


def test_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    texts = {r["doc_id"]: (r["text"], r["source"]) for r in docs.collect()}
    for settings in (packing.PackSettings(), packing.PackSettings(capacity=100, group=64)):
        check_bins(packing.pack(docs, settings=settings).collect(), texts, settings.capacity)


def test_odd_rows(spark):
    rows = packing.pack(documents(spark), settings=packing.PackSettings(capacity=1000)).collect()
    assert sum(r["doc_id"] is None for r in rows) == 2
    assert {r["words"] for r in rows if r["doc_id"] in (2, 3)} == {0}
    assert sum(r["words"] for r in rows if r["doc_id"] == 4) == 2 * 120_000
    named = packing.pack(documents(spark), cluster="lang").collect()
    assert len({r["bin_id"] for r in named if r["doc_id"] in (7, 8)}) == 2


def test_empty_table(spark):
    assert packing.pack(nothing(spark)).count() == 0


def test_groups_do_not_depend_on_the_shuffle_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    before, bins = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for partitions in (2, 200):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            rows = packing.pack(docs).collect()
            assert len(rows) < packing.PackSettings().group
            bins.append(len({r["bin_id"] for r in rows}))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert bins[0] == bins[1] and len({r["bin_id"][:13] for r in rows}) == 1
