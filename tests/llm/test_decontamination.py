import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from profitlens.llm import decontamination as dc
from profitlens.llm.text import words
from tests.llm.odd import documents, nothing


def plain(text, items, window):
    """Words, hit positions and matched items, comparing every window with every place."""
    own, hit, matched = words((text or "").encode()), set(), set()
    for item, phrase in items:
        wanted = words((phrase or "").encode())
        n = min(window, len(wanted))
        for s in range(len(wanted) - n + 1 if n else 0):
            for p in range(len(own) - n + 1):
                if own[p : p + n] == wanted[s : s + n]:
                    hit.update(range(p, p + n))
                    matched.add("" if item is None else str(item))
    return len(own), hit, sorted(matched)


def random_tables(seed):
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(random.choice([2, 5, 30]))]
    items = [(k, " ".join(random.choices(vocabulary, k=random.randint(0, 30)))) for k in range(8)]
    items += [(3, items[0][1]), (None, "W1 w2"), (9, None)]
    docs = []
    for i in range(25):
        text = random.choices([*vocabulary, "other"], k=random.randint(0, 60))
        if random.random() < 0.6:
            source = (random.choice(items)[1] or "").split()
            text[4:4] = source[random.randint(0, 5) :]
        docs.append((i, " ".join(text), "en", "a"))
    return docs + docs[:4] + [(90, None, "en", "a"), (91, "", "en", "a")], items


@pytest.mark.parametrize("seed", range(12))
@pytest.mark.parametrize("window", [1, 4, 13])
def test_shard_against_every_place(seed, window):
    docs, items = random_tables(seed)
    phrases = dc.phrases_of([("" if k is None else str(k), t and t.encode()) for k, t in items], window)
    sizes, spans, matched = dc.scan_shard([t if t is None else t.encode() for _, t, _, _ in docs], phrases, 4)
    for (_, text, _, _), size, own, found in zip(docs, sizes, spans, matched, strict=True):
        assert (size, {x for a, b in own for x in range(a, b)}, sorted(found)) == plain(text, items, window)
        assert all(a[1] < b[0] for a, b in zip(own, own[1:]))


def test_suffix_order():
    rng = np.random.default_rng(5)
    for _ in range(40):
        strings = [list(rng.integers(1, 4, rng.integers(0, 12))) for _ in range(6)]
        symbols = np.array([x for s in strings for x in [*s, 0]])
        ends = symbols == 0
        number = np.cumsum(ends) - ends
        suffixes = []
        for i in range(len(symbols)):
            stop = i + int(np.argmax(ends[i:]))
            suffixes.append(([(1, x) for x in symbols[i:stop]] + [(0, number[i])], i))
        assert list(dc.suffix_order(symbols, ends)) == [i for _, i in sorted(suffixes)]


def test_ranks():
    rng = np.random.default_rng(1)
    sequence = rng.integers(0, 11, 700)
    tree = dc.WaveletTree(sequence, 4)
    symbols, ends = rng.integers(0, 11, 300), rng.integers(0, 701, 300)
    assert list(tree.rank(symbols, ends)) == [int((sequence[:e] == s).sum()) for s, e in zip(symbols, ends, strict=True)]


@pytest.mark.parametrize("settings", [
    dc.ScanSettings(), dc.ScanSettings(window=3, shard_words=20), dc.ScanSettings(window=5, block_words=40, sample_every=3),
])
def test_blocks_and_shards_change_nothing(spark, settings):
    rows, items = random_tables(99)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    if settings.block_words == 40:
        assert dc._block_count(benchmark, "text", settings) > 1
    found = dc.contamination(documents(spark, rows), benchmark, keep=["doc_id", "text"], settings=settings).collect()
    assert len(found) == len(rows)
    for r in found:
        size, hit, matched = plain(r["text"], items, settings.window)
        got = {x for a, b in r["removal_spans"] for x in range(a, b)}
        assert (r["n_words"], got, r["matched_items"]) == (size, hit, matched)


def test_spans_are_cut_and_contaminated_documents_go(spark):
    passage = " ".join(f"p{i}" for i in range(13))
    filler = " ".join(f"f{i}" for i in range(400))
    rows = [(1, f"Aé. {passage.upper()}, end.", "en", "a"), (2, f"{filler}. {passage}! ünd", "en", "a"), (3, filler, "en", "a"), (4, None, "en", "a")]
    benchmark = spark.createDataFrame([(1, passage)], "item_id long, text string")
    docs = documents(spark, rows)
    kept = dc.decontaminate(docs, benchmark)
    assert kept.schema == docs.schema
    texts = {r["doc_id"]: r for r in kept.collect()}
    assert set(texts) == {2, 3, 4}
    assert texts[2]["text"] == f"{filler}. ! ünd" and texts[2]["n_chars"] == len(texts[2]["text"])
    assert texts[3]["text"] == filler and texts[4]["text"] is None and texts[2]["N_WORDS"] == 1


def test_odd_rows(spark):
    benchmark = spark.createDataFrame([(1, "lazy dog near the river bank"), (2, None)], "item_id long, text string")
    rows = dc.contamination(documents(spark), benchmark).collect()
    assert sorted(str(r["doc_id"]) for r in rows if r["matched_items"]) == ["1", "5"]
    assert {len(r["removal_spans"]) for r in rows if not r["text"]} == {0}
    assert dc.contamination(nothing(spark), benchmark).count() == 0
    unmarked = dc.contamination(documents(spark), benchmark.filter(F.lit(False))).collect()
    assert len(unmarked) == 11 and not any(r["matched_items"] for r in unmarked)
