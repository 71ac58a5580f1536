import random
import re
from collections import Counter

import pytest

from profitlens.llm import language, queries
from tests.llm.odd import documents, nothing


def plain_counts(text):
    """N-grams of one to three characters, '_' for boundaries."""
    line = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else "_" for c in text)
    line = "_" + re.sub("_+", "_", line).strip("_") + "_"
    grams = Counter(line[i : i + n] for n in (1, 2, 3) for i in range(len(line) - n + 1))
    return Counter({g: n for g, n in grams.items() if g not in ("_", "__") and "_" not in g[1:-1]}) if line != "__" else Counter()


def spelt(code):
    low = (1 << 21) - 1
    if code < 0:
        parts = [(-code - 1) >> 42, ((-code - 1) >> 21) & low, (-code - 1) & low]
    elif code >> 62:
        parts = [(code & ~(1 << 62)) >> 21, code & low]
    else:
        parts = [code]
    return "".join("_" if p == 0 else chr(p) for p in parts)


@pytest.mark.parametrize("chunk", [1 << 20, 5, 7])
def test_ngrams(chunk):
    random.seed(0)
    for _ in range(200):
        text = "".join(random.choice("abcé Z.\n12ßİ\U0001d4d0") for _ in range(random.randint(0, 60)))
        codes, counts = language.ngram_counts(text.encode(), chunk)
        assert {spelt(int(c)): int(n) for c, n in zip(codes, counts, strict=True)} == plain_counts(text)


def test_out_of_place_distance():
    codes, counts = language.ngram_counts(b"the cat the")
    ranked = language.top(codes, counts, 10)
    profile = language.top(*language.ngram_counts(b"the the dog"), 10)
    order = sorted((int(c), r) for r, c in enumerate(profile))
    import numpy as np

    profiles = language.Profiles(["x"], [np.array([c for c, _ in order])], [np.array([r for _, r in order])], 10)
    place = {int(c): r for r, c in enumerate(profile)}
    assert profiles.distance(ranked, 0) == sum(abs(r - place[int(c)]) if int(c) in place else 10 for r, c in enumerate(ranked))


def test_held_out_documents(spark):
    found = queries.op7_language(spark, "/root/testdata/sf0.01")
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang")
    rows = found.join(docs, "doc_id").filter("held_out").collect()
    assert len(rows) > 200
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.98
    assert all(0.0 <= r["score"] <= 1.0 for r in rows)


def test_odd_rows(spark):
    docs = documents(spark)
    profiles = language.learn(docs, "doc_id", "text", "lang")
    rows = language.identify(docs, profiles).collect()
    assert len(rows) == 11
    assert {(r["lang_pred"], r["score"]) for r in rows if r["doc_id"] in (2, 3, 7)} == {("und", 0.0)}
    assert {r["lang_pred"] for r in rows if r["doc_id"] == 4} == {"en"}


def test_empty_tables(spark):
    profiles = language.learn(nothing(spark), "doc_id", "text", "lang")
    assert {r["lang_pred"] for r in language.identify(documents(spark), profiles).collect()} == {"und"}
    assert language.identify(nothing(spark), profiles).count() == 0
