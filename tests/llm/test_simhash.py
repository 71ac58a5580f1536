import random
import re

import numpy as np
import pytest
import xxhash

from profitlens.llm import simhash
from tests.llm.odd import documents, nothing


def plain_print(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    own = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(own[i : i + 4]) for i in range(max(1, len(own) - 3))] if own else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs, radius=4):
    """Smallest key reached from each row, comparing all pairs."""
    parent = list(range(len(pairs)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, (_, a) in enumerate(pairs):
        for j in range(i):
            if (a ^ pairs[j][1]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(pairs):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [least.get(find(i)) for i in range(len(pairs))]


def test_fingerprints():
    random.seed(2)
    parts = ["Aa", "b", "É", "é x", "\x1f", "c\td", " ", "e\n", "longer", ""]
    for _ in range(300):
        text = " ".join(random.choices(parts, k=random.randint(0, 25)))
        assert simhash.fingerprint(text.encode()) == plain_print(text)
    assert simhash.fingerprint(None) == simhash.fingerprint(b" \n") == 0


def near_prints(seed, n):
    random.seed(seed)
    found = [random.getrandbits(64) for _ in range(n)] + [0, (1 << 64) - 1]
    for value in found[: n // 2]:
        for _ in range(random.randint(0, 6)):
            for _ in range(random.randint(0, 5)):
                value ^= 1 << random.randrange(64)
            found.append(value)
    return found


@pytest.mark.parametrize("settings", [
    simhash.SimHashSettings(), simhash.SimHashSettings(leaf=40, leaf_limit=60), simhash.SimHashSettings(parts=2, leaf=50),
    simhash.SimHashSettings(parts=1, leaf=50), simhash.SimHashSettings(radius=6, leaf=60),
])
def test_components_against_all_pairs(spark, settings):
    prints = sorted({p - (1 << 64) if p >> 63 else p for p in near_prints(3, 500)})
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    roots = {r["v"]: r["root"] for r in simhash.components(simhash.links(frame, settings)).collect()}
    pairs = [(p, p % (1 << 64)) for p in prints]
    truth = plain_components(pairs, settings.radius)
    classes = {}
    for p, t in zip(prints, truth, strict=True):
        classes.setdefault(t, set()).add(roots.get(p, p))
    assert all(len(c) == 1 for c in classes.values())
    assert len({next(iter(c)) for c in classes.values()}) == len(classes)


def test_one_dense_group(spark):
    # all within the radius of a centre: no vantage point divides them
    centre = random.Random(7).getrandbits(63)
    prints = sorted({centre ^ (1 << i) ^ (1 << j) for i in range(63) for j in range(i)})
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    roots = simhash.components(simhash.links(frame, simhash.SimHashSettings(leaf=100, leaf_limit=500))).collect()
    assert {r["root"] for r in roots} == {prints[0]} and len(roots) == len(prints) - 1


def test_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = sorted(simhash.near_duplicates(docs).collect(), key=lambda r: r["doc_id"])
    prints = [(d, plain_print(texts[d])) for d in sorted(texts)]
    assert [(r["doc_id"], r["fp"] % (1 << 64)) for r in rows] == prints
    assert [r["component_id"] for r in rows] == plain_components(prints)
    kept = simhash.keep_one_each(docs)
    assert kept.schema == docs.schema
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({r["component_id"] for r in rows})


def test_odd_rows(spark):
    docs = documents(spark)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    component = {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] is not None}
    assert component[5] == 1 and component[3] == 2 and component[4] == 4
    kept = simhash.keep_one_each(docs)
    assert kept.schema == docs.schema
    # the null key with the empty text has keyed company, the other is alone
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "4", "6", "7", "8", "None"]


def test_one_key_on_two_texts(spark):
    rows = [(1, "one two three four five six", "en", "a"), (1, "seven eight nine ten eleven twelve", "en", "a"), (1, "one two three four five six", "en", "b")]
    kept = simhash.keep_one_each(documents(spark, rows)).collect()
    assert sorted(r["text"][:3] for r in kept) == ["one", "sev"]


def test_empty_table(spark):
    assert simhash.near_duplicates(nothing(spark)).count() == 0
    assert simhash.keep_one_each(nothing(spark)).count() == 0
    assert np.array(simhash.forest(np.zeros(0, np.uint64), 4)).size == 0
