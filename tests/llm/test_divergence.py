import random
import re
from collections import Counter, defaultdict

import pytest

from profitlens.llm import divergence
from tests.llm.odd import TEXTS, documents, nothing

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, settings):
    """All terms of all documents, every pair of sources, whole numbers throughout."""
    docs, counts = Counter(), defaultdict(Counter)
    for _, text, lang, source in rows:
        found = TERM.findall((text or "").translate(LOW))
        lang, source = lang or "", source or ""
        counts[lang, source].update(found)
        docs.update((lang, t) for t in set(found))
    result = []
    for lang in {g for g, _ in counts}:
        terms = [t for (g, t), n in docs.items() if g == lang and n >= settings.least_docs]
        mine = {s: c for (g, s), c in counts.items() if g == lang}

        def p(count, total, terms=terms):
            return 1 + 10**9 * (count + settings.smoothing) // (total + settings.smoothing * len(terms))

        table = {s: {t: p(c[t], sum(c[u] for u in terms)) for t in terms} for s, c in mine.items()}
        whole = {t: sum(c[t] for c in mine.values()) for t in terms}
        q = {t: p(whole[t], sum(whole.values())) for t in terms}
        for s, c in mine.items():
            pairs = [(-sum(abs(table[s][t] - table[o][t]) for t in terms), o.encode()) for o in mine if o != s]
            over = [(q[t] - table[s][t], t.encode()) for t in terms if c[t] > 0 and table[s][t] > q[t]]
            for part, values in (("pair", sorted(pairs)), ("term", sorted(over)[: settings.top])):
                result += [(lang, s, part, item.decode(), -v, rank) for rank, (v, item) in enumerate(values, 1)]
    return sorted(result)


def sample(rows):
    """Words of a few stems in several sources, with rare and long ones."""
    random.seed(7)
    stems = ["a", "ab", "abc", "abcd", "abcdefghijklmnop", "abcdefghijklmnoq", "über", "übel", "é", "x" * 200, "x" * 200 + "y"]
    found = []
    for i in range(rows):
        words = [random.choice(stems[: 3 + i % 9]) + random.choice(["", "", "s", "Z", str(i)]) for _ in range(random.randint(0, 12))]
        found.append((i, random.choice([" ", "-", "1"]).join(words), random.choice(["en", "de", "de", None]), random.choice("abcdef")))
    return found


@pytest.mark.parametrize("settings", [
    divergence.AuditSettings(), divergence.AuditSettings(least_docs=3, top=4, first_level=1, tile_sources=2, block_terms=5),
    divergence.AuditSettings(least_docs=2, filter_bits=64, tile_sources=3),  # a bitmap that lets nearly all prefixes through
    divergence.AuditSettings(least_docs=10_000),
])
def test_against_plain_counts(spark, settings):
    rows = sample(500)
    found = divergence.audit(documents(spark, rows), settings=settings)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, found.collect())) == plain(rows, settings)


@pytest.mark.parametrize("least", [1, 2])
def test_odd_rows(spark, least):
    settings = divergence.AuditSettings(least_docs=least)
    found = divergence.audit(documents(spark), settings=settings)
    assert sorted(map(tuple, found.collect())) == plain(TEXTS, settings)
    assert divergence.audit(nothing(spark), settings=settings).count() == 0


def test_rare_prefixes_are_not_extended(spark):
    rows = [(i, f"common qz{i:04d}abcdefgh".replace("0", "o").replace("1", "i"), "en", "a") for i in range(40)]
    rows += [(100, "wxyz" * 9, "en", "b")]
    staged = divergence.document_terms(documents(spark, rows))
    terms = {r["term"] for r in divergence.term_counts(staged, divergence.AuditSettings(least_docs=30)).collect()}
    assert "common" in terms
    assert not any(t.startswith("w") for t in terms)


def test_levels_grow():
    lengths = [2]
    while lengths[-1] < 1_000_000:
        lengths.append(divergence.next_level(lengths[-1]))
    assert lengths[:6] == [2, 3, 4, 6, 9, 13]
    assert len(lengths) < 40
