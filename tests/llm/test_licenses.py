import random
import re

from profitlens.llm import licenses
from profitlens.llm.text import words
from tests.llm.odd import documents, nothing

INDEX = licenses.PositionalIndex(licenses.TEMPLATES, 100, {b"license": 60, b"the": 90, b"mit": 1}, 4)


def plain(text):
    own = [w.decode() for w in words((text or "").encode())]
    places = [
        (i, label) for phrase, label in licenses.BASE_PHRASES for i in range(len(own))
        if own[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    return len(own), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({g for _, g in places}))


def test_base_phrases_at_every_place():
    random.seed(3)
    parts = ["MIT", "License", "Apache", "general", "public", "license.", "é", "the", "MIT-license", "x"]
    for _ in range(400):
        text = " ".join(random.choices(parts, k=random.randint(0, 40)))
        assert INDEX.scan(text.encode())[:5] == plain(text)


def test_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = licenses.find_licenses(docs, keep=["doc_id"]).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == plain(texts[r["doc_id"]])
        assert set(r["base_labels"].split(",")) <= {"", *r["labels"].split(",")}
        assert 0.0 <= r["score"] <= 1.0


def test_notices_need_their_key_phrases():
    for template in licenses.NOTICES:
        found = INDEX.scan(("foo bar " + template.text + " baz").encode())
        assert template.label in found[5].split(",") and found[6] == 1.0
    changed = licenses.NOTICES[0].text.replace("hereby granted", "seldom given")
    assert INDEX.scan(changed.encode())[5] == ""
    inserted = licenses.NOTICES[3].text.replace("with or without", "either with or without")
    assert INDEX.scan(inserted.encode())[5] == "bsd"


def test_a_file_uses_its_own_rarest_words():
    # the template's rarest words are gone; those that are left still find it
    text = licenses.NOTICES[3].text.replace("redistribution and use in source", "REDISTRIBUTION and use in source")
    text = text.replace("modification", "change").replace("conditions", "terms")
    assert INDEX.scan(text.encode())[5] == "bsd"
    assert INDEX.candidates([b"nothing", b"of", b"the", b"kind"]) == []


def test_frequencies_cover_all_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    texts = [r["text"] for r in docs.collect()]
    n, counts = licenses.document_frequencies(docs)
    assert n == len(texts)
    assert counts[b"license"] == sum(bool(re.search(r"(?<![a-z0-9])license(?![a-z0-9])", t.lower(), re.ASCII)) for t in texts)


def test_odd_rows(spark):
    rows = licenses.find_licenses(documents(spark)).collect()
    assert len(rows) == 11
    empty = [r for r in rows if not r["text"]]
    assert {(r["n_words"], r["n_base"], r["first_word"], r["labels"], r["score"]) for r in empty} == {(0, 0, None, "", 0.0)}
    assert licenses.find_licenses(nothing(spark)).count() == 0
