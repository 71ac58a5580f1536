import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from profitlens.llm import queries, toxicity
from tests.llm.odd import documents, nothing

SETTINGS = toxicity.FactorSettings(epochs=30, least_documents=1)


def test_margin_is_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    weights, factors = rng.normal(size=20), rng.normal(size=(20, 3))
    rows = [np.array([1, 4, 7]), np.array([], np.int64), np.array([2])]
    terms, of = toxicity._flat(rows)
    margins = toxicity._margins(0.3, weights, factors, terms, of, 3)[0]
    for row, margin in zip(rows, margins, strict=True):
        pairs = sum(factors[i] @ factors[j] for i, j in itertools.combinations(row, 2))
        assert margin == pytest.approx(0.3 + weights[row].sum() + pairs)


def test_pairs_are_learnt_that_additive_weights_miss():
    # one of the two words alone is as often harmless as no word at all
    random.seed(1)
    texts, labels = [], []
    for _ in range(1200):
        one, two = random.random() < 0.5, random.random() < 0.5
        fill = random.choices(["alpha", "beta", "gamma", "delta"], k=3)
        texts.append(" ".join(fill + ["vermin"] * one + ["newcomers"] * two))
        labels.append(float(one == two))
    settings = toxicity.FactorSettings(epochs=60, stems=())
    rows = [toxicity.term_buckets(t.encode(), settings.bits, ()) for t in texts]
    model = toxicity.fit_rows(rows, np.array(labels), settings)
    right = (toxicity.score_rows(model, rows) >= 0.5) == np.array(labels)
    assert right.mean() > 0.95


@pytest.mark.parametrize("stems", [(), toxicity.FactorSettings().stems])
def test_pairs_are_learnt_with_the_settings_in_use(stems):
    random.seed(1)
    texts, labels = [], []
    for _ in range(1200):
        one, two = random.random() < 0.5, random.random() < 0.5
        fill = random.choices(["alpha", "beta", "gamma", "delta"], k=3)
        texts.append(" ".join(fill + ["vermin"] * one + ["newcomers"] * two))
        labels.append(float(one == two))
    settings = toxicity.FactorSettings()
    rows = [toxicity.term_buckets(t.encode(), settings.bits, stems) for t in texts]
    model = toxicity.fit_rows(rows, np.array(labels), settings)
    assert model.factors[[toxicity.crc32(w) & (1 << settings.bits) - 1 for w in (b"vermin", b"newcomers")]].any(axis=1).all()
    right = (toxicity.score_rows(model, rows) >= 0.5) == np.array(labels)
    assert right.mean() > 0.95


@pytest.mark.parametrize("opposite", [False, True])
def test_pairs_are_learnt_in_texts_of_hundreds_of_terms(opposite):
    """Both or neither of two words, or exactly one, among 650 other terms; judged on texts that were not learnt from."""
    rng, settings = random.Random(1), toxicity.FactorSettings()
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 9))) for _ in range(3000)]
    rows, labels = [], []
    for _ in range(14_000):
        one, two = rng.random() < 0.5, rng.random() < 0.5
        text = " ".join(rng.choices(vocabulary, k=190) + ["vermin"] * one + ["newcomers"] * two)
        rows.append(toxicity.term_buckets(text.encode(), settings.bits, settings.stems))
        labels.append(float((one == two) != opposite))
    labels = np.array(labels)
    assert np.mean([len(r) for r in rows]) > 600
    model = toxicity.fit_rows(rows[:12_000], labels[:12_000], settings)
    right = (toxicity.score_rows(model, rows[12_000:]) >= 0.5) == labels[12_000:]
    assert right.mean() > 0.95
    without = toxicity.FactorModel(model.bits, model.stems, model.bias, model.weights, np.zeros_like(model.factors))
    assert ((toxicity.score_rows(without, rows[12_000:]) >= 0.5) == labels[12_000:]).mean() < 0.8


def test_scores_of_whole_documents_by_the_formula(spark):
    """Every document of a table against the sum over all pairs of its terms."""
    folder = "/root/testdata/sf0.001"
    model = toxicity.FactorModel(10, (3, 4), -0.5, *(np.random.default_rng(2).normal(0, s, shape).astype(np.float32) for s, shape in ((0.1, 1 << 10), (0.02, (1 << 10, 3)))))
    docs = queries.table(spark, folder, "documents")
    for row in toxicity.score(docs, model, column="score").collect():
        found = set(re.findall(rb"[a-z0-9\x80-\xff]+", (row["text"] or "").encode().lower()))
        terms = {toxicity.crc32(w) & 1023 for w in found} | {toxicity.crc32(w[:n], n) & 1023 for w in found for n in (3, 4) if len(w) > n}
        terms = np.array(sorted(terms), int)
        gram = model.factors[terms].astype(float) @ model.factors[terms].astype(float).T
        margin = model.bias + model.weights[terms].astype(float).sum() + (gram.sum() - np.trace(gram)) / 2
        assert row["score"] == pytest.approx(1 / (1 + np.exp(-margin)), abs=1e-6)


def test_the_sample_is_bounded_if_one_key_has_all_rows(spark):
    docs = spark.range(900).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"), (F.col("id") % 2).alias("toxic"))
    settings = toxicity.FactorSettings(fit_rows=100, weight_epochs=1, epochs=1)
    assert toxicity.labelled_terms(docs, "doc_id", "text", "toxic", settings).count() == 100
    model = toxicity.fit(docs, "doc_id", "text", "toxic", settings)
    assert 0.0 < toxicity.score_rows(model, [np.zeros(0, np.int64)])[0] < 1.0


def test_toxic_documents_go_from_a_small_table(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = queries.table(spark, folder, "documents"), queries.table(spark, folder, "labels")
    kept = toxicity.reject_toxic(docs, queries.toxicity_model(spark, folder)).select("doc_id", F.lit(1).alias("kept"))
    rows = docs.join(labels, "doc_id").join(kept, "doc_id", "left").groupBy("toxic").agg(F.count("*"), F.count("kept")).collect()
    count = {r[0]: (r[1], r[2]) for r in rows}
    assert count[1][0] > 0 and count[1][1] <= 0.2 * count[1][0]
    assert count[0][1] >= 0.95 * count[0][0]


def test_held_out_documents(spark):
    scored = queries.op1_toxicity(spark, "/root/testdata/sf0.1")
    labels = queries.table(spark, "/root/testdata/sf0.1", "labels")
    rows = scored.join(labels, "doc_id").filter("held_out").groupBy("toxic", "predicted").count().collect()
    count = {(r["toxic"], r["predicted"]): r["count"] for r in rows}
    assert count[1, 1] / (count[1, 1] + count.get((1, 0), 0)) > 0.85  # of 3,000 labelled rows
    assert count.get((0, 1), 0) / count[0, 0] < 0.005


def test_odd_rows(spark):
    docs = documents(spark)
    labelled = docs.withColumn("toxic", F.when(F.col("doc_id") != 5, F.col("doc_id") % 2))
    model = toxicity.fit(labelled, "doc_id", "text", "toxic", SETTINGS)
    rows = toxicity.score(docs, model, column="score").collect()
    assert len(rows) == docs.count()
    empty = {r["score"] for r in rows if not r["text"]}
    assert len(empty) == 1 and 0.0 < empty.pop() < 1.0
    kept = toxicity.reject_toxic(docs, model)
    assert kept.schema == docs.schema


def test_no_telling_term_leaves_the_share_of_labels():
    rows = [toxicity.term_buckets(f"word{i}".encode(), 18, ()) for i in range(40)]
    model = toxicity.fit_rows(rows, np.array([1.0] * 10 + [0.0] * 30), toxicity.FactorSettings())
    assert not model.weights.any()
    assert toxicity.score_rows(model, rows) == pytest.approx([0.25] * 40, abs=0.06)


def test_empty_tables(spark):
    model = toxicity.fit(nothing(spark).withColumn("toxic", F.lit(1)), "doc_id", "text", "toxic", SETTINGS)
    assert toxicity.score(nothing(spark), model).count() == 0
    assert [r[0] for r in toxicity.score(documents(spark), model, keep=[]).collect()] == pytest.approx([0.5] * 11)
