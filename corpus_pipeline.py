"""The corpus pipeline: five operators over the documents, each stage written before the next reads it.

Every stage takes any table with the columns of documents, others beside them.
A null text counts as empty: its toxicity is the bias alone, it has the
fingerprint zero, repeats no benchmark, holds no secret and packs as no words.
Of a group of near duplicates, repeated rows among them, the row with the
smallest doc_id stays; of several with that key, or if none has a key, the one
with the smallest hash of all columns. Whole texts are read, however long. An empty table passes all
stages and gives no rows. The first four stages return the columns of their
input; the last returns where the pieces lie.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

from profitlens.llm import decontamination, packing, queries, secrets, simhash, toxicity
from profitlens.session import name_shared_folder, stage


def reject_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose toxicity score stays under one half."""
    return toxicity.reject_toxic(docs, queries.toxicity_model(spark, folder))


def _prepared(spark: SparkSession) -> None:
    """A session on one machine that names no checkpoint folder gets one; a cluster names its own."""
    name_shared_folder(spark, lambda: tempfile.mkdtemp(prefix="corpus-"))


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each SimHash component."""
    _prepared(spark)
    return simhash.keep_one_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """No document that repeats the benchmark, and no benchmark passage in the others."""
    _prepared(spark)
    return decontamination.decontaminate(docs, queries.table(spark, folder, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, secrets replaced by a marker."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    _prepared(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash_near_dedup", near_duplicates),
    ("decontamination", decontaminate),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack),
]

# Learnt scores, XXH64 fingerprints and order-dependent packing are not SQL; tests hold the result against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    _prepared(spark)
    docs = queries.table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
