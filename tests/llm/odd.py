"""Small tables with everything that may be odd: nulls, empty and long texts, ties, copies, clashing names."""

from __future__ import annotations

from pyspark.sql import types as T

LONG = " ".join(f"word{i % 977} the and of" for i in range(30_000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
    (2, "", "en", "a"),
    (3, None, None, None),
    (4, LONG, "en", "a"),
    (4, LONG, "en", "a"),
    (5, "The quick brown fox jumps over the lazy dog near the river bank today", "en", None),
    (None, "Ein Text ohne Schlüssel über die Straße", "de", "b"),
    (None, None, "de", "b"),
    (6, 'token = "0123456789abcdef0123456789abcdef" é', None, "a"),
    (7, "?!... ---", "fr", "a"),
    (8, "\x00\x01 Ünïcode \U0001f600 token", "fr", "b"),
]
DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use themselves
    T.StructField("score", T.StringType()), T.StructField("N_WORDS", T.IntegerType()), T.StructField("key", T.StringType()),
    T.StructField("fp", T.StringType()), T.StructField("component_id", T.StringType()), T.StructField("label", T.StringType()),
    T.StructField("removal_spans", T.StringType()), T.StructField("secret_spans", T.StringType()), T.StructField("a.b c", T.StringType()),
])


def documents(spark, rows=TEXTS):
    full = [(i, t, g, s, None if t is None else len(t), "x", 1, "k", "f", "c", "l", "r", "s", "d") for i, t, g, s in rows]
    return spark.createDataFrame(full, DOCUMENTS).repartition(3)


def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)
