"""Language identification by rank-order profiles.

A text's n-grams of one to three letters, word boundaries included, are ranked
by frequency. Its most frequent ones are compared with each language's profile:
an n-gram costs the distance between its two ranks, or the profile's length if
the profile lacks it. The language with the smallest sum wins.

Profiles are learnt from a bounded sample of labelled documents (about
``fit_rows`` per language, by the hash of the key); every text is counted whole.

Edge cases: a null text, or one without a letter, is ``und`` with score 0;
equal distances go to the language whose name is first; rows without key or
language are not learnt from; without any labelled row every text is ``und``;
repeated rows are judged one by one; result columns replace columns of the same
name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profitlens.llm.text import add_columns

UNKNOWN = "und"
CHARACTER_BITS = 21


@dataclass(frozen=True)
class ProfileSettings:
    length: int = 300
    fit_rows: int = 2_000
    chunk: int = 1 << 20


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """The lower-case letter of each code point, 0 for all that are no letters."""
    table = np.zeros(0x110000, np.int64)
    for code in range(0x110000):
        character = chr(code)
        if character.isalpha():
            lower = character.lower()
            table[code] = ord(lower) if len(lower) == 1 else code
    return table


def _codes(text: np.ndarray) -> np.ndarray:
    """N-grams of letters and boundaries; a boundary stands at an n-gram's ends only."""
    single = text[text > 0]
    pairs = (text[:-1] << CHARACTER_BITS) | text[1:]
    pairs = pairs[(text[:-1] > 0) | (text[1:] > 0)]
    middle = text[1:-1] > 0
    triples = (text[:-2][middle] << 2 * CHARACTER_BITS) | (text[1:-1][middle] << CHARACTER_BITS) | text[2:][middle]
    # the count of letters is marked, so that a leading boundary does not make a triple look like a pair
    return np.concatenate([single, pairs | (1 << 62), -triples - 1])


def ngram_counts(data: bytes | None, chunk: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a whole text and their counts."""
    text = letters()[np.frombuffer((data or b"").decode("utf-8", "replace").encode("utf-32-le"), np.uint32)]
    text = np.concatenate([[0], text, [0]])
    found, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    # one boundary between words
    text = text[np.concatenate([[True], (text[1:] > 0) | (text[:-1] > 0)])]
    for start in range(0, max(1, len(text) - 2), chunk):
        piece = text[start : start + chunk + 2]
        codes = _codes(piece)
        if start + chunk + 2 < len(text):
            # what lies wholly in the two characters shared with the next chunk is counted there
            minus = _codes(piece[-2:])
        else:
            minus = np.zeros(0, np.int64)
        own, n = np.unique(codes, return_counts=True)
        if len(minus):
            np.subtract.at(n, np.searchsorted(own, minus), 1)
        found, back = np.unique(np.concatenate([found, own]), return_inverse=True)
        counts = np.bincount(back, np.concatenate([counts, n]), len(found)).astype(np.int64)
    return found[counts > 0], counts[counts > 0]


def top(found: np.ndarray, counts: np.ndarray, length: int) -> np.ndarray:
    """The most frequent n-grams in order; equal counts by code."""
    return found[np.lexsort((found, -counts))[:length]]


@dataclass(frozen=True)
class Profiles:
    """Per language the n-grams of its profile, ordered by code, and their ranks."""

    names: list[str]
    codes: list[np.ndarray]
    ranks: list[np.ndarray]
    length: int

    def distance(self, ranked: np.ndarray, language: int) -> int:
        codes, ranks = self.codes[language], self.ranks[language]
        at = np.minimum(np.searchsorted(codes, ranked), len(codes) - 1)
        apart = np.abs(ranks[at] - np.arange(len(ranked)))
        return int(np.where(codes[at] == ranked, apart, self.length).sum())

    def judge(self, data: bytes | None, chunk: int) -> tuple[str, float]:
        ranked = top(*ngram_counts(data, chunk), self.length)
        if not len(ranked) or not self.names:
            return UNKNOWN, 0.0
        distances = [self.distance(ranked, i) for i in range(len(self.names))]
        best = int(np.argmin(distances))
        return self.names[best], max(0.0, 1.0 - distances[best] / (self.length * len(ranked)))


def learn(labelled: DataFrame, key: str, text: str, language: str, settings: ProfileSettings = ProfileSettings()) -> Profiles:
    """Profiles from a sample that is bounded per language."""
    own = labelled.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.col(f"`{language}`").alias("language"))
    own = own.filter("key is not null and language is not null")
    # a row per language
    shares = {r["language"]: min(1 << 30, int((1 << 30) * settings.fit_rows / r["n"])) for r in own.groupBy("language").agg(F.count("*").alias("n")).collect()}
    if not shares:
        return Profiles([], [], [], settings.length)
    share = F.create_map(*[F.lit(x) for pair in sorted(shares.items()) for x in pair])
    picked = own.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < share[F.col("language")])
    chunk = settings.chunk

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for name in sorted(set(names)):
                parts = [ngram_counts(t, chunk) for n, t in zip(names, texts, strict=True) if n == name]
                codes, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                counts = np.bincount(back, np.concatenate([p[1] for p in parts]), len(codes)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(codes), pa.string()), pa.array(codes, pa.int64()), pa.array(counts, pa.int64())], ["language", "code", "n"])

    source = picked.select("language", F.col("text").cast("binary").alias("text"))
    counted = source.mapInArrow(count, "language string, code long, n long").groupBy("language", "code").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("language").orderBy(F.desc("n"), "code")
    rows = counted.withColumn("rank", F.row_number().over(order) - 1).filter(F.col("rank") < settings.length).orderBy("language", "code").collect()
    names = sorted({r["language"] for r in rows})
    of = {name: [(r["code"], r["rank"]) for r in rows if r["language"] == name] for name in names}
    codes = [np.array([c for c, _ in of[name]], np.int64) for name in names]
    return Profiles(names, codes, [np.array([r for _, r in of[name]], np.int64) for name in names], settings.length)


RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def identify(docs: DataFrame, profiles: Profiles, text: str = "text", keep=None, settings: ProfileSettings = ProfileSettings()) -> DataFrame:
    """``docs`` with lang_pred and score, 1 for a text whose ranks equal the profile's."""

    def judge():
        def run(texts):
            found = [profiles.judge(t, settings.chunk) for t in texts]
            return [pa.array([n for n, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())]

        return run

    return add_columns(docs, text, judge, RESULT, keep)
