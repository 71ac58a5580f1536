"""License scans with a positional index of rare words.

Templates (license texts, and the base phrases) are indexed by word and
position. Document frequencies of all template words come from the whole corpus.
A text looks up, for each template whose key words it holds, the words of
highest inverse document frequency that are in both: every place of such a word
gives, for every posting of it, the place where the template would begin.
Begins on which enough of them agree are candidates, and a candidate counts if
the template's mandatory key phrases stand there. Base phrases are templates of
a few words whose key phrase is the whole phrase, so that one rare word finds
every place.

Edge cases: null is an empty text; both have no word, no place, empty labels
and score 0; overlapping places all count; repeated rows are scanned one by
one; in an empty corpus any template word may be an anchor; result columns
replace columns of the same name.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profitlens.llm.text import add_columns, words


@dataclass(frozen=True)
class Template:
    """``keys`` must stand in the text near where the template's own words put them."""

    label: str
    text: str
    keys: tuple[str, ...]
    base: bool = False


# The base phrases with their labels, then license notices.
BASE_PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
NOTICES = (
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files, to deal in the Software without restriction",
        ("permission is hereby granted", "free of charge"),
    ),
    Template(
        "apache",
        "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License",
        ("apache license", "except in compliance with the license"),
    ),
    Template(
        "gpl",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the"
        " Free Software Foundation",
        ("under the terms of the gnu", "general public license"),
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    Template(
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        ("mozilla public license",),
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        ("with or without fee is hereby granted",),
    ),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    Template("cc-by", "Licensed under CC BY 4.0", ("cc by 4 0",)),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0", ("cc by sa",)),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template("cc-by-nd", "Licensed under CC BY-ND 4.0", ("cc by nd",)),
    Template("cc0", "CC0 1.0 Universal public domain dedication", ("cc0 1 0",)),
)
TEMPLATES = tuple(Template(label, phrase, (phrase,), base=True) for phrase, label in BASE_PHRASES) + NOTICES

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()), T.StructField("score", T.DoubleType()),
])


def document_frequencies(docs: DataFrame, text: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> tuple[int, dict[bytes, int]]:
    """Number of documents, and of documents that hold each template word; counted over all texts."""
    vocabulary = {w for t in templates for w in words(t.text.encode())}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = Counter(), 0
        for batch in batches:
            for data in batch.column(0).to_pylist():
                rows += 1
                held.update(vocabulary.intersection(words(data)))
        names = [b"", *held]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array([rows, *held.values()], pa.int64())], ["word", "n"])

    source = docs.select(F.col(f"`{text}`").cast("binary").alias("text"))
    found = source.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = {bytes(r["word"]): r["n"] for r in found}
    return counts.pop(b"", 0), counts


class PositionalIndex:
    """Words of the templates with their positions and rarity."""

    def __init__(self, templates: tuple[Template, ...], documents: int, frequencies: dict[bytes, int], anchors: int):
        self.templates, self.anchors = templates, anchors
        self.words = [words(t.text.encode()) for t in templates]
        self.keys = [[words(k.encode()) for k in t.keys] for t in templates]
        self.key_words = [frozenset(w for key in keys for w in key) for keys in self.keys]
        self.vocabulary = frozenset(w for own in self.words for w in own)
        self.rarity = {w: math.log((documents + 1) / (frequencies.get(w, 0) + 1)) for w in self.vocabulary}

    def candidates(self, text: list[bytes]) -> list[tuple[int, int]]:
        """(template, begin) where enough of the text's rarest words of the template stand at their relative position."""
        present = self.vocabulary.intersection(text)
        postings: dict[bytes, list[tuple[int, int]]] = {}
        needed: dict[int, int] = {}
        for number, keys in enumerate(self.key_words):
            if keys <= present:
                shared = sorted(present.intersection(self.words[number]), key=lambda w: (-self.rarity[w], w))
                chosen = shared[: 1 if self.templates[number].base else self.anchors]
                needed[number] = max(1, len(chosen) // 2)
                for position, word in enumerate(self.words[number]):
                    if word in chosen:
                        postings.setdefault(word, []).append((number, position))
        if not postings:
            return []
        votes: Counter[tuple[int, int]] = Counter()
        for at, word in enumerate(text):
            if word in postings:
                votes.update((number, at - position) for number, position in postings[word])
        return [place for place, n in votes.items() if n >= needed[place[0]]]

    def has_keys(self, text: list[bytes], number: int, begin: int) -> bool:
        """Whether every key phrase stands where the template lies, give or take inserted words."""
        slack = 0 if self.templates[number].base else 6
        near = text[max(0, begin - slack) : max(0, begin + len(self.words[number]) + slack)]
        return all(any(near[i : i + len(key)] == key for i in range(len(near) - len(key) + 1)) for key in self.keys[number])

    def coverage(self, text: list[bytes], number: int, begin: int) -> float:
        """Share of the template's words at their relative position."""
        own = self.words[number]
        return sum(0 <= begin + i < len(text) and text[begin + i] == w for i, w in enumerate(own)) / len(own)

    def scan(self, data: bytes | None) -> tuple:
        text = words(data)
        base: list[tuple[int, str]] = []
        labels: set[str] = set()
        score = 0.0
        for number, begin in self.candidates(text):
            template = self.templates[number]
            if not self.has_keys(text, number, begin):
                continue
            labels.add(template.label)
            if template.base:
                base.append((begin, template.label))
            # a phrase mentions a license, a notice grants it
            score = max(score, 0.5 if template.base else 0.5 + 0.5 * self.coverage(text, number, begin))
        starts = [begin for begin, _ in base]
        return (
            len(text), len(base), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in base})), ",".join(sorted(labels)), score,
        )


def find_licenses(
    docs: DataFrame, text: str = "text", keep=None, templates: tuple[Template, ...] = TEMPLATES, anchors: int = 4
) -> DataFrame:
    """``docs`` with the columns of ``RESULT``."""
    documents, frequencies = document_frequencies(docs, text, templates)
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

    def scanner():
        index = PositionalIndex(templates, documents, frequencies, anchors)

        def run(texts):
            rows = [index.scan(t) for t in texts]
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            return [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]

        return run

    return add_columns(docs, text, scanner, RESULT, keep)
