"""Conflict-constrained best-fit packing of documents into training sequences.

A bin holds ``capacity`` words and at most one document of a source and one of
a duplicate cluster. Bins are ordered by what is left in them; a document takes
the successor of its length in that order, and the search goes on to the next
larger remainder until a bin's source and cluster bitmaps allow it, so that it
lands in the tightest compatible bin, or opens a new one. Longest documents go
first, equal ones by key.

Documents longer than a bin are cut: whole bins first, and a rest that is
packed like any other document.

Lengths, not texts, are dealt evenly over the tasks without regard to source or
cluster, over as many tasks as there are times ``group`` pieces, whatever the
session's settings; a task packs all its pieces together, or ``group`` at a time
while it holds twice as many. A group never depends on how many rows a source or
a cluster has.

Edge cases: null and empty texts have no word and take a place of length 0; a
null source never conflicts; exact copies are one cluster unless a cluster
column is named, and a null cluster never conflicts; repeated rows are packed
one by one; an empty table packs nothing.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profitlens.llm.text import add_columns
from profitlens.session import stage


@dataclass(frozen=True)
class PackSettings:
    capacity: int = 2_048
    group: int = 4_096


def _bits(values: list) -> list[int]:
    """A bit for each value that occurs more than once; nothing else can conflict."""
    numbers = {v: i for i, v in enumerate(v for v, n in Counter(values).items() if n > 1 and v is not None)}
    return [1 << numbers[v] if v in numbers else 0 for v in values]


def best_fit(lengths: list[int], sources: list, clusters: list, capacity: int) -> tuple[list[int], list[int]]:
    """Bin and first word within it of each piece, in the given order."""
    source_bits, cluster_bits = _bits(sources), _bits(clusters)
    by_rest: list[tuple[int, int]] = []  # (words left, bin)
    held_sources: list[int] = []
    held_clusters: list[int] = []
    bins, starts = [], []
    for length, source, cluster in zip(lengths, source_bits, cluster_bits, strict=True):
        at = bisect_left(by_rest, (length, -1))
        while at < len(by_rest) and (held_sources[by_rest[at][1]] & source or held_clusters[by_rest[at][1]] & cluster):
            at += 1
        if at < len(by_rest):
            rest, chosen = by_rest.pop(at)
            held_sources[chosen] |= source
            held_clusters[chosen] |= cluster
        else:
            rest, chosen = capacity, len(held_sources)
            held_sources.append(source)
            held_clusters.append(cluster)
        insort(by_rest, (rest - length, chosen))
        bins.append(chosen)
        starts.append(capacity - rest)
    return bins, starts


def lengths(docs: DataFrame, text: str, key: str, source: str, cluster: str | None) -> DataFrame:
    """(key, source, words, cluster): what packing needs to know of a document."""

    def measure():
        def run(texts):
            counts = pa.array([len(t.split()) if t else 0 for t in texts], pa.int64())
            hashes = [xxhash.xxh3_64_intdigest(t) >> 1 if t else None for t in texts]
            return [counts, pa.array(hashes, pa.int64())]

        return run

    own = docs.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{source}`").cast("string").alias("source"), F.col(f"`{text}`").alias("text"),
        (F.col(f"`{cluster}`") if cluster else F.lit(None)).cast("string").alias("named"),
    )
    added = T.StructType([T.StructField("words", T.LongType()), T.StructField("copy", T.LongType())])
    found = add_columns(own, "text", measure, added, keep=["key", "source", "named"])
    return found.select("key", "source", "words", (F.col("named") if cluster else F.col("copy").cast("string")).alias("cluster"))


def pieces(sized: DataFrame, capacity: int) -> DataFrame:
    """One row per piece: whole bins of long documents, and the rest (or the whole) of each."""
    whole = F.floor(F.col("words") / capacity)
    rest = F.col("words") % capacity
    count = (whole + F.when((rest > 0) | (whole == 0), 1).otherwise(0)).cast("int")
    cut = sized.withColumn("n_pieces", count).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("n_pieces") - 1)))
    return cut.withColumn("first_word", F.col("piece").cast("long") * capacity).withColumn(
        "words", F.least(F.col("words") - F.col("first_word"), F.lit(capacity).cast("long"))
    )


def pack(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", cluster: str | None = None,
    settings: PackSettings = PackSettings(),
) -> DataFrame:
    """One row per piece of a document: bin, place in the bin, and which words of the document.

    Columns: key, piece, n_pieces, first_word, words, bin_id, bin_start,
    bin_words (words in the whole bin), bin_pieces.
    """
    # lengths are counted and packed: texts are read once
    cut = pieces(stage(lengths(docs, text, key, source, cluster), "pack_lengths"), settings.capacity)
    key_type = docs.schema[key].dataType
    schema = T.StructType([
        T.StructField(key, key_type), T.StructField("piece", T.IntegerType()), T.StructField("n_pieces", T.IntegerType()),
        T.StructField("first_word", T.LongType()), T.StructField("words", T.LongType()), T.StructField("bin_id", T.StringType()),
        T.StructField("bin_start", T.LongType()), T.StructField("bin_words", T.LongType()), T.StructField("bin_pieces", T.IntegerType()),
    ])
    capacity, size = settings.capacity, settings.group

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, group, held = TaskContext.get().partitionId(), 0, []

        def packed(table: pa.Table) -> pa.RecordBatch:
            order = [("words", "descending"), ("key", "ascending"), ("piece", "ascending"), ("cluster", "ascending"), ("source", "ascending")]
            table = table.sort_by(order)
            bins, starts = best_fit(*(table.column(c).to_pylist() for c in ("words", "source", "cluster")), capacity)
            fill, number = Counter(), Counter(bins)
            for b, words in zip(bins, table.column("words").to_pylist(), strict=True):
                fill[b] += words
            columns = [table.column(c).combine_chunks() for c in ("key", "piece", "n_pieces", "first_word", "words")]
            columns += [
                pa.array([f"{task:06d}-{group:06d}-{b:05d}" for b in bins], pa.string()),
                pa.array(starts, pa.int64()),
                pa.array([fill[b] for b in bins], pa.int64()),
                pa.array([number[b] for b in bins], pa.int32()),
            ]
            return pa.RecordBatch.from_arrays([c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns], schema.names)

        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= 2 * size:
                table = pa.Table.from_batches(held)
                yield packed(table.slice(0, size))
                group += 1
                held = table.slice(size).to_batches()
        rest = pa.Table.from_batches(held) if held else None
        if rest is not None and rest.num_rows:
            yield packed(rest)

    shown = cut.select("key", "piece", "n_pieces", "first_word", "words", "source", "cluster")
    return _dealt_evenly(shown, size).mapInArrow(run, schema)


def _dealt_evenly(rows: DataFrame, group: int) -> DataFrame:
    """Round robin over a task per ``group`` rows; Spark orders rows before, so a repeated task deals alike."""
    return rows.repartition(max(1, ceil(rows.count() / group)))
