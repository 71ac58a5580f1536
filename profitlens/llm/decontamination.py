"""Benchmark decontamination with an FM-index per shard of the training texts.

A shard is the run of documents that one task has read until their words reach
``shard_words``. Its words become symbols (words that no test phrase holds
separate strings), the strings' suffixes are sorted, and the last column of the
sorted rotations is kept in a wavelet tree. Every phrase is searched backwards,
all phrases of a block at once, by ranks in the tree; its occurrences are
located by walking to sampled suffix positions; overlapping occurrences merge
into removal spans. Nothing is shuffled.

Phrases are sent to the tasks in blocks of at most about ``block_words`` words;
more phrases mean more passes over the texts, never fewer phrases.

Edge cases: a null or empty text has no word and no hit, and is never
contaminated; an item without words has no phrase; an item shorter than
``window`` is one phrase; repeated items count once per id, a null id as the
empty string; repeated documents are judged one by one; an empty benchmark
marks nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profitlens.llm.text import cut, extended, slices, word_starts, words
from profitlens.session import stage

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("removal_spans", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("matched_items", T.ArrayType(T.StringType())),
])


@dataclass(frozen=True)
class ScanSettings:
    """``shard_words`` and ``block_words`` bound what one task holds; neither changes a result."""

    window: int = 13
    shard_words: int = 1 << 20
    block_words: int = 1 << 20
    sample_every: int = 32


# --- the index ----------------------------------------------------------------


def suffix_order(symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Order of the suffixes of all strings, by prefix doubling.

    ``ends`` marks the terminators; the earlier string's terminator is smaller.
    Each round compares twice as many symbols, of the undecided suffixes only.
    """
    n = len(symbols)
    first = symbols.astype(np.int64) + int(ends.sum())
    first[ends] = np.arange(int(ends.sum()))
    order = np.argsort(first, kind="stable")
    sorted_keys = first[order]
    length = 1
    undecided = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.searchsorted(sorted_keys, sorted_keys, side="left")
    while True:
        groups = rank[order[undecided]]
        again = np.zeros(len(groups), bool)
        if len(groups) > 1:
            same = groups[1:] == groups[:-1]
            again[1:] |= same
            again[:-1] |= same
        undecided = undecided[again]
        if not len(undecided):
            return order
        suffixes = order[undecided]
        groups, following = rank[suffixes], rank[suffixes + length]
        by = np.lexsort((following, groups))
        suffixes, groups, following = suffixes[by], groups[by], following[by]
        order[undecided] = suffixes
        new = np.ones(len(by), bool)
        new[1:] = (groups[1:] != groups[:-1]) | (following[1:] != following[:-1])
        rank[suffixes] = undecided[np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))]
        length *= 2


class WaveletTree:
    """Ranks of symbols in a sequence: one bit row per bit of a symbol, highest first."""

    def __init__(self, sequence: np.ndarray, bits: int):
        self.bits, self.size = bits, len(sequence)
        self.rows: list[tuple[np.ndarray, np.ndarray, int]] = []
        for level in range(bits - 1, -1, -1):
            bit = (sequence >> level) & 1
            padded = np.zeros(-(-(len(bit) + 1) // 64) * 64, np.uint8)
            padded[: len(bit)] = bit
            blocks = np.packbits(padded, bitorder="little").view(np.uint64)
            before = np.zeros(len(blocks) + 1, np.int64)
            np.cumsum(np.bitwise_count(blocks), out=before[1:])
            self.rows.append((blocks, before, int(len(bit) - bit.sum())))
            sequence = np.concatenate([sequence[bit == 0], sequence[bit == 1]])
        # where each symbol's own range begins on the last row
        self.origin = self._walk(np.arange(1 << bits), np.zeros(1 << bits, np.int64))

    def _walk(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for depth, (blocks, before, zeros) in enumerate(self.rows):
            block = at >> 6
            mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = before[block] + np.bitwise_count(blocks[block] & mask)
            bit = (symbols >> (self.bits - 1 - depth)) & 1
            at = np.where(bit == 1, zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each end."""
        return self._walk(symbols, ends) - self.origin[symbols]


class FmIndex:
    """Full-text index of strings of symbols 1..top."""

    def __init__(self, symbols: np.ndarray, ends: np.ndarray, top: int, sample_every: int):
        order = suffix_order(symbols, ends)
        starts = np.zeros(len(symbols), bool)
        starts[0] = True
        starts[1:] = ends[:-1]
        string = np.cumsum(starts) - 1
        offset = np.arange(len(symbols)) - np.flatnonzero(starts)[string]
        self.last = np.where(starts[order], 0, symbols[order - 1])
        self.tree = WaveletTree(self.last, max(1, int(top).bit_length()))
        self.before = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=top + 2))])
        # every string's first position is sampled, so that no walk leaves its string
        self.sampled = offset[order] % sample_every == 0
        self.position = order[self.sampled]
        self.sample_rank = np.cumsum(self.sampled) - 1

    def _step(self, symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return self.before[symbols] + self.tree.rank(symbols, rows)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of phrases of one length, a phrase per line; empty ranges where there is none."""
        last = phrases[:, -1]
        low, high = self.before[last].copy(), self.before[last + 1].copy()
        alive = np.flatnonzero(low < high)
        for column in range(phrases.shape[1] - 2, -1, -1):
            if not len(alive):
                break
            symbol = phrases[alive, column]
            low[alive], high[alive] = self._step(symbol, low[alive]), self._step(symbol, high[alive])
            alive = alive[low[alive] < high[alive]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: walk backwards to the next sampled position."""
        rows, walked = rows.copy(), np.zeros(len(rows), np.int64)
        going = np.flatnonzero(~self.sampled[rows])
        while len(going):
            rows[going] = self._step(self.last[rows[going]], rows[going])
            walked[going] += 1
            going = going[~self.sampled[rows[going]]]
        return self.position[self.sample_rank[rows]] + walked


# --- phrases ------------------------------------------------------------------


@dataclass(frozen=True)
class Phrases:
    """Distinct windows by length, with the items each comes from."""

    symbols: dict[bytes, int]
    by_length: list[tuple[np.ndarray, list[list[str]]]]

    @property
    def shortest(self) -> int:
        return min((w.shape[1] for w, _ in self.by_length), default=0)


def phrases_of(items: list[tuple[str, bytes | None]], window: int) -> Phrases:
    symbols: dict[bytes, int] = {}
    found: dict[tuple[int, ...], set[str]] = {}
    for item, text in items:
        ids = [symbols.setdefault(w, len(symbols) + 1) for w in words(text)]
        for start in range(max(1, len(ids) - window + 1) if ids else 0):
            found.setdefault(tuple(ids[start : start + window]), set()).add(item)
    by_length = []
    for length in sorted({len(p) for p in found}):
        chosen = [p for p in found if len(p) == length]
        by_length.append((np.array(chosen, np.int64), [sorted(found[p]) for p in chosen]))
    return Phrases(symbols, by_length)


def scan_shard(texts: list[bytes | None], phrases: Phrases, sample_every: int):
    """Words, merged spans of word positions, and matched items of each text of a shard."""
    parts, sizes = [], []
    get = phrases.symbols.get
    for text in texts:
        own = words(text)
        sizes.append(len(own))
        parts.append(np.fromiter([get(w, 0) for w in own], np.int64, len(own)))
        parts.append(np.zeros(1, np.int64))  # no phrase crosses two texts
    whole = np.concatenate([np.zeros(1, np.int64), *parts])
    firsts = 1 + np.concatenate([[0], np.cumsum(np.array(sizes, np.int64) + 1)])[:-1]
    spans: list[list[list[int]]] = [[] for _ in texts]
    items: list[set[str]] = [set() for _ in texts]

    # strings: stretches of phrase words that are long enough to hold a phrase
    held = np.diff((whole > 0).astype(np.int8))
    begin, end = np.flatnonzero(held == 1) + 1, np.flatnonzero(held == -1) + 1
    long = end - begin >= max(1, phrases.shortest)
    begin, end = begin[long], end[long]
    if not len(begin) or not phrases.by_length:
        return sizes, spans, items
    lengths = end - begin + 1  # with the terminator
    at = np.concatenate([[0], np.cumsum(lengths)])
    origin = np.repeat(begin - at[:-1], lengths)
    source = np.arange(at[-1]) + origin
    ends = np.zeros(at[-1], bool)
    ends[at[1:] - 1] = True
    index = FmIndex(np.where(ends, 0, whole[source]), ends, len(phrases.symbols), sample_every)

    change = np.zeros(len(whole) + 1, np.int64)
    for windows, owners in phrases.by_length:
        low, high = index.search(windows)
        hit = np.flatnonzero(high > low)
        if not len(hit):
            continue
        counts = high[hit] - low[hit]
        rows = np.repeat(low[hit] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        places = source[index.locate(rows)]
        np.add.at(change, places, 1)
        np.add.at(change, places + windows.shape[1], -1)
        text_of = np.searchsorted(firsts, places, side="right") - 1
        pairs = np.unique(text_of * len(owners) + np.repeat(hit, counts))
        for pair in pairs.tolist():
            items[pair // len(owners)].update(owners[pair % len(owners)])
    covered = np.diff(np.concatenate([[0], (np.cumsum(change)[:-1] > 0).astype(np.int8), [0]]))
    for start, stop in zip(np.flatnonzero(covered == 1).tolist(), np.flatnonzero(covered == -1).tolist(), strict=True):
        text = int(np.searchsorted(firsts, start, side="right")) - 1
        spans[text].append([start - int(firsts[text]), stop - int(firsts[text])])
    return sizes, spans, items


# --- the operator -------------------------------------------------------------


def _block_count(benchmark: DataFrame, text: str, settings: ScanSettings) -> int:
    """Blocks of phrases that fit the driver and a task; a word takes two bytes at least, with what separates it."""
    held = benchmark.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    return max(1, math.ceil(held / 2 / settings.block_words))


def _phrase_block(benchmark: DataFrame, item: str, text: str, settings: ScanSettings, block: int, blocks: int) -> Phrases:
    items = benchmark.select(
        F.coalesce(F.col(f"`{item}`").cast("string"), F.lit("")).alias("item"), F.col(f"`{text}`").cast("binary").alias("text")
    )
    rows = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
    return phrases_of([(r["item"], r["text"] and bytes(r["text"])) for r in rows], settings.window)


def _scan_block(
    docs: DataFrame, text: str, own: list[str], phrases: Phrases, settings: ScanSettings, prefix: str, add_to: bool
) -> DataFrame:
    """One pass over the texts; with ``add_to`` it extends what earlier blocks have found."""
    results = T.StructType([T.StructField(prefix + f.name, f.dataType) for f in RESULT])
    schema = extended(T.StructType([f for f in docs.schema if f.name in own]), results)
    own = [f.name for f in schema][: len(schema) - len(RESULT)]
    earlier = [F.col(f"`{c}`").alias(f"earlier{i}") for i, c in enumerate(results.names[1:])] if add_to else []
    # numbered, as names with dots cannot enter an Arrow pass
    shown = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(own)]
    source = docs.select(*shown, F.col(f"`{text}`").cast("binary").alias("utf8"), *earlier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(held: list[pa.RecordBatch], texts: list[bytes | None]) -> Iterator[pa.RecordBatch]:
            sizes, spans, items = scan_shard(texts, phrases, settings.sample_every)
            at = 0
            for batch in held:
                part = slice(at, at + batch.num_rows)
                at += batch.num_rows
                found_spans, found_items = spans[part], [sorted(x) for x in items[part]]
                if add_to:
                    found_spans = [_joined(a, b) for a, b in zip(batch.column(len(own) + 1).to_pylist(), found_spans)]
                    found_items = [sorted({*a, *b}) for a, b in zip(batch.column(len(own) + 2).to_pylist(), found_items)]
                arrays = [
                    pa.array(sizes[part], pa.int64()),
                    pa.array(found_spans, pa.list_(pa.list_(pa.int64()))),
                    pa.array(found_items, pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(own))] + arrays, [f.name for f in schema])

        held, texts, size = [], [], 0
        for batch in (part for whole in batches for part in slices(whole, 256)):
            held.append(batch)
            new = batch.column(len(own)).to_pylist()
            texts += new
            size += sum(len(t) for t in new if t) // 6  # about a word
            if size >= settings.shard_words:
                yield from emit(held, texts)
                held, texts, size = [], [], 0
        if held:
            yield from emit(held, texts)

    return source.mapInArrow(run, schema)


def _joined(a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
    """Union of spans of word positions."""
    result: list[list[int]] = []
    for start, end in sorted([*a, *b]):
        if result and start <= result[-1][1]:
            result[-1][1] = max(end, result[-1][1])
        else:
            result.append([start, end])
    return result


def contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    keep: list[str] | None = None, settings: ScanSettings = ScanSettings(), prefix: str = "",
) -> DataFrame:
    """``docs`` with n_words, removal_spans ([first word, word after the last]) and matched_items.

    ``keep`` names the columns returned beside them (all by default), ``prefix``
    goes before the three names; they replace columns of the same name.
    """
    kept = docs.columns if keep is None else keep
    blocks = _block_count(benchmark, item_text, settings)
    for block in range(blocks):
        phrases = _phrase_block(benchmark, item, item_text, settings, block, blocks)
        if block:
            docs = stage(docs, "decontamination_block")
        found = [] if block == 0 else [prefix + c for c in RESULT.names]
        own = kept if block == blocks - 1 else [*kept, text, *found]
        docs = _scan_block(docs, text, own, phrases, settings, prefix, add_to=block > 0)
    return docs


def hit_words(spans: str) -> Column:
    """Number of words inside removal spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, span: total + span[1] - span[0])


def is_contaminated(hits: Column, size: Column) -> Column:
    """A twentieth of the words or more are hit."""
    return (hits > 0) & (hits * 20 >= size)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", size: str | None = "n_chars") -> DataFrame:
    """Contaminated documents go; from the others the removal spans are cut out.

    Returns the columns of ``docs``; ``size`` names the column that counts
    characters and follows the text.
    """
    found = contamination(docs, benchmark, text, prefix="_fm_")
    found = found.filter(~is_contaminated(hit_words("_fm_removal_spans"), F.col("_fm_n_words")))
    untouched = [c for c in docs.columns if c not in (text, size)]
    schema, counts = docs.schema, size in docs.columns

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            texts, spans = batch.column("text").to_pylist(), batch.column("spans").to_pylist()
            for i, (data, own) in enumerate(zip(texts, spans, strict=True)):
                if own:
                    at = word_starts(data.encode())
                    texts[i] = cut(data.encode(), [(at[a][0], at[b - 1][1]) for a, b in own]).decode()
            columns = {c: batch.column(i) for i, c in enumerate(untouched)}
            columns[text] = pa.array(texts, pa.string())
            if counts:
                sizes = batch.column("size").to_pylist()
                sizes = [len(t) if own else n for t, own, n in zip(texts, spans, sizes, strict=True)]
                columns[size] = pa.array(sizes, batch.column("size").type)
            yield pa.RecordBatch.from_arrays([columns[f.name] for f in schema], [f.name for f in schema])

    shown = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(untouched)]
    shown += [F.col(f"`{text}`").alias("text"), F.col("_fm_removal_spans").alias("spans")]
    if counts:
        shown.append(F.col(f"`{size}`").alias("size"))
    return found.select(*shown).mapInArrow(remove, schema)

