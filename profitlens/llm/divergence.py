"""How far the sources of a language diverge in their words.

The terms that enough documents of a language hold are found by iceberg
refinement of byte prefixes. A level counts, per language, the distinct
documents of every prefix of its length; prefixes in fewer than the threshold
go, the others are extended by half as many bytes again. A term shorter than
the level's length is complete there, and its counts are final. No document
holds a term without holding its prefixes, so no kept term is lost, while
the long tail of rare terms ends at a few short prefixes and never reaches the
tables of counts. Refinement ends when no prefix is left to extend.

Texts are split into terms once; the distinct terms of each row, with their
counts, are staged in blocks of one language with a dictionary each, and every level reads them
there: work on bytes is done per dictionary, the rest on numbers. Tasks count
per block, Spark sums before and after the shuffle. The prefixes of a level go
to the next one as a bitmap of fixed size, hashed: a prefix that passes by
accident is counted and dropped one level later, so the size decides speed
alone, never the result. A last pass counts the kept terms per source.

``audit`` compares the sources: whole-number probabilities of the kept terms per
source, the sum of differences between each two sources of a language, and
the terms that a source uses more than its language does. The sums come from
tiles, ``tile_sources`` sources against as many over one block of terms, so
neither a language nor a source has to fit a task.

Edge cases: null text, language or source is the empty string; a row is a
document, repeated rows count each; a text without terms counts for its group
alone; a term of any length is refined whole; ties go to the smaller item in
UTF-8; a language without kept terms has differences of 0; an empty table gives
no rows; columns other than the three named play no part.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from profitlens.llm.text import slices
from profitlens.session import stage

#: ASCII letters become lower case, every other ASCII byte a space.
TERM_TABLE = bytes(b | 0x20 if chr(b) in string.ascii_uppercase else b if b >= 0x80 or chr(b) in string.ascii_lowercase else 0x20 for b in range(256))
SEED = 42
UNIT = 1_000_000_000
SHIFTS = (0, 20, 40)
DENSE = 1 << 23  # cells of an array that is filled instead of sorted
BLOCKS = "lang string, sources array<string>, terms binary, sizes binary, codes binary, counts binary, lengths binary, of binary"
SUMS = "lang string, source string, item string, value long"


@dataclass(frozen=True)
class AuditSettings:
    """``least_docs`` documents make a kept term; ``smoothing`` is added to each count; ``top`` ranks of terms are listed.

    ``first_level`` is the length of the first prefixes, ``filter_bits`` the bitmap of surviving ones (1 MB),
    ``part_bytes`` the text that a task holds at once.
    """

    least_docs: int = 30
    smoothing: int = 5
    top: int = 50
    first_level: int = 2
    filter_bits: int = 1 << 23
    part_bytes: int = 1 << 22
    tile_sources: int = 512
    block_terms: int = 256


def next_level(length: int) -> int:
    return length + max(1, length // 2)


def document_terms(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", settings: AuditSettings = AuditSettings()) -> DataFrame:
    """Blocks of rows of one language with the distinct terms of each row, coded by a dictionary of the block.

    Blocks are made of about ``part_bytes`` of text, or of one longer row.
    """

    def name(c: str) -> Column:
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))

    own = docs.select(name(lang), name(source), F.col(f"`{text}`").cast("binary"))
    part_bytes = settings.part_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _parts(batches, part_bytes):
            for group, own in rows.items():
                yield _block(group, own)
                pa.default_memory_pool().release_unused()

    return own.mapInArrow(run, BLOCKS)


def _parts(batches: Iterator[pa.RecordBatch], part_bytes: int) -> Iterator[dict[str, list[tuple[str, bytes]]]]:
    """(source, translated text) by language, some megabytes at a time."""
    rows, size = {}, 0
    for batch in (part for whole in batches for part in slices(whole)):
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            shown = text.translate(TERM_TABLE) if text else b""
            rows.setdefault(lang, []).append((source, shown))
            size += len(shown)
            if size >= part_bytes:
                yield rows
                rows, size = {}, 0
    if rows:
        yield rows


def _block(lang: str, rows: list[tuple[str, bytes]]) -> pa.RecordBatch:
    """Split the texts, and count the terms of each."""
    texts = pa.array([text for _, text in rows], pa.binary())
    split = pc.ascii_split_whitespace(pa.StringArray.from_buffers(len(rows), *texts.buffers()[1:]))
    row = np.repeat(np.arange(len(rows)), np.diff(split.offsets.to_numpy()))
    coded = split.values.view(pa.binary()).dictionary_encode()
    names, code = coded.dictionary, coded.indices.to_numpy()
    sizes = pc.binary_length(names).to_numpy()
    full = sizes[code] > 0  # before leading and after trailing blanks there are empty ones
    distinct, count = np.unique(row[full] * len(sizes) + code[full], return_counts=True)
    row, code = distinct // max(1, len(sizes)), distinct % max(1, len(sizes))
    numbers: dict[str, int] = {}
    of = [numbers.setdefault(source, len(numbers)) for source, _ in rows]
    terms = names.buffers()[2].to_pybytes()[: int(sizes.sum())] if len(names) else b""
    packed = (sizes, code, count, np.bincount(row, minlength=len(rows)), np.array(of, np.int64))
    columns = [pa.array([lang]), pa.array([list(numbers)], pa.list_(pa.string())), pa.array([terms], pa.binary())]
    columns += [pa.array([_narrow(a)], pa.binary()) for a in packed]
    return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in BLOCKS.split(", ")])


def _narrow(values: np.ndarray) -> bytes:
    """In as few bytes a value as the largest needs, which come first."""
    largest = int(values.max(initial=0))
    kind = np.uint8 if largest < 1 << 8 else np.uint16 if largest < 1 << 16 else np.uint32
    return bytes([np.dtype(kind).itemsize]) + values.astype(kind).tobytes()


def _widened(packed: pa.Buffer) -> np.ndarray:
    return np.frombuffer(packed, np.dtype(f"u{packed[0]}"), offset=1).astype(np.int32)


@dataclass
class _Postings:
    """A block read back: its dictionary, and a row number, term number and count per posting."""

    lang: str
    sources: list[str]
    of: np.ndarray  # the source of each row
    letters: np.ndarray  # of all terms, one after another
    sizes: np.ndarray
    row: np.ndarray
    code: np.ndarray
    count: np.ndarray

    @property
    def terms(self) -> pa.Array:
        ends = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(self.sizes), [None, pa.py_buffer(ends), pa.py_buffer(self.letters)])

    def hashes(self, which: np.ndarray, length: int | None = None) -> np.ndarray:
        """Of the first ``length`` bytes of these terms, each of which has as many, or of all their bytes."""
        starts = (np.cumsum(self.sizes) - self.sizes)[which]
        return _hashes(self.lang, self.letters, starts, self.sizes[which] if length is None else np.full(len(which), length))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Postings]:
    for batch in batches:
        for i in range(batch.num_rows):
            letters = np.frombuffer(batch.column(2)[i].as_buffer(), np.uint8)
            sizes, code, count, lengths, of = (_widened(batch.column(c)[i].as_buffer()) for c in range(3, 8))
            row = np.repeat(np.arange(len(lengths)), lengths)
            yield _Postings(batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), of, letters, sizes, row, code, count)
            pa.default_memory_pool().release_unused()


def _mixed(h: np.ndarray) -> np.ndarray:
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
        h = (h ^ h >> np.uint64(shift)) * np.uint64(factor)
    return h ^ h >> np.uint64(32)


def _hashes(lang: str, letters: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of (language, bytes), for all slices at once; no slice is empty."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    ends = np.cumsum(sizes)
    inside = np.arange(int(ends[-1])) - np.repeat(ends - sizes, sizes)
    place = _mixed(np.arange(1, int(sizes.max()) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    parts = _mixed((letters[inside + np.repeat(starts, sizes)].astype(np.uint64) + np.uint64(1)) * place[inside])
    return _mixed(np.add.reduceat(parts, ends - sizes) + np.uint64(xxhash.xxh64_intdigest(lang.encode(), SEED)))


class PrefixFilter:
    """Bitmap of (language, prefix): holds all that were put in, and few others."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def _places(self, hashes: np.ndarray) -> Iterator[np.ndarray]:
        for shift in SHIFTS:
            yield hashes >> np.uint64(shift) & np.uint64(len(self.words) * 64 - 1)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for place in self._places(hashes):
            found &= (self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
        return found

    @classmethod
    def of(cls, prefixes: DataFrame, bits: int) -> PrefixFilter:
        """From (lang, term), no term empty; at most ``bits`` / 64 words reach the driver."""
        empty = cls(np.zeros(bits // 64, np.uint64))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words = empty.words.copy()
            for batch in batches:
                langs, terms = batch.column(0).to_pylist(), batch.column(1)
                sizes = pc.binary_length(terms).to_numpy()
                starts = np.frombuffer(terms.buffers()[1], np.int32)[terms.offset : terms.offset + len(terms)]
                letters = np.frombuffer(terms.buffers()[2], np.uint8)
                by_lang: dict[str, list[int]] = {}
                for i, lang in enumerate(langs):
                    by_lang.setdefault(lang, []).append(i)
                for lang, own in by_lang.items():
                    for place in empty._places(_hashes(lang, letters, starts[own], sizes[own])):
                        np.bitwise_or.at(words, (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
            used = np.flatnonzero(words)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(words[used].view(np.int64))], ["word", "bits"])

        found = prefixes.select("lang", F.col("term").cast("binary")).mapInArrow(run, "word long, bits long")
        table = found.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
        words = empty.words.copy()
        words[table["word"].to_numpy()] = table["bits"].to_numpy().astype(np.int64).view(np.uint64)
        return cls(words)


def _documents(row: np.ndarray, name: np.ndarray, rows: int, names: int) -> np.ndarray:
    """For each name, in how many rows it stands; a row may hold it several times."""
    if rows * names <= DENSE:
        seen = np.zeros(rows * names, bool)
        seen[row * names + name] = True
        return seen.reshape(rows, names).sum(axis=0)
    return np.bincount(np.unique(row * names + name) % names, minlength=names)


def _count_level(block: _Postings, shorter: int, length: int, alive: PrefixFilter | None) -> Iterator[pa.RecordBatch]:
    """Documents of the terms that end below ``length`` bytes, and of the prefixes of the others."""
    size = block.sizes
    wanted = size >= max(1, shorter)
    if alive is not None:
        asked = np.flatnonzero(wanted)
        wanted[asked] = alive.holds(block.hashes(asked, shorter))
    ended, longer = np.flatnonzero(wanted & (size < length)), np.flatnonzero(wanted & (size >= length))
    if not len(ended) + len(longer):
        return
    # a term stands once among the postings of a row
    held, terms = np.bincount(block.code, minlength=len(size)), block.terms
    coded = pc.binary_slice(terms.take(pa.array(longer)), 0, length).dictionary_encode()
    prefixes, after = coded.dictionary, coded.indices.to_numpy()
    of_prefix = np.bincount(after, held[longer], len(prefixes)).astype(np.int64)
    # only prefixes of several terms can meet a row twice
    several = np.flatnonzero(np.bincount(after, minlength=len(prefixes)) > 1)
    if len(several):
        number = np.full(len(prefixes), -1)
        number[several] = np.arange(len(several))
        of_term = np.full(len(size), -1)
        of_term[longer] = number[after]
        name = of_term[block.code]
        inside = np.flatnonzero(name >= 0)
        of_prefix[several] = _documents(block.row[inside], name[inside], len(block.of), len(several))
    n = len(ended) + len(prefixes)
    columns = [
        pa.array([block.lang] * n, pa.string()), pa.concat_arrays([terms.take(pa.array(ended)), prefixes]),
        pa.array(np.arange(n) < len(ended)), pa.array(np.concatenate([held[ended], of_prefix]), pa.int64()),
    ]
    yield pa.RecordBatch.from_arrays(columns, ["lang", "term", "complete", "docs"])


def term_counts(blocks: DataFrame, settings: AuditSettings = AuditSettings()) -> DataFrame:
    """(lang, term, docs) of all terms that refinement completes; a superset of the kept ones."""
    complete = []
    shorter, length, alive = 0, settings.first_level, None
    while True:

        def run(batches: Iterator[pa.RecordBatch], shorter: int = shorter, length: int = length, alive: PrefixFilter | None = alive) -> Iterator[pa.RecordBatch]:
            for block in _blocks(batches):
                yield from _count_level(block, shorter, length, alive)

        counted = blocks.mapInArrow(run, "lang string, term binary, complete boolean, docs long").groupBy("lang", "term", "complete")
        counted = stage(counted.agg(F.sum("docs").alias("docs")), "prefix_counts")
        complete.append(counted.filter("complete").drop("complete"))
        survivors = counted.filter(~F.col("complete") & (F.col("docs") >= settings.least_docs)).select("lang", "term")
        if survivors.isEmpty():
            break
        shorter, length, alive = length, next_level(length), PrefixFilter.of(survivors, settings.filter_bits)
    found = complete[0]
    for more in complete[1:]:
        found = found.unionByName(more)
    return found.withColumn("term", F.col("term").cast("string"))


def source_counts(blocks: DataFrame, kept: DataFrame, settings: AuditSettings = AuditSettings()) -> DataFrame:
    """(lang, source, term, occurrences) of the terms in ``kept`` (lang, term)."""
    alive = PrefixFilter.of(kept, settings.filter_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            wanted = np.flatnonzero(block.sizes)
            wanted = wanted[alive.holds(block.hashes(wanted))]
            number = np.full(len(block.sizes), -1)
            number[wanted] = np.arange(len(wanted))
            name = number[block.code]
            inside = np.flatnonzero(name >= 0)
            cell = block.of[block.row[inside]] * len(wanted) + name[inside]
            if len(block.sources) * len(wanted) <= DENSE:
                total = np.bincount(cell, block.count[inside], len(block.sources) * len(wanted))
                distinct = np.flatnonzero(total)
                total = total[distinct]
            else:
                distinct, at = np.unique(cell, return_inverse=True)
                total = np.bincount(at, block.count[inside], len(distinct))
            of, name = distinct // max(1, len(wanted)), distinct % max(1, len(wanted))
            columns = [
                pa.array([block.lang] * len(distinct), pa.string()), pa.array(block.sources, pa.string()).take(pa.array(of)),
                block.terms.take(pa.array(wanted[name])), pa.array(total.astype(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "occurrences"])

    found = blocks.mapInArrow(run, "lang string, source string, term binary, occurrences long")
    summed = found.groupBy("lang", "source", "term").agg(F.sum("occurrences").alias("occurrences"))
    # the bitmap may let others through
    return summed.withColumn("term", F.col("term").cast("string")).join(kept.select("lang", "term"), ["lang", "term"], "left_semi")


def probability(count: str, total: str, terms: str, smoothing: int) -> Column:
    """1 + floor(10^9 (count + s) / (total + s terms)), exactly; 0 without terms."""
    above = f"cast({count} + {smoothing} as decimal(22, 0)) * cast({UNIT} as decimal(10, 0))"
    return F.expr(f"case when {terms} > 0 then 1 + ({above}) div cast({total} + {smoothing} * {terms} as decimal(22, 0)) else 0L end")


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", settings: AuditSettings = AuditSettings()) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has the other sources, part ``term`` the overused terms."""
    blocks = stage(document_terms(docs, text, lang, source, settings), "document_terms")
    kept = stage(term_counts(blocks, settings).filter(F.col("docs") >= settings.least_docs), "kept_terms")
    own = stage(source_counts(blocks, kept, settings), "kept_counts")
    whole = own.groupBy("lang", "term").agg(F.sum("occurrences").alias("in_lang"))
    of_lang = whole.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("in_lang").alias("lang_total"))
    of_source = own.groupBy("lang", "source").agg(F.sum("occurrences").alias("total"))
    every = blocks.select("lang", F.explode("sources").alias("source")).distinct()
    sources = every.join(of_source, ["lang", "source"], "left").join(of_lang, "lang", "left")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    sources = stage(sources.fillna(0, ["total", "terms", "lang_total"]).withColumn("place", place), "sources")
    s = settings.smoothing
    cells = own.join(sources, ["lang", "source"]).join(whole, ["lang", "term"]).select(
        "lang", "source", "place", "term", "terms",
        probability("occurrences", "total", "terms", s).alias("p"), probability("in_lang", "lang_total", "terms", s).alias("q"),
    )
    cells = stage(cells, "probabilities")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    over = cells.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    over = over.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= settings.top)
    pairs = _differences(cells, sources, kept, settings).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    return pairs.withColumn("rank", F.row_number().over(by_value)).unionByName(over)


def _differences(cells: DataFrame, sources: DataFrame, kept: DataFrame, settings: AuditSettings) -> DataFrame:
    """(lang, source, item, value): the sum of |p - q| over all kept terms, for each two sources of a language, both ways."""
    blocks = F.greatest(F.ceil(F.col("terms") / settings.block_terms), F.lit(1))
    block = F.pmod(F.xxhash64("term"), blocks)
    width = kept.join(sources.groupBy("lang").agg(F.max("terms").alias("terms")), "lang").groupBy("lang", block.alias("block")).agg(F.count("*").alias("width"))
    tile = F.floor(F.col("place") / settings.tile_sources)
    # what a source has where it never uses a term, once for each block
    base = sources.select("lang", "source", "place", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"), probability("0", "total", "terms", settings.smoothing).alias("p"))
    base = base.join(width, ["lang", "block"], "left").select("lang", "source", "place", "block", F.lit(None).cast("string").alias("term"), "p", F.coalesce("width", F.lit(0)).alias("width"))
    both = cells.select("lang", "source", "place", block.alias("block"), "term", "p", F.lit(0).cast("long").alias("width")).unionByName(base)
    tiles = sources.groupBy("lang").agg(F.max(tile).alias("last_tile"))
    dealt = both.join(tiles, "lang").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), "last_tile")))
    dealt = dealt.select(
        F.least(tile, "other").alias("first"), F.greatest(tile, "other").alias("second"), tile.alias("tile"), "lang", "source", "place", "block", "term", "p", "width"
    )
    sums = dealt.groupBy("lang", "first", "second", "block").applyInArrow(_tile, SUMS)
    whole = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return whole.unionByName(whole.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))


def _tile(table: pa.Table) -> pa.Table:
    """Sums of differences between the sources of two tiles over one block of terms, each pair once."""
    first, second = table["first"][0].as_py(), table["second"][0].as_py()
    terms = table["term"].combine_chunks().dictionary_encode()
    term, n = terms.indices.fill_null(-1).to_numpy(zero_copy_only=False), len(terms.dictionary)
    tile, p, place = (table[c].to_numpy() for c in ("tile", "p", "place"))
    source, width = table["source"].to_pylist(), int(table["width"].to_numpy().max())

    def side(number: int) -> tuple[list[str], np.ndarray]:
        mine = np.flatnonzero((tile == number) & (term < 0))
        mine = mine[np.argsort(place[mine])]
        matrix = np.repeat(p[mine][:, None], n + 1, axis=1)  # the last column stands for terms that neither tile uses
        cell = np.flatnonzero((tile == number) & (term >= 0))
        matrix[np.searchsorted(place[mine], place[cell]), term[cell]] = p[cell]
        return [source[i] for i in mine.tolist()], matrix

    names, left = side(first)
    others, right = (names, left) if first == second else side(second)
    weight = np.ones(n + 1, np.int64)
    weight[n] = width - n
    found: list[tuple[str, str, int]] = []
    for i, name in enumerate(names):
        start = i + 1 if first == second else 0
        values = np.abs(right[start:] - left[i]) @ weight
        found += zip([name] * len(values), others[start:], values.tolist(), strict=True)
    columns = list(zip(*found, strict=True)) if found else [(), (), ()]
    lang = pa.array([table["lang"][0].as_py()] * len(found), pa.string())
    return pa.table([lang, pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())], ["lang", "source", "item", "value"])
