"""WARC archives, and an index merged from locally sorted runs.

Writing: every capture becomes one WARC/1.1 record. Of captures with equal
payloads of ``least_bytes`` or more, the one with the largest key is a response
and the others are revisits that refer to it. Records are ended by the line
separator of Spark's text writer, so the files are gzipped archives that the
writer commits like any other output; offsets count unzipped bytes.

Reading: archives are read back, lengths and digests are verified, and each
record becomes an index line.

Index: every task sorts the lines it holds into a run and cuts the run at keys
that divide the whole index into ranges of about ``range_rows`` lines. A range
gathers its slice of each run and merges them with a loser tree by URL key,
time and record, so ranges in order are the capture histories in order. The cut
keys hold time and record too: the history of one hot URL spans several ranges.
The sample that cuts are taken from decides where ranges end, not what is in
them.

Edge cases: a null payload is empty; a null URL or key has no header line and
reads back as null; a null key never becomes the response of others; captures
with equal key and payload are equal records, all response or all revisits;
line breaks in URLs are percent-encoded; extra columns are not archived; an
empty table writes no record and reads back empty.
"""

from __future__ import annotations

import gzip
import hashlib
import math
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profitlens.functions.bitmap import Bitmap, divided
from profitlens.session import stage, staged_path

BREAK = "\r\n"
RECORD_END = "\r\n\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class ArchiveSettings:
    """``least_bytes`` of payload make a revisit worthwhile; the other values bound files, runs and ranges.

    Cut keys go to all tasks, so there are at most ``most_ranges`` at first; in
    a larger index each range is cut once more, by keys that only its own slices meet.
    """

    least_bytes: int = 1_000
    archive_bytes: int = 32 << 20
    run_rows: int = 20_000
    range_rows: int = 20_000
    most_ranges: int = 10_000


# --- writing ------------------------------------------------------------------


def record_id(key: Column, digest: Column) -> Column:
    """A URN that follows from key and payload digest."""
    name = F.md5(F.concat_ws("|", F.coalesce(key.cast("string"), F.lit("null")), digest))
    parts = [F.substr(name, F.lit(start), F.lit(length)) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _decided(captures: DataFrame, settings: ArchiveSettings) -> DataFrame:
    """Captures with digest, size and the key they refer to (null for responses)."""
    sized = captures.withColumns({"digest": F.sha1(F.col("payload")), "size": F.octet_length("payload")})
    groups = sized.filter(F.col("size") >= settings.least_bytes).groupBy("digest")
    shared = stage(groups.agg(F.count("*").alias("n"), F.max("key").alias("largest")).filter("n > 1").drop("n"), "shared_digests")
    # payloads that no other capture has, and small ones, are not shuffled to learn it
    hashed = F.xxhash64("digest")
    held = Bitmap.of(shared.select(hashed.alias("hash")), "hash", shared.count()).may_hold(hashed)
    maybe, alone = divided(sized, held & (F.col("size") >= settings.least_bytes))
    alone = alone.withColumn("largest", F.lit(None).cast(shared.schema["largest"].dataType))
    compared = maybe.join(shared.withColumnRenamed("digest", "of"), F.col("digest") == F.col("of"), "left").drop("of")
    return alone.unionByName(compared).withColumn("refers", F.when(F.coalesce(F.col("key") < F.col("largest"), F.lit(True)), F.col("largest")))


def record_text(rows: DataFrame) -> DataFrame:
    """One string per record, without the two line breaks that end it."""
    revisit = F.col("refers").isNotNull()
    block = F.concat(F.lit(HTTP_HEAD), F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")

    def line(name: str, value: Column) -> Column:
        """A header line; none if the value is null."""
        return F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(BREAK))

    lines = [
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", record_id(F.col("key"), F.col("digest"))),
        line("WARC-Date", F.date_format("captured", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Refers-To", F.when(revisit, record_id(F.col("refers"), F.col("digest")))),
        line("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        line("X-Capture-Key", F.col("key")),
        line("X-Refers-To-Key", F.col("refers")),
        line("X-Payload-Length", F.col("size")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block)),
    ]
    return rows.select(F.concat_ws("", F.lit("WARC/1.1" + BREAK), *lines, F.lit(BREAK), block).alias("value"))


def write_archives(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html",
    captured: str | None = None, settings: ArchiveSettings = ArchiveSettings(),
) -> None:
    """Write a record per row. Without a column of capture times, the key counts seconds from 2000 on."""
    own = F.col(f"`{key}`")
    seconds = F.pmod(F.coalesce(own.try_cast("long"), F.lit(0)), F.lit(1 << 31)) + 946_684_800
    captures = pages.select(
        own.alias("key"), F.col(f"`{url}`").cast("string").alias("url"), F.coalesce(F.col(f"`{payload}`"), F.lit("")).alias("payload"),
        (F.col(f"`{captured}`") if captured else F.timestamp_seconds(seconds)).alias("captured"),
    )
    held = captures.agg(F.count("*").alias("n"), F.sum(F.octet_length("payload") + 700).alias("bytes")).first()
    per_file = max(1, int(settings.archive_bytes * held["n"] / held["bytes"])) if held["n"] else 1
    writer = record_text(_decided(captures, settings)).write.option("lineSep", RECORD_END).option("maxRecordsPerFile", per_file)
    writer.option("compression", "gzip").text(path)


# --- reading ------------------------------------------------------------------

LINES = T.StructType([
    T.StructField("url_key", T.StringType()), T.StructField("captured", T.StringType()), T.StructField("archive", T.StringType()),
    T.StructField("offset", T.LongType()), T.StructField("length", T.LongType()), T.StructField("key", T.StringType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.StringType()),
])


def url_key(url: str | None) -> str:
    """Host parts from the right, then path and query: captures of a site are neighbours."""
    try:
        parts = urlsplit(url or "")
        host = ",".join(reversed((parts.hostname or "").split(".")))
        port = f":{parts.port}" if parts.port and parts.port not in (80, 443) else ""
    except ValueError:
        return url or ""
    return f"{host}{port}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def parse_archive(archive: str, data: bytes) -> Iterator[tuple]:
    """An index line per record; a record that contradicts its headers is an error."""
    at, mark = 0, RECORD_END.encode()
    while at < len(data):
        body = data.index(mark, at) + len(mark)
        head = data[at : body - len(mark)].decode().split(BREAK)
        fields = dict(line.split(": ", 1) for line in head[1:])
        end = body + int(fields["Content-Length"])
        if head[0] != "WARC/1.1" or data[end : end + len(mark)] != mark:
            raise ValueError(f"{archive}: no record ends at {end}")
        payload = memoryview(data)[body + len(HTTP_HEAD) : end]
        digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
        if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
            raise ValueError(f"{archive}: the payload at {body} is not the one that was written")
        yield (
            url_key(fields.get("WARC-Target-URI")), fields.get("WARC-Date"), archive, at, end - at,
            fields.get("X-Capture-Key"), size, digest, fields["WARC-Type"], fields.get("X-Refers-To-Key"),
        )
        at = end + len(mark)


def _arrow(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}
    columns = list(zip(*rows, strict=True)) if rows else [() for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[f.dataType.simpleString()]) for c, f in zip(columns, schema, strict=True)], schema.names
    )


def read_archives(spark, path: str) -> DataFrame:
    """The index lines of all archives in a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(batch.column(0), batch.column(1), strict=True):
                name = archive.as_py().rsplit("/", 1)[-1]
                yield _arrow(list(parse_archive(name, gzip.decompress(content.as_py()))), LINES)

    return files.mapInArrow(run, LINES)


# --- the index ----------------------------------------------------------------


class LoserTree:
    """Merges sorted iterators: every inner node keeps the loser of its match, the winner goes up."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs = runs
        self.heads = [next(run, None) for run in runs]
        self.losers: list[int | None] = [None] * len(runs)
        self.winner = 0
        for run in range(len(runs)):
            self._play(run)

    def _play(self, run: int) -> None:
        node = (run + len(self.runs)) >> 1
        while node:
            other = self.losers[node]
            if other is None:
                self.losers[node] = run  # waits for its opponent
                return
            if self._before(other, run):
                self.losers[node], run = run, other
            node >>= 1
        self.winner = run

    def _before(self, a: int, b: int) -> bool:
        if self.heads[a] is None or self.heads[b] is None:
            return self.heads[b] is None and self.heads[a] is not None
        return self.heads[a] < self.heads[b]

    def __iter__(self) -> Iterator[tuple]:
        while self.runs and self.heads[self.winner] is not None:
            run = self.winner
            yield self.heads[run]
            self.heads[run] = next(self.runs[run], None)
            self._play(run)


def order_key(row: tuple) -> tuple:
    """URL key, time, archive, offset: total, as no two records share a place."""
    return row[0], row[1] or "", row[2], row[3]


def _pieces(held: list[tuple], cuts: list[tuple]) -> Iterator[tuple[int, list[tuple]]]:
    """Sorted lines cut at the keys, each piece with its number."""
    at, number = 0, 0
    while at < len(held):
        while number < len(cuts) and order_key(held[at]) >= cuts[number]:
            number += 1
        end = at
        while end < len(held) and (number == len(cuts) or order_key(held[end]) < cuts[number]):
            end += 1
        yield number, held[at:end]
        at = end


def _packed(lines: list[tuple]) -> bytes:
    sink, block = pa.BufferOutputStream(), _arrow(lines, LINES)
    with pa.ipc.new_stream(sink, block.schema) as out:
        out.write_batch(block)
    return sink.getvalue().to_pybytes()


def _opened(block: bytes) -> Iterator[tuple]:
    for batch in pa.ipc.open_stream(block):
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _slices_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary())], SLICES.names)


SLICES = T.StructType([T.StructField("outer", T.LongType()), T.StructField("inner", T.LongType()), T.StructField("slice", T.BinaryType())])


def _cut_again(runs: DataFrame, picked: DataFrame, cuts: list[tuple], inner: int) -> DataFrame:
    """Each range of ``runs`` divided into ``inner`` ranges by sampled keys of its own."""
    names = ["url_key", "captured", "archive", "offset"]
    schema = T.StructType([T.StructField("outer", T.LongType()), *[LINES[n] for n in names]])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            yield _arrow([(bisect_right(cuts, order_key(k)), *k) for k in keys], schema)

    numbered = picked.select(*names).mapInArrow(number, schema)
    ordered = numbered.groupBy("outer").agg(F.array_sort(F.collect_list(F.struct(*[F.coalesce(n, F.lit("")).alias(n) if n == "captured" else F.col(n) for n in names]))).alias("keys"))
    places = F.sequence(F.lit(1), F.lit(inner - 1))
    chosen = ordered.select("outer", F.transform(places, lambda i: F.get("keys", F.floor(F.size("keys") * i / inner).cast("int"))).alias("cuts"))

    def divide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = sorted(tuple(c[n] for n in names) for c in row["cuts"] or [] if c)
                yield _slices_batch([(row["outer"], n, _packed(piece)) for n, piece in _pieces(list(_opened(row["slice"])), own)])

    return runs.select("outer", "slice").join(chosen, "outer", "left").select("outer", "slice", "cuts").mapInArrow(divide, SLICES)


def merge_index(lines: DataFrame, settings: ArchiveSettings = ArchiveSettings()) -> DataFrame:
    """``lines`` in global order: index_range, then index_position within the range."""
    rows = lines.count()
    wanted = max(1, math.ceil(rows / settings.range_rows))
    ranges = min(settings.most_ranges, wanted)
    inner = math.ceil(wanted / ranges)

    def sample(keys: int) -> DataFrame:
        share = min(1 << 30, int((1 << 30) * 20 * keys / max(1, rows)))
        return lines.filter(F.pmod(F.xxhash64("archive", "offset"), F.lit(1 << 30)) < share)

    names = ["url_key", "captured", "archive", "offset"]
    keys = sorted(order_key(tuple(r)) for r in sample(ranges).select(*names).collect()) if ranges > 1 else []
    cuts = [keys[len(keys) * i // ranges] for i in range(1, ranges)] if keys else []
    size = settings.run_rows

    def sort_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def run_of(held: list[tuple]) -> pa.RecordBatch:
            held.sort(key=order_key)
            return _slices_batch([(number, 0, _packed(piece)) for number, piece in _pieces(held, cuts)])

        held: list[tuple] = []
        for batch in batches:
            held += zip(*(c.to_pylist() for c in batch.columns), strict=True)
            while len(held) >= size:
                yield run_of(held[:size])
                held = held[size:]
        yield run_of(held)

    schema = T.StructType([T.StructField("index_range", T.LongType()), T.StructField("index_position", T.LongType()), *LINES])

    def merge(key, group):
        runs = [((order_key(row), row) for row in _opened(block)) for block in group.column("slice").to_pylist()]
        place = key[0].as_py() * inner + key[1].as_py()
        merged = [(place, i, *row) for i, (_, row) in enumerate(LoserTree(runs))]
        return pa.Table.from_batches([_arrow(merged, schema)])

    runs = lines.select(*LINES.names).mapInArrow(sort_runs, SLICES)
    if inner > 1:
        runs = _cut_again(runs, sample(wanted), cuts, inner)
    return runs.groupBy("outer", "inner").applyInArrow(merge, schema)


def archive_and_index(
    pages: DataFrame, path: str | None = None, key: str = "page_id", url: str = "url", payload: str = "html",
    settings: ArchiveSettings = ArchiveSettings(),
) -> DataFrame:
    """Write the archives, read them back, and return their merged index with keys in their own type."""
    spark = pages.sparkSession
    path = path or staged_path(spark, "archives")
    write_archives(pages, path, key, url, payload, settings=settings)
    index = merge_index(stage(read_archives(spark, path), "index_lines"), settings)
    kind = pages.schema[key].dataType
    return index.withColumns({"key": F.col("key").cast(kind), "refers_to": F.col("refers_to").cast(kind)}).withColumnRenamed("key", key)
