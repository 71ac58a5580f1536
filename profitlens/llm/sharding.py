"""Sharding by extendible hashing, in DataFrame operations only.

The directory is indexed by the leading bits of a row's hash. It begins with
one bucket of depth 0; a bucket that holds more than ``limit`` bytes, and more
than one hash, splits on its next bit, and only that bucket does. A shard is
thus the shallowest prefix that fits. Depths are settled some bits at a time:
sizes of all prefixes of those depths come from one aggregation over the cells
of the deepest, and only rows of buckets that still do not fit see more bits.
The first round has a few thousand cells whatever the table's size, and no later
one meets a prefix that many rows share.

The hash covers key and text, so a repeated key does not fill a bucket. Rows
equal in both share a hash that no bit divides; if together they exceed the
limit, they are numbered and cut into parts that fit. A single row larger than
the limit is a shard of its own.

Edge cases: a null or empty text holds 0 bytes, a null key hashes like the
empty string; a table that fits as a whole, or is empty, is one shard or none;
extra columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profitlens.session import stage

HASH_BITS = 60
FIRST_BITS = 12
STEP = 8
BLOCK = 10_000


def row_hash(key: str, text: str) -> Column:
    """The first 60 bits of the MD5 of key and text."""
    whole = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text), F.lit("")))
    return F.conv(F.substring(F.md5(whole), 1, 15), 16, 10).cast("long")


def _cell(depth: int) -> Column:
    return F.shiftright("hash", HASH_BITS - depth)


def _settled(rows: DataFrame, limit: int, first: int, last: int) -> DataFrame:
    """(cell, depth): the bucket depth of each cell of ``last`` bits; depth is null if none fits."""
    cells = rows.groupBy(_cell(last).alias("cell")).agg(
        F.sum(F.col("n_bytes") * F.col("copies")).alias("size"), F.min("hash").alias("low"), F.max("hash").alias("high")
    )
    levels = cells.withColumn("depth", F.explode(F.sequence(F.lit(first), F.lit(last))))
    levels = levels.withColumn("bucket", F.expr(f"shiftright(cell, {last} - depth)"))
    sizes = levels.groupBy("depth", "bucket").agg(F.sum("size").alias("size"), F.min("low").alias("low"), F.max("high").alias("high"))
    fit = sizes.filter((F.col("size") <= limit) | (F.col("low") == F.col("high"))).select("depth", "bucket")
    # of nested prefixes that fit, the shallowest is the bucket: its parent does not fit
    parents = fit.select((F.col("depth") + 1).alias("depth"), F.col("bucket").alias("parent"))
    buckets = fit.withColumn("parent", F.shiftright("bucket", 1)).join(parents, ["depth", "parent"], "left_anti")
    ends = [F.expr(f"shiftleft({start}, {last} - depth)") for start in ("bucket", "bucket + 1")]
    covered = buckets.select("depth", F.explode(F.sequence(ends[0], ends[1] - 1)).alias("cell"))
    return cells.select("cell").join(covered, "cell", "left")


def assign(docs: DataFrame, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, depth, shard, part) of each row of ``docs``.

    ``shard`` is the bucket's bits, ``part`` is 0 unless equal rows had to be cut.
    """
    own = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    sized = own.select("key", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), row_hash("key", "text").alias("hash"))
    rows = stage(sized.groupBy("key", "n_bytes", "hash").agg(F.count("*").alias("copies")), "row_hashes")
    first, last, open_rows, done = 0, FIRST_BITS, rows, []
    while True:
        cells = stage(_settled(open_rows, limit, first, last), "bucket_depths")
        placed = open_rows.join(cells.withColumnRenamed("cell", "own_cell"), _cell(last) == F.col("own_cell")).drop("own_cell")
        done.append(placed.filter(F.col("depth").isNotNull()))
        if last == HASH_BITS or cells.filter(F.col("depth").isNull()).isEmpty():
            break
        open_rows = stage(placed.filter(F.col("depth").isNull()).drop("depth"), "open_buckets")
        first, last = last + 1, min(HASH_BITS, last + STEP)
    leaves = done[0]
    for more in done[1:]:
        leaves = leaves.unionByName(more)
    return _parts(leaves, limit).select(
        F.col("key").alias(key),
        "n_bytes",
        "depth",
        F.when(F.col("depth") == 0, "").otherwise(F.lpad(F.bin(F.expr(f"shiftright(hash, {HASH_BITS} - depth)")), 60, "0").substr(61 - F.col("depth"), F.col("depth"))).alias("shard"),
        "part",
    )


def _parts(leaves: DataFrame, limit: int) -> DataFrame:
    """One row per original row; equal rows are numbered, in two steps so that no task makes them all."""
    oversized = F.col("n_bytes") * F.col("copies") > limit
    each = F.greatest(F.floor(F.lit(limit) / F.greatest("n_bytes", F.lit(1))), F.lit(1)).cast("long")
    single = leaves.filter("copies = 1").withColumn("part", F.lit(0).cast("long"))
    many = leaves.filter("copies > 1").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {BLOCK}"))))
    many = many.repartition("hash", "block")
    start = F.col("block") * BLOCK
    numbered = many.withColumn("number", F.explode(F.sequence(start, F.least(start + BLOCK, F.col("copies")) - 1)))
    numbered = numbered.withColumn("part", F.when(oversized, F.floor(F.col("number") / each)).otherwise(0).cast("long"))
    return single.unionByName(numbered.drop("block", "number"))
