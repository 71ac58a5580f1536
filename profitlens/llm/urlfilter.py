"""URL rules answered by cascades of Bloom filters, in DataFrame operations only.

A rule (host, path, verdict) fits its host, all subdomains of it, and the paths
that begin with its path; the longest fitting rule decides, of equally long ones
that of the longer host, and of two verdicts for one key the block. A URL thus
asks about few keys: for each shape of the rules (labels of the host, characters
of the path) its own last labels and first characters. All keys that the corpus
asks about, distinct, are the universe of the cascades.

Each verdict's rules are one cascade. Level 1 encodes the listed keys of the
universe, level 2 the unlisted keys that level 1 lets through, level 3 the
listed keys that level 2 lets through, and so on until none passes. The first
level that lacks a key then says whether it is listed, for every key of the
universe and without error. Urls meet the levels as scalar subqueries: there is
no join, and listed keys that the corpus never asks about take no space.

A level is an array of 64-bit words. A key sets up to eight bits in each of a
few words; the first level is as selective as leaves about as many false
positives as there are listed keys, later levels let half of them through. Each
level hashes with a seed of its own, so two keys that collide in one are told
apart by another.

No level is larger than ``filter_words``: a longer list is cut by a hash of the
key into parts, and the urls pass the cascades of one part after the other. The
same passes hold at most ``shapes_a_pass`` shapes each, so plans stay small.

Edge cases: a null url, or one without ``://``, has an empty host and path and
meets no rule but one for the empty host; urls are judged row by row, repeated ones alike;
rules without host, or whose host holds ``/``, ``?`` or ``#``, fit nothing; a
null path of a rule is the empty one; repeated rules count once; without rules,
or with an empty table, every verdict is the default or there is no row; columns
other than the two named play no part.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profitlens.session import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BITS_A_WORD = 8


@dataclass(frozen=True)
class CascadeSettings:
    """``filter_words`` bounds the 64-bit words of a level (1 MB), ``shapes_a_pass`` the keys a url asks about at once."""

    filter_words: int = 1 << 17
    shapes_a_pass: int = 16
    default: str = "allow"


@dataclass(frozen=True)
class Level:
    """One Bloom filter: a one-row table with the array ``words``, and how keys find their bits in it."""

    table: DataFrame
    size: int
    words_a_key: int
    bits: int
    seed: int

    def holds(self, key: Column) -> Column:
        words = self.table.scalar()
        found = F.lit(True)
        for at, mask in _places(key, self.size, self.words_a_key, self.bits, self.seed):
            found = found & (F.get(words, at.cast("int")).bitwiseAND(mask) == mask)
        return found


def lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def host_and_path(url: str) -> tuple[Column, Column]:
    """Both empty without ``://``."""
    at = F.instr(F.col(f"`{url}`"), "://")
    rest = F.when(at > 0, F.substring(F.col(f"`{url}`"), at + 3, F.length(F.col(f"`{url}`"))))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.coalesce(lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\."))


def _places(key: Column, size: int, words_a_key: int, bits: int, seed: int) -> list[tuple[Column, Column]]:
    """(word, mask) of each word that holds bits of the key."""
    places = []
    for j in range(words_a_key):
        at = F.pmod(F.xxhash64(key, F.lit(seed), F.lit(2 * j)), F.lit(size))
        mixed = F.xxhash64(key, F.lit(seed), F.lit(2 * j + 1))
        mask = F.lit(0).cast("long")
        for i in range(bits):
            place = F.shiftrightunsigned(mixed, 6 * i).bitwiseAND(F.lit(63)).cast("int")
            mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
        places.append((at, mask))
    return places


def _form(listed: int, others: int) -> tuple[int, int, int]:
    """(words, words of a key, bits in each) of a filter that lets about as many others through as are listed."""
    passing = min(0.5, max(1e-12, math.sqrt(0.5) * listed / max(1, others)))
    bits = math.ceil(-math.log2(passing))
    words_a_key = math.ceil(bits / BITS_A_WORD)
    # half as many bits again as a filter whose bits lie anywhere
    return max(1, math.ceil(1.5 * 1.44 * bits * listed / 64)), words_a_key, math.ceil(bits / words_a_key)


def _level(keys: DataFrame, size: int, words_a_key: int, bits: int, seed: int) -> Level:
    spark = keys.sparkSession
    places = [F.struct(at.alias("at"), mask.alias("mask")) for at, mask in _places(F.col("key"), size, words_a_key, bits, seed)]
    set_bits = keys.select(F.inline(F.array(*places))).groupBy("at").agg(F.bit_or("mask").alias("mask"))
    every = spark.range(size).select(F.col("id").alias("at"), F.lit(0).cast("long").alias("mask"))
    words = set_bits.unionByName(every).groupBy("at").agg(F.bit_or("mask").alias("mask"))
    whole = words.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "mask"))), lambda w: w["mask"]).alias("words"))
    return Level(stage(whole, "filter_words"), size, words_a_key, bits, seed)


def cascade(universe: DataFrame, n_listed: int, n_others: int) -> list[Level]:
    """Levels over (key, listed): exact for each of these keys. Without listed keys there is no level."""
    levels: list[Level] = []
    inside, outside = universe.filter("listed").select("key"), universe.filter("not listed").select("key")
    while n_listed:
        levels.append(_level(inside, *_form(n_listed, n_others), seed=len(levels)))
        passed = stage(outside.filter(levels[-1].holds(F.col("key"))), "filter_passed")
        inside, outside = passed, inside
        n_listed, n_others = passed.count(), n_listed
    return levels


def is_listed(levels: list[Level], key: Column) -> Column:
    """The first level without the key decides; one that all levels hold is of the kind that the last one encodes."""
    answer = F.lit(len(levels) % 2 == 1)
    for depth in reversed(range(len(levels))):
        answer = F.when(levels[depth].holds(key), answer).otherwise(F.lit(depth % 2 == 1))
    return answer


def clean_rules(rules: DataFrame) -> DataFrame:
    """(key, labels, characters, blocks), one row per key."""
    own = rules.select(lower("host").alias("host"), F.coalesce("path", F.lit("")).alias("path"), (F.col("verdict") == "block").alias("blocks"))
    usable = own.filter(F.col("host").isNotNull() & ~F.col("host").rlike("[/?#]"))
    shaped = usable.select(F.concat("host", "path").alias("key"), _labels(F.col("host")).alias("labels"), F.length("path").alias("characters"), "blocks")
    return shaped.groupBy("key", "labels", "characters").agg(F.max(F.coalesce("blocks", F.lit(False))).alias("blocks"))


def _key(labels: int, characters: int) -> Column:
    """What a url asks about rules of this shape; null where it is too short for them."""
    fits = (_labels(F.col("host")) >= labels) & (F.length("path") >= characters)
    return F.when(fits, F.concat(F.substring_index("host", ".", -labels), F.substring("path", 1, characters)))


def judge(
    pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", settings: CascadeSettings = CascadeSettings()
) -> DataFrame:
    """(key, host, path, rule, verdict) of each row; ``rule`` is host and path of the rule that decides, or null."""
    host, path = host_and_path(url)
    rows = pages.select(F.col(f"`{key}`").alias("id"), host.alias("host"), path.alias("path"))
    listed = stage(clean_rules(rules), "rules")
    shapes = sorted((r["labels"], r["characters"]) for r in listed.select("labels", "characters").distinct().collect())
    best = F.lit(None).cast("struct<length int, labels int, blocks boolean, key string>")
    rows = rows.withColumn("best", best)
    passes = 0
    for start in range(0, len(shapes), settings.shapes_a_pass):
        part = shapes[start : start + settings.shapes_a_pass]
        shown = rows.select(F.explode(F.array_compact(F.array(*[_key(*shape) for shape in part]))).alias("key"))
        of_shape = F.struct("labels", "characters").isin([F.struct(F.lit(a), F.lit(b)) for a, b in part])
        both = shown.select("key", F.lit(True).alias("asked"), F.lit(None).cast("boolean").alias("blocks"))
        both = both.unionByName(listed.filter(of_shape).select("key", F.lit(False).alias("asked"), "blocks"))
        # one aggregation marks the listed keys among those asked about
        universe = stage(both.groupBy("key").agg(F.max("asked").alias("asked"), F.max("blocks").alias("blocks")).filter("asked").drop("asked"), "key_universe")
        n, n_block, n_allow = universe.agg(F.count("*"), F.count_if(F.col("blocks")), F.count_if(~F.col("blocks"))).first()
        parts = max(1, *(math.ceil(_form(m, n - m)[0] / settings.filter_words) for m in (n_block, n_allow)))
        for number in range(parts):
            own = F.pmod(F.xxhash64("key", F.lit(-1)), F.lit(parts)) == number
            within = universe.filter(own) if parts > 1 else universe
            if parts > 1:
                n, n_block, n_allow = within.agg(F.count("*"), F.count_if(F.col("blocks")), F.count_if(~F.col("blocks"))).first()
            block = cascade(within.select("key", F.coalesce("blocks", F.lit(False)).alias("listed")), n_block, n - n_block)
            allow = cascade(within.select("key", F.coalesce(~F.col("blocks"), F.lit(False)).alias("listed")), n_allow, n - n_allow)
            if passes:
                rows = stage(rows, "urls_judged")
            rows, passes = rows.withColumn("best", _best(part, block, allow, number, parts)), passes + 1
    rule = F.col("best.key")
    verdict = F.when(rule.isNull(), F.lit(settings.default)).when(F.col("best.blocks"), "block").otherwise("allow")
    return rows.select(F.col("id").alias(key), "host", "path", rule.alias("rule"), verdict.alias("verdict"))


def _best(shapes: list[tuple[int, int]], block: list[Level], allow: list[Level], number: int, parts: int) -> Column:
    """The longest of the listed keys among these shapes and the best so far."""
    found = [F.col("best")]
    for labels, characters in shapes:
        key = _key(labels, characters)
        mine = F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(parts)) == number
        blocks, allows = is_listed(block, key), is_listed(allow, key)
        entry = F.struct(F.length(key).alias("length"), F.lit(labels).alias("labels"), blocks.alias("blocks"), key.alias("key"))
        found.append(F.when(key.isNotNull() & mine & (blocks | allows), entry))
    return F.array_max(F.array(*found))
