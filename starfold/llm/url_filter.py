"""URL filters: exact membership by a cascade of Bloom filters, evaluated without joins or user functions.

Level 1 holds the listed keys.  Its false positives among the corpus's complete key universe are the keys of
level 2, those of level 2 among the listed keys go to level 3, and so on until a level has none.  A key of the universe is
then listed exactly if the first level that refuses it is an even one (or if the last level accepts it and is odd).

Keys: a rule ``(host, path prefix)`` is the key ``host + path``; a url's keys are the suffixes of its host's
labels with every prefix of its path whose length some rule has.  Suffixes of a number of labels that no listed entry has can't be listed
and are left out, so a host of thousands of labels has few keys.  The universe is all keys of all urls.

Every level is a bit array of at most ``MAX_BITS`` bits, made by an aggregation and put into the plan as a literal, so
what is sent to the tasks is bounded.  A list that needs more is refused with an error, never cut.

Defined results: null urls and urls without ``://`` have an empty host and path, no rule and verdict ``allow``;
repeated urls are judged alike; an empty table gives an empty result; extra columns are kept by :func:`judge`, whatever their names, but for
those of its own results.
"""

from __future__ import annotations

import math
import string
import struct
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_checkpoint, sheltered

MAX_BITS = 1 << 26
# The rules of the query (host, path prefix, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Where no rule fits: a host is listed, with its subdomains, if its label is one of these names.
BLOCKED_NAMES = ("casino-win", "free-bets", "ads-track")


class Level:
    """A Bloom filter of the distinct strings of ``keys`` (column ``key``)."""

    def __init__(self, keys: DataFrame, n: int, bits_per_key: float, seed: int):
        self.bits = 64 * max(1, math.ceil(n * bits_per_key / 64))
        if self.bits > MAX_BITS:
            raise ValueError(f"the list needs {self.bits} bits; at most {MAX_BITS} may be sent to the tasks")
        self.hashes = max(1, round(bits_per_key * math.log(2)))
        self.seed = seed
        bit = F.explode(F.array(*[self.bit(F.col("key"), j) for j in range(self.hashes)])).alias("bit")
        words = keys.select(bit).groupBy((F.col("bit") / 64).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, int(bit % 64))")).alias("mask"))
        masks = [0] * (self.bits // 64)
        for row in words.collect():  # at most MAX_BITS / 64 rows
            masks[row["word"]] = row["mask"]
        self.bytes = F.lit(bytearray(struct.pack(f"<{len(masks)}q", *masks)))

    def bit(self, key: Column, j: int) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(1000 * self.seed + j)), F.lit(self.bits))

    def has(self, key: Column) -> Column:
        found = F.lit(True)
        for j in range(self.hashes):
            bit = self.bit(key, j)
            byte = F.conv(F.hex(F.substr(self.bytes, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            found = found & (F.getbit(byte, (bit % 8).cast("int")) == 1)
        return found


class Cascade:
    """Exact membership of the keys of ``universe`` in ``listed``; both have one column ``key``."""

    def __init__(self, listed: DataFrame, universe: DataFrame, seed: int = 0):
        inside = shared_checkpoint(listed.select("key").na.drop().distinct())
        outside = shared_checkpoint(universe.select("key").na.drop().distinct().join(inside, "key", "left_anti"))
        n, others = inside.count(), outside.count()
        self.levels: list[Level] = []
        keys, rivals = inside, outside
        while n:
            ratio = max(2.0, others / n)
            level = Level(keys, n, 1.44 * math.log2(ratio) + 2, 100 * seed + len(self.levels))
            self.levels.append(level)
            # the next level's keys are this one's false positives; its rivals are the keys of this one
            keys, rivals = shared_checkpoint(rivals.filter(level.has(F.col("key")))), keys
            n, others = keys.count(), n

    def has(self, key: Column) -> Column:
        found = F.lit(len(self.levels) % 2 == 1)
        for k in range(len(self.levels) - 1, -1, -1):
            found = F.when(self.levels[k].has(key), found).otherwise(F.lit(k % 2 == 1))
        return found


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def suffixes(host: Column, counts: Column) -> Column:
    """The host's last labels, as many as each of ``counts`` (an array) says; a host with fewer has no such suffix."""
    labels = F.size(F.split(host, r"\."))
    return F.transform(F.filter(counts, lambda k: k <= labels), lambda k: F.call_function("substring_index", host, F.lit("."), -k))


def label_counts(names: Sequence[int]) -> Column:
    return F.lit(sorted(set(names))) if names else F.array().cast("array<int>")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]], listed: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``verdict`` (allow or block).

    The longest fitting rule decides; where none fits, a host is blocked if it or a domain above it is in ``listed`` (column ``key``, lower-case
    hosts).  All memberships come from cascades over all keys of all pages.
    """
    spark = pages.sparkSession
    own = ("host", "path", "rule", "verdict")
    inner, held = sheltered(pages)
    host, path = host_and_path(F.col(held[url]))
    kept = [c for c in pages.columns if c not in own]
    base = inner.select(*[held[c] for c in kept], host.alias("host"), path.alias("path"))
    lengths = sorted({len(p) for _, p, _ in rules})
    labels = label_counts([h.count(".") + 1 for h, _, _ in rules])
    names = listed.select("key").na.drop().filter("key <> ''").distinct()
    # how many labels listed names have: as many numbers as the list has lengths, however long its longest name is
    listed_labels = label_counts([r["n"] for r in names.select(F.size(F.split("key", r"\.")).alias("n")).distinct().collect()])
    prefix = F.filter(F.array(*[F.when(F.length("path") >= n, F.left(F.col("path"), F.lit(n))) for n in lengths]), lambda x: x.isNotNull())
    keys = F.flatten(F.transform(suffixes(F.col("host"), labels), lambda s: F.transform(prefix, lambda p: F.concat(s, p))))
    base = base.withColumn("keys", keys).withColumn("hosts", suffixes(F.col("host"), listed_labels))

    key_universe = shared_checkpoint(base.select(F.explode("keys").alias("key")).distinct())
    host_universe = shared_checkpoint(base.select(F.explode("hosts").alias("key")).filter("key <> ''").distinct())
    table = spark.createDataFrame([(h + p, v) for h, p, v in rules], "key string, verdict string")
    allow, block = (Cascade(table.filter(F.col("verdict") == v), key_universe, seed) for seed, v in enumerate(("allow", "block"), 1))
    spam_list = Cascade(names, host_universe, 3)

    def longest(cascade: Cascade) -> Column:
        return F.array_max(F.transform(F.filter("keys", cascade.has), lambda x: F.struct(F.length(x).alias("n"), x.alias("key"))))

    found = base.withColumns({"by_allow": longest(allow), "by_block": longest(block)})
    a, b = F.col("by_allow"), F.col("by_block")
    allowed = a.isNotNull() & (b.isNull() | (a["n"] > b["n"]))
    spam = F.exists("hosts", lambda x: (x != "") & spam_list.has(x))
    return found.select(
        *[F.col(held[c]).alias(c) for c in kept],
        "host",
        "path",
        F.when(allowed, a["key"]).otherwise(b["key"]).alias("rule"),
        F.when(allowed, "allow").when(b.isNotNull() | spam, "block").otherwise("allow").alias("verdict"),
    )


def listed_hosts(pages: DataFrame, url: str = "url") -> DataFrame:
    """(key): the query's block list, the domains of the table's hosts that begin with one of the blocked names."""
    host, _ = host_and_path(F.col(url))
    labels = F.split(host, r"\.")
    at = F.transform(labels, lambda x, i: F.when(x.isin(*BLOCKED_NAMES), i))
    first = F.array_max(at)
    # the shortest domain that begins with a name; longer ones are its subdomains
    return pages.select(F.when(first.isNotNull(), F.call_function("substring_index", host, F.lit("."), first - F.size(labels))).alias("key")).na.drop().distinct()


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, RULES, listed_hosts(pages)).select("page_id", "host", "path", "rule", "verdict")


ORACLE = r"""
with r as (select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
h as (select page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path from r),
rules as (select * from (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')) v(rh, rp, rv)),
m as (select page_id, arg_max(rh || rp, length(rh || rp)) as rule, arg_max(rv, length(rh || rp)) as rv from h join rules on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp) group by page_id)
select h.page_id, host, path, rule, coalesce(rv, case when list_has_any(string_split(host, '.'), ['casino-win', 'free-bets', 'ads-track']) then 'block' else 'allow' end) as verdict
from h left join m on h.page_id is not distinct from m.page_id"""
