"""Verdicts on URLs by lists of hosts and paths, kept as a cascade of Bloom filters.

The first filter holds the listed keys. Of all keys that occur in the corpus, those
that it takes for listed by mistake are put in a second filter, the listed keys which
that one takes in a third, and so on until none is left. A look-up walks down
the levels until one says no, and is exact for every key of the corpus without a join.

A key is a host, or a domain above it, followed by the start of the path. A rule tells how many labels and how many
characters of the path its key takes, so a URL has one key for each such shape among the rules.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomegauge.llm.common import new_names, stored

#: Bytes of filters that tasks hold at once. A longer list is worked off in blocks, one after the other.
FILTER_BYTES = 64 << 20
#: Hashes a key has in every level but the first: a 64th of the keys goes on to the next level.
HASHES = 6
#: Bits of a piece of a filter, as Spark's bitmap functions have them.
PIECE_BITS = 32768
#: What the columns added to the caller's are called.
ADDED = ["host", "path", "rule", "verdict"]


def _rest(url: Column) -> Column:
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """What is between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased; else empty."""
    found = F.regexp_extract(_rest(url), "^[^/?#]*", 0)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty without a ``://``."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def labels(name: Column) -> Column:
    """Number of dot-separated labels of a host."""
    return F.length(name) - F.length(F.replace(name, F.lit("."), F.lit(""))) + 1


def keys(name: Column, start: Column, shapes: list[tuple[int, int]]) -> Column:
    """The keys of a URL, one per shape that it can fill, as structs whose greatest is the longest key; of equally long ones that with the longer host."""
    kinds = F.array(*[F.struct(F.lit(n).alias("labels"), F.lit(size).alias("size")) for n, size in shapes])

    def key(shape: Column) -> Column:
        above = F.call_function("substring_index", name, F.lit("."), -shape["labels"])
        whole = F.concat(above, F.left(start, shape["size"]))
        fits = (labels(name) >= shape["labels"]) & (F.length(start) >= shape["size"])
        return F.when(fits, F.struct(F.length(whole).alias("length"), F.length(above).alias("host_length"), whole.alias("key")))

    return F.array_compact(F.transform(kinds, key))


class BloomFilter:
    """Bits as one byte string; a key is in if all its bits are set."""

    def __init__(self, listed: DataFrame, level: int, count: int, hashes: int) -> None:
        """Of a table ``key`` with ``count`` rows. Tasks build the pieces of the filter, only these reach the driver."""
        self.seeds = [level * 1000 + k for k in range(hashes)]
        self.size = max(1024, -(-math.ceil(count * hashes / math.log(2)) // 8) * 8)
        places = listed.select(F.explode(F.array(*[self._place(F.col("key"), s) for s in self.seeds])).alias("place"))
        pieces = places.groupBy((F.col("place") / PIECE_BITS).cast("long").alias("piece")).agg(
            F.bitmap_construct_agg(F.col("place") % PIECE_BITS).alias("bits")
        )
        found = {row.piece: bytes(row.bits) for row in pieces.toLocalIterator()}
        none = bytes(PIECE_BITS // 8)
        self.bits = b"".join(found.get(k, none) for k in range(-(-self.size // PIECE_BITS)))[: self.size // 8]

    def _place(self, key: Column, seed: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(self.size).cast("long"))

    def may_hold(self, key: Column) -> Column:
        held = F.lit(True)
        for seed in self.seeds:
            place = self._place(key, seed)
            byte = F.substring(F.lit(self.bits), (place / 8).cast("int") + 1, F.lit(1))
            held = held & (F.getbit(F.ascii(F.decode(byte, "ISO-8859-1")).cast("long"), (place % 8).cast("int")) == 1)
        return held


class Cascade:
    """Exact membership in a list for all keys of a universe; for other keys it may err."""

    def __init__(self, listed: DataFrame, universe: DataFrame, size: int) -> None:
        """``listed`` and ``universe`` are tables ``key``; the universe has at most ``size`` distinct keys and may repeat them.

        The universe is read once. The first level is as selective as leaves about as many mistaken keys as there
        are listed ones, so all further levels work on tables of the order of the list.
        """
        self.levels: list[BloomFilter] = []
        inside = stored(listed.where(F.col("key").isNotNull()).distinct(), "filter-keys")
        count = inside.count()
        if not count:
            return
        hashes = max(HASHES, math.ceil(math.log2(max(1, size) / count / math.sqrt(0.5)))) if size > count else HASHES
        first = BloomFilter(inside, 1, count, hashes)
        self.levels.append(first)
        taken = universe.where(first.may_hold(F.col("key"))).select("key", F.lit(0).alias("listed"))
        both = taken.union(inside.select("key", F.lit(1))).groupBy("key").agg(F.max("listed").alias("listed"))
        mistaken = stored(both.where("listed = 0").select("key"), "filter-keys")
        outside = inside
        while count := mistaken.count():
            level = BloomFilter(mistaken, len(self.levels) + 1, count, HASHES)
            self.levels.append(level)
            mistaken, outside = stored(outside.where(level.may_hold(F.col("key"))), "filter-keys"), mistaken

    def holds(self, key: Column) -> Column:
        found = F.lit(False)
        for level in reversed(self.levels):
            found = level.may_hold(key) & ~found
        return found

    def bytes(self) -> int:
        return sum(len(level.bits) for level in self.levels)


def _blocks(count: int, size: int, most: int) -> int:
    bits = 2 * count * (max(HASHES, math.log2(max(2, size) / max(1, count) + 2)) + HASHES) / math.log(2)
    return max(1, math.ceil(bits / 8 / most))


def _in_block(key: Column, block: int, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)) == block if blocks > 1 else key.isNotNull()


def _listed_in(cascade: Cascade, block: int, blocks: int) -> Callable[[Column], Column]:
    return lambda k: _in_block(k["key"], block, blocks) & cascade.holds(k["key"])


def judged(pages: DataFrame, rules: DataFrame, other: str = "allow", filter_bytes: int = FILTER_BYTES,
           watch: Callable[[Cascade], None] | None = None) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict`` of the column ``url``.

    ``rules(host, path, verdict)``: a rule fits its host and all hosts below, if the URL's path starts with the
    rule's. The longest rule that fits wins, of equally long ones the one with the longer host. ``rule`` is its host and path
    in one, ``verdict`` is its own, ``allow`` or ``block``; without a rule they are null and ``other``. A null URL or
    one without ``://`` has an empty host and path and no rule. Hosts of rules are compared in lower case; rules without a host
    or with another verdict are left out, a null path is empty, and of rules for the same host and path ``block`` wins.
    Columns of ``pages`` with the names added are replaced, all others are kept; rows that repeat are judged
    alike and kept, and an empty table gives no rows.

    The URLs are read once per block of rules to find mistaken keys, and once to be judged. ``filter_bytes`` bounds a block.
    ``watch`` is shown each cascade.
    """
    lower = F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    start = F.coalesce("path", F.lit(""))
    rules = rules.where("host <> '' and verdict in ('allow', 'block')").select(
        labels(lower).alias("labels"), F.length(start).alias("size"), F.concat(lower, start).alias("key"), "verdict"
    )
    rules = rules.groupBy("labels", "size", "key").agg(F.max("verdict").alias("verdict"))
    rules = stored(rules, "filter-rules")
    kept = new_names(pages, ADDED)
    url = F.col("url").cast("string")
    rows = kept.select(F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("row"), host(url).alias("host"), path(url).alias("path"))
    shapes = [tuple(row) for row in rules.select("labels", "size").distinct().orderBy("labels", "size").collect()]
    rows = rows.withColumn("best", F.lit(None).cast("struct<length:int,host_length:int,key:string,verdict:string>"))
    if shapes:
        universe = pages.select(host(url).alias("host"), path(url).alias("path"))
        universe = universe.select(F.explode(keys(F.col("host"), F.col("path"), shapes)["key"]).alias("key"))
        size = pages.count() * len(shapes)
        blocks = _blocks(rules.count(), size, filter_bytes)
        for block in range(blocks):
            own = rules.where(_in_block(F.col("key"), block, blocks))
            listed = Cascade(own.select("key"), universe.where(_in_block(F.col("key"), block, blocks)), size)
            blocked = Cascade(own.where("verdict = 'block'").select("key"), own.select("key"), max(1, own.count()))
            for cascade in (listed, blocked):
                if watch:
                    watch(cascade)
            found = F.array_max(F.filter(keys(F.col("host"), F.col("path"), shapes), _listed_in(listed, block, blocks)))
            rows = rows.withColumn("found", found).withColumn(
                "found",
                F.when(F.col("found").isNotNull(), F.struct(
                    "found.length", "found.host_length", "found.key",
                    F.when(blocked.holds(F.col("found.key")), "block").otherwise("allow").alias("verdict"),
                )),
            )
            rows = rows.withColumn("best", F.greatest("best", "found")).drop("found")
            if block + 1 < blocks:
                rows = stored(rows, "filter-judged")
    return rows.select("row.*", "host", "path", F.col("best.key").alias("rule"), F.coalesce("best.verdict", F.lit(other)).alias("verdict"))
