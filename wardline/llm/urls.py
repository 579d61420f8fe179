"""URL filter lists held in a cascade of Bloom filters.

Odd levels hold listed keys, even levels hold the keys of the corpus that the level before took for listed by mistake.
A key is followed down to the first level that does not know it; the number of that level tells whether it is listed.
Because every mistake over the corpus's complete key universe is held by the next level, the answer is exact for every
key of that universe, and a page is judged by bit tests alone, without a join.

Sizes: the first level's error rate is (listed keys / keys of the universe), so about as many keys slip through as are
listed, and each later level holds about half of the one before. All levels together take a few dozen bits for a listed
key, whatever the corpus holds. A list whose first level would exceed ``MAX_BITS`` is cut by the hash of its keys into as
many cascades as keep below it.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import ascii_lower, bound
from wardline.session import stable

#: Size of a level (16 MB of bits), above which the keys are cut into more cascades.
MAX_BITS = 1 << 27


@dataclass(frozen=True)
class Rule:
    """``action`` (allow or block) for a host with its subdomains and paths that start with ``path``."""

    action: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Level:
    number: int
    bits: int
    hashes: int
    words: tuple[int, ...]

    def positions(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.number * 64 + j)), F.lit(self.bits)) for j in range(self.hashes)]

    def holds(self, key: Column) -> Column:
        # The words stand in the plan once, however many positions are looked up in them.
        def all_set(words: Column) -> Column:
            bits = [F.getbit(F.get(words, F.shiftright(at, 6).cast("int")), F.pmod(at, F.lit(64)).cast("int")) for at in self.positions(key)]
            return reduce(lambda a, b: a & b, [bit == 1 for bit in bits])

        return bound(F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>"), all_set)


@dataclass(frozen=True)
class Cascades:
    """A cascade for each part of the keys, by hash."""

    parts: tuple[Cascade, ...]

    def lists(self, key: Column) -> Column:
        part = part_of(key, len(self.parts))
        listed = self.parts[-1].lists(key)
        for n, cascade in list(enumerate(self.parts))[-2::-1]:
            listed = F.when(part == n, cascade.lists(key)).otherwise(listed)
        return listed


def part_of(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(parts))


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def lists(self, key: Column) -> Column:
        """Whether a key of the universe is listed; null and keys outside the universe have no exact answer."""
        listed = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            listed = F.when(~level.holds(key), F.lit(level.number % 2 == 0)).otherwise(listed)
        return listed


def _fill(keys: DataFrame, level: Level) -> Level:
    """The level with the bits of ``keys``; at most ``bits / 64`` words come to the driver."""
    rows = (
        keys.select(F.explode(F.array(*level.positions(F.col("key")))).alias("at"))
        .groupBy(F.shiftright("at", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("mask"))
        .collect()
    )
    words = [0] * (level.bits // 64)
    for row in rows:
        words[row["word"]] = row["mask"]
    return Level(level.number, level.bits, level.hashes, tuple(words))


def _first_level(n_holders: int, n_universe: int) -> tuple[int, int]:
    """Hashes and bits of a first level."""
    hashes = max(1, math.ceil(-math.log2(min(0.5, max(n_holders, 1) / max(n_universe, 1)))))
    return hashes, _bits(n_holders, hashes)


def _bits(keys: int, hashes: int) -> int:
    return 64 * math.ceil(max(64, keys * hashes / math.log(2)) / 64)


def build_cascade(universe: DataFrame, listed: DataFrame, max_bits: int | None = None) -> Cascades:
    """Filters that tell the ``key`` of ``listed`` from all others of ``universe`` (both: a string column ``key``).

    Null keys and repeated ones count once or not at all; listed keys outside the universe are left out. Nothing
    listed: an empty cascade, which lists nothing. Nothing unlisted: one level, which lists everything.
    """
    universe = stable(universe.select("key").where(F.col("key").isNotNull()).distinct())
    inside = stable(universe.join(listed.select("key"), "key", "left_semi"))
    n_universe, n_holders = universe.count(), inside.count()
    # A tenth is left for parts that hold more keys than the others.
    parts = math.ceil(_first_level(n_holders, n_universe)[1] * 1.1 / (max_bits or MAX_BITS))
    if parts <= 1:
        return Cascades((_cascade(universe, inside, n_universe, n_holders),))
    cascades = []
    for n in range(parts):
        own, held = (df.where(part_of(F.col("key"), parts) == n) for df in (universe, inside))
        cascades.append(_cascade(own, held, own.count(), held.count()))
    return Cascades(tuple(cascades))


def _cascade(universe: DataFrame, inside: DataFrame, n_universe: int, n_holders: int) -> Cascade:
    holders, others = inside, universe.join(inside, "key", "left_anti")
    hashes, bits = _first_level(n_holders, n_universe)
    levels: list[Level] = []
    while n_holders:
        level = _fill(holders, Level(len(levels) + 1, bits, hashes, ()))
        levels.append(level)
        slipped = stable(others.where(level.holds(F.col("key"))))
        holders, others, n_holders = slipped, holders, slipped.count()
        hashes, bits = 1, _bits(n_holders, 1)
    return Cascade(tuple(levels))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty where it is null or has no ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + F.lit(3), F.length(url)))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def candidate_keys(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The keys under which a rule could list the url: host suffixes by path prefixes, for the label counts and path
    lengths that occur among the rules. Structs of (length, host length, key), null where the url is too short."""
    labels = sorted({rule.host.count(".") + 1 for rule in rules})
    lengths = sorted({len(rule.path) for rule in rules})
    dots = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit("")))
    found = []
    for n in labels:
        suffix = F.substring_index(host, ".", -n)
        for length in lengths:
            key = F.concat(suffix, F.substring(path, 1, length))
            fits = (dots >= n - 1) & (F.length(path) >= length) & (suffix != "")
            named = F.struct(F.length(key).alias("size"), F.length(suffix).alias("host_size"), key.alias("key"))
            found.append(F.when(fits, named))
    return F.array(*found)


def judge_urls(pages: DataFrame, rules: Sequence[Rule], default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page, its rows kept one for one.

    The longest listed key decides (of equally long ones that with the longer host); its rule is named as host and
    path, and its verdict is the rule's action. A url without a listed key has rule null and the verdict ``default``:
    none of its keys is on the block list. Null or malformed urls have empty host and path and no listed key. Other
    columns of ``pages`` are not looked at; an empty table gives an empty result. No rules: every verdict is ``default``.
    """
    actions: dict[str, str] = {}
    for rule in rules:
        if actions.setdefault(rule.key, rule.action) != rule.action:
            raise ValueError(f"two actions for {rule.key}")
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    pages = pages.select("page_id", host.alias("host"), path.alias("path"))
    if not rules:
        return pages.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    pages = pages.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), rules))
    universe = pages.select(F.explode("keys").alias("k")).select("k.key")

    def keys(names: list[str]) -> DataFrame:
        return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(names)), "array<string>")).alias("key"))

    listed, blocked = keys(list(actions)), keys([k for k, action in actions.items() if action == "block"])
    universe = stable(universe.where(F.col("key").isNotNull()).distinct())
    ruled, blocks = build_cascade(universe, listed), build_cascade(universe, blocked)
    hit = F.array_max(F.filter("keys", lambda k: k.isNotNull() & ruled.lists(k["key"])))["key"]
    judged = pages.withColumn("rule", hit)
    verdict = F.when(F.col("rule").isNull(), default).when(blocks.lists(F.col("rule")), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
