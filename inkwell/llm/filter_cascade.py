"""URL filters by a Bloom filter cascade: exact membership over a known key universe.

Level 0 holds the listed keys. Level 1 holds the keys of the universe that are not listed but
pass level 0, level 2 the listed keys that pass level 1, and so on, until no key passes wrongly.
As the universe is the set of all hosts of the corpus, the answer is exact for each of its rows.
A cascade needs some bits per listed key and none for the rest, so it is small; it is tested
inside the scan, without a join.
"""

from __future__ import annotations

import math
import struct
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import checkpointed

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    """A host (with all its subdomains) and a prefix of the path."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Level:
    """One Bloom filter: its bits, their number and the probes per key."""

    bits: bytes
    size: int
    probes: int


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; both empty for a null or a url without ``://``."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, UPPER.lower())
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def _positions(key: Column, level: int, size: int, probes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(level), F.lit(i), key), F.lit(size)) for i in range(probes)]


def _passes(key: Column, level: int, filter_: Level) -> Column:
    def bit(position: Column) -> Column:
        byte = F.substring(F.lit(filter_.bits), (F.floor(position / 8) + 1).cast("int"), F.lit(1))
        value = F.conv(F.hex(byte), 16, 10).cast("int")
        return F.getbit(value, (position % 8).cast("int")) == 1

    return reduce(
        lambda a, b: a & b,
        [bit(p) for p in _positions(key, level, filter_.size, filter_.probes)],
    )


def member(key: Column, levels: list[Level]) -> Column:
    """Whether a key of the universe is listed: decided by the first level it does not pass."""
    answer = F.lit(len(levels) % 2 == 1)
    for i in reversed(range(len(levels))):
        answer = F.when(_passes(key, i, levels[i]), answer).otherwise(F.lit(i % 2 == 1))
    return answer


def _shape(count: int, rate: float) -> tuple[int, int]:
    """Bits (a multiple of 64) and probes of a filter for so many keys and this rate of errors."""
    probes = max(1, round(math.log2(1 / rate)))
    return max(64, math.ceil(count * probes / math.log(2) / 64) * 64), probes


def _built(keys: DataFrame, level: int, size: int, probes: int) -> Level:
    """A filter over the ``key`` column. Only its words, whose number is known, are fetched."""
    words = (
        keys.select(F.explode(F.array(*_positions(F.col("key"), level, size, probes))).alias("p"))
        .groupBy(F.floor(F.col("p") / 64).cast("int").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("bits"))
    )
    content = bytearray(size // 8)
    for row in words.collect():
        struct.pack_into("<q", content, row.word * 8, row.bits)
    return Level(bytes(content), size, probes)


def cascade(universe: DataFrame, max_bytes: int = 1 << 20, max_levels: int = 64) -> list[Level] | None:
    """The levels for a universe (``key``, ``listed``) of distinct keys.

    Returns None when the filters would need more than ``max_bytes``; callers then join instead.
    An empty list of levels means that nothing is listed.
    """
    counts = universe.agg(
        F.count_if("listed").alias("listed"), F.count_if(~F.col("listed")).alias("others")
    ).first()
    count, others = counts.listed, counts.others
    levels: list[Level] = []
    rate = min(0.5, math.sqrt(0.5) * count / others) if count and others else 0.5
    while count:
        size, probes = _shape(count, rate)
        if len(levels) == max_levels or sum(len(x.bits) for x in levels) + size // 8 > max_bytes:
            return None
        side = F.col("listed") if len(levels) % 2 == 0 else ~F.col("listed")
        passed = [_passes(F.col("key"), i, x) for i, x in enumerate(levels)]
        inside = universe.where(reduce(lambda a, b: a & b, passed, side))
        levels.append(_built(inside, len(levels), size, probes))
        wrong = reduce(lambda a, b: a & b, [*passed, _passes(F.col("key"), len(levels) - 1, levels[-1])], ~side)
        count, rate = universe.where(wrong).count(), 0.5
    return levels


def filter_urls(
    pages: DataFrame,
    rules: list[Rule],
    url: str = "url",
    max_bytes: int = 1 << 20,
) -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    The longest fitting rule decides. A page without one is blocked when its host is listed: hosts
    with more pages blocked than allowed by rules, taken from all pages, are. Listing is looked up in the cascade; when it would outgrow ``max_bytes`` a join gives the same answer.
    Nulls and urls without ``://`` have an empty host and path, fit no rule and are allowed.
    Columns of ``pages`` called host, path, rule or verdict are replaced. Repeated rows are kept.
    """
    host, path = host_and_path(F.col(url))
    parts = pages.drop("host", "path", "rule", "verdict").withColumn("host", host).withColumn("path", path)
    name, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    ruled = parts.withColumn("rule", name).withColumn("_ruled", verdict)
    universe = checkpointed(
        ruled.groupBy(F.col("host").alias("key"))
        .agg(
            F.count_if(F.col("_ruled") == "block").alias("blocked"),
            F.count_if(F.col("_ruled") == "allow").alias("allowed"),
        )
        .select("key", (F.col("blocked") > F.col("allowed")).alias("listed"))
    )
    levels = cascade(universe, max_bytes)
    if levels is None:
        hosts = universe.where("listed").select(F.col("key").alias("host"), F.lit(True).alias("_listed"))
        judged = ruled.join(hosts, "host", "left")
        is_listed = F.coalesce("_listed", F.lit(False))
    else:
        judged, is_listed = ruled, member(F.col("host"), levels)
    method = F.when(is_listed, F.lit("block")).otherwise(F.lit("allow"))
    return judged.withColumn("verdict", F.coalesce("_ruled", method)).drop("_ruled", "_listed")
