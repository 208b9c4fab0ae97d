"""URL rules decided by a cascade of Bloom filters.

Level 0 encodes the listed keys. The keys of the corpus that pass it without being listed are
encoded by level 1, the listed keys that pass that by level 2, and so on until no key passes
wrongly. As the levels were built over the complete key universe of the corpus, the first level
that rejects a key tells exactly whether it is listed: no join and no list at look-up time.

Keys are 128-bit hashes, so two keys of the universe are taken for one with a chance of 2^-128.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import LOWER, UPPER, aside, restored, written
from sievework.llm.shingles import mixed

# A level may have this many bits (256 MB); more is an error, not a larger broadcast.
MOST_BITS = 1 << 31
_WORD = 32  # bits held by one row while a level is built


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str


class Level(NamedTuple):
    number: int  # each level hashes anew, or wrong passes would repeat
    bits: np.ndarray  # bytes
    size: int
    hashes: int

    def places(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bits of each key, a row per hash."""
        seed = np.uint64((self.number + 1) * 0x9E3779B97F4A7C15 % 2**64)
        first, step = mixed(a ^ seed), mixed(b ^ seed) | np.uint64(1)
        times = np.arange(self.hashes, dtype=np.uint64)[:, None]
        return (first + times * step) % np.uint64(self.size)

    def holds(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        at = self.places(a, b)
        return ((self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def holds(levels: Sequence[Level], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Membership of each key: the parity of the level that rejects it first."""
    depth = np.zeros(len(a), np.int64)
    alive = np.ones(len(a), bool)
    for level in levels:
        alive &= level.holds(a, b)
        depth += alive
    return depth % 2 == 1


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def candidate_keys(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Every string that a rule fitting this host and path could have, the longest first.

    Host suffixes with as many labels as some rule has, times path prefixes as long as some rule's.
    """
    labels = F.split(host, r"\.")
    depths = sorted({r.host.count(".") + 1 for r in rules})
    lengths = sorted({len(r.path) for r in rules})
    made = []
    for depth in depths:
        suffix = F.array_join(F.slice(labels, F.greatest(F.size(labels) - depth + 1, F.lit(1)), depth), ".")
        for n in lengths:
            fits = (F.size(labels) >= depth) & (F.length(path) >= n) & (host != "")
            made.append(F.when(fits, F.concat(suffix, F.substring(path, 1, n))))
    by_length = lambda x, y: F.length(y) - F.length(x)
    return F.array_sort(F.array_compact(F.array(*made)), by_length)


def _key(column: Column) -> tuple[Column, Column]:
    return F.xxhash64(column), F.xxhash64(F.lit("second"), column)


def _level(number: int, keys: DataFrame, count: int, rate: float) -> Level:
    """A filter over key hashes (a, b); only its set bits travel, never keys."""
    bits = 1 << max(6, math.ceil(math.log2(max(count, 1) * -math.log(rate) / math.log(2) ** 2)))
    if bits > MOST_BITS:
        raise ValueError(f"{count} keys need a filter of {bits} bits")
    hashes = min(max(1, round(bits / max(count, 1) * math.log(2))), 16)
    shape = (number, np.zeros(0, np.uint8), bits, hashes)

    @F.pandas_udf("array<bigint>")
    def places(a: pd.Series, b: pd.Series) -> pd.Series:
        at = Level(*shape).places(a.to_numpy().view(np.uint64), b.to_numpy().view(np.uint64))
        return pd.Series(list(at.T.astype(np.int64)))

    rows = (
        keys.select(F.explode(places("a", "b")).alias("at"))
        .groupBy(F.shiftright("at", 5).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 32 as int))")).alias("bits"))
        .collect()  # at most bits / 32 rows, which MOST_BITS bounds
    )
    filled = np.zeros(bits // _WORD, "<u4")
    if rows:
        filled[[r["word"] for r in rows]] = [r["bits"] for r in rows]
    return Level(number, filled.view(np.uint8), bits, hashes)


def _passing(keys: DataFrame, levels: Sequence[Level]) -> DataFrame:
    """Keys that every level lets through."""
    shared = keys.sparkSession.sparkContext.broadcast([tuple(x) for x in levels])

    @F.pandas_udf("boolean")
    def passes(a: pd.Series, b: pd.Series) -> pd.Series:
        x, y = a.to_numpy().view(np.uint64), b.to_numpy().view(np.uint64)
        found = np.ones(len(x), bool)
        for level in shared.value:
            found &= Level(*level).holds(x, y)
        return pd.Series(found)

    return keys.filter(passes("a", "b"))


def build_cascade(listed: DataFrame, universe: DataFrame) -> list[Level]:
    """Levels that answer membership in ``listed`` exactly for every key of ``universe``.

    Both have the key hashes ``a`` and ``b``; ``listed`` may have keys outside the universe and
    ``universe`` may contain the listed ones. The first filter is sized so that about as many
    others pass as there are listed keys; each later level halves what is left.
    """
    ours = written(listed.select("a", "b").distinct(), "cascade-listed")
    # anti join of the universe with the list, here and not at look-up time
    others = written(
        universe.select("a", "b").distinct().join(ours, ["a", "b"], "left_anti"), "cascade-others"
    )
    inside, outside = ours.count(), others.count()
    levels: list[Level] = []
    rate = min(0.5, max(inside, 1) / max(outside, 1))
    if inside == 0:
        return []
    while inside:
        levels.append(_level(len(levels), ours, inside, rate))
        ours, others = written(_passing(others, levels[-1:]), "cascade-passing"), ours
        inside, rate = ours.count(), 0.5
    return levels


def _hashed(keys: DataFrame, column: str) -> DataFrame:
    a, b = _key(F.col(column))
    return keys.select(a.alias("a"), b.alias("b"))


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], url: str = "url", default: str = "allow"
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (host and path of the longest fitting rule, or
    NULL) and ``verdict`` (the rule's; ``default`` without one).

    A rule fits its host and all subdomains where the path starts with the rule's path. A URL that
    is NULL, empty or without ``://`` has an empty host, which no rule fits. Every row of ``pages``
    gives one row; columns of these names are replaced. The rule list is configuration: the driver
    holds it, and each verdict has a cascade of its own.
    """
    spark = pages.sparkSession
    rules = [Rule(r.verdict, r.host.lower(), r.path) for r in rules]
    pages, moved = aside(pages, ("_keys", "_at"))
    host, path = url_parts(F.col(moved.get(url, url)))
    parts = pages.withColumns({"host": host, "path": path})
    if not rules:
        none = {"rule": F.lit(None).cast("string"), "verdict": F.lit(default)}
        return restored(parts.withColumns(none), moved)
    keys = candidate_keys(F.col("host"), F.col("path"), rules)
    universe = written(
        parts.select(F.explode(keys).alias("key")).distinct().transform(_hashed, "key"),
        "url-universe",
    )
    cascades: dict[str, list[Level]] = {}
    for verdict in sorted({r.verdict for r in rules}):
        rows = [(r.host + r.path,) for r in rules if r.verdict == verdict]
        listed = spark.createDataFrame(rows, "key string").transform(_hashed, "key")
        cascades[verdict] = build_cascade(listed, universe)
    shared = spark.sparkContext.broadcast({v: [tuple(x) for x in c] for v, c in cascades.items()})
    names = list(cascades)

    @F.pandas_udf("int")
    def first_listed(firsts: pd.Series, seconds: pd.Series) -> pd.Series:
        """Position of the first listed key times the number of verdicts, plus the verdict."""
        counts = firsts.map(len).to_numpy(np.int64)
        out = np.full(len(counts), -1, np.int64)
        if counts.sum() == 0:
            return pd.Series(out)
        a = np.concatenate(firsts.to_list()).astype(np.int64).view(np.uint64)
        b = np.concatenate(seconds.to_list()).astype(np.int64).view(np.uint64)
        row = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(len(a)) - np.repeat(np.cumsum(counts) - counts, counts)
        for i, name in reversed(list(enumerate(names))):
            at = np.flatnonzero(holds([Level(*x) for x in shared.value[name]], a, b))[::-1]
            code = place[at] * len(names) + i
            found = np.full(len(counts), np.iinfo(np.int64).max)
            found[row[at]] = code  # the first listed key of a row is written last
            out = np.where((out < 0) | (found < out), np.where(found < 2**62, found, out), out)
        return pd.Series(out)

    listed_at = first_listed(
        F.transform("_keys", lambda k: _key(k)[0]), F.transform("_keys", lambda k: _key(k)[1])
    )
    n = len(names)
    place = F.floor(F.col("_at") / n).cast("int")
    verdict = F.element_at(F.array(*map(F.lit, names)), (F.col("_at") % n + 1).cast("int"))
    found = F.col("_at") >= 0
    judged = (
        parts.withColumn("_keys", keys)
        .withColumn("_at", listed_at)
        .withColumns(
            {
                "rule": F.when(found, F.get("_keys", place)),
                "verdict": F.when(found, verdict).otherwise(default),
            }
        )
        .drop("_keys", "_at")
    )
    return restored(judged, moved)
