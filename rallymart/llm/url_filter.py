"""URL rules by cascades of Bloom filters over the complete set of keys the corpus can ask for.

A rule (host, path) is the key `host + path`. A url asks for the keys of its host and all parent
domains, each with the starts of its path that are as long as some rule's path. The keys of all
urls are the universe. The first filter of a cascade encodes the listed keys, the next one those
other keys of the universe that the first lets through by mistake, the next the listed keys that
the second lets through, and so on until no mistake is left. Then membership is exact for every
key of the universe, and no url has to be joined with the list. There is one cascade per verdict.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from typing import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import lower_ascii, sent, stage

#: verdict, host, path
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
VERDICTS = ("allow", "block")  # of two rules with the same key, the later verdict here counts
#: What is broadcast: the bits of all levels of a cascade. A larger list is refused.
MOST_BITS = 8 * 256 * 2**20


@dataclass
class Level:
    """A Bloom filter: `hashes` bit positions for each key."""

    bits: int
    hashes: int
    seed: int
    words: np.ndarray

    def positions(self, h1: np.ndarray, h2: np.ndarray) -> Iterable[np.ndarray]:
        a, b = _mixed(h1, self.seed), _mixed(h2, self.seed) | np.uint64(1)
        for i in range(self.hashes):
            yield (a + np.uint64(i) * b) % np.uint64(self.bits)

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        found = np.ones(len(h1), bool)
        for at in self.positions(h1, h2):
            found &= (self.words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)) == 1
        return found


def _mixed(h: np.ndarray, seed: int) -> np.ndarray:
    """Another hash for each level, by the finalizer of splitmix64."""
    with np.errstate(over="ignore"):
        z = h.astype("uint64") + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % 2**64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def cascade_has(levels: list[Level], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Whether each key is listed: it is out at an odd number of passed levels."""
    passed = np.zeros(len(h1), int)
    still = np.arange(len(h1))
    for level in levels:
        still = still[level.has(h1[still], h2[still])]
        passed[still] += 1
    return passed % 2 == 1


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(key, F.lit(7))


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    shared = sent(keys.sparkSession, level)

    def run(batches):
        level = shared()
        for batch in batches:
            h1, h2 = (batch.column(n).to_numpy().view("uint64") for n in ("h1", "h2"))
            yield batch.filter(pa.array(level.has(h1, h2)))

    return keys.mapInArrow(run, keys.schema)


def _level(keys: DataFrame, count: int, miss: float, seed: int) -> Level:
    """A filter over `keys`: their bits are set in tasks, combined by word, and only words move."""
    hashes = max(1, round(-math.log2(miss)))
    bits = max(64, math.ceil(count * -math.log(miss) / math.log(2) ** 2))
    if bits > MOST_BITS:
        raise ValueError(f"a list of {count} keys needs a filter of {bits} bits")
    level = Level(bits, hashes, seed, np.zeros(-(-bits // 64), "uint64"))

    def run(batches):
        for batch in batches:
            h1, h2 = (batch.column(n).to_numpy().view("uint64") for n in ("h1", "h2"))
            at = np.concatenate([*level.positions(h1, h2), np.zeros(0, "uint64")])
            words, bit = at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63))
            yield pa.record_batch({"word": words.astype("int64"), "bit": bit.view("int64")})

    set_bits = keys.mapInArrow(run, "word long, bit long")
    for row in set_bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toLocalIterator():
        level.words[row.word] = np.uint64(row.bits % 2**64)
    return level


def cascade(listed: DataFrame, universe: DataFrame) -> list[Level]:
    """Levels that tell listed keys from all others of `universe`; both have h1, h2 of a key.

    The first filter lets through about 0.7 mistakes per listed key, however large the universe
    is, and each further one half of what is left, so all later sets are of the list's size.
    """
    inside = listed.distinct()
    outside = universe.join(inside, ["h1", "h2"], "left_anti")
    n_in, n_out = inside.count(), outside.count()
    levels: list[Level] = []
    miss = min(0.5, max(n_in, 1) * math.sqrt(0.5) / max(n_out, 1))
    while n_in:
        levels.append(_level(inside, n_in, miss, len(levels)))
        passed = stage(_passing(outside, levels[-1]), "mistakes")
        inside, outside, n_in, miss = passed, inside, passed.count(), 0.5
    return levels


def host_and_path(url: Column) -> tuple[Column, Column]:
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + F.lit(3), F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + F.lit(1), F.length(rest)), "^[^?#]*", 0)
    return lower_ascii(host), path


def asked_keys(host: Column, path: Column, host_labels: Iterable[int], path_lengths: Iterable[int]) -> Column:
    """All keys under which a rule for this url can be listed, of as many labels and characters as rules have.

    A host of fewer labels stands for itself; so keys are few and short, however long the url is.
    """
    hosts = F.array_distinct(F.array(*[F.substring_index(host, ".", -n) for n in host_labels]))
    starts = F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in path_lengths])
    starts = F.array_compact(starts)
    return F.flatten(F.transform(hosts, lambda h: F.transform(starts, lambda p: F.concat(h, p))))


def judge_urls(pages: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES) -> DataFrame:
    """host, path, rule and verdict for every page: the longest rule that fits, else `allow`.

    The longest rule is the one with the longest host and path together; of equals the one with
    the longer host. A null url or one without `://` has empty host and path and is allowed.
    Repeated rows are judged each; an empty table gives no rows; other columns are not read.
    """
    spark = pages.sparkSession
    rules = list(rules)
    lengths = sorted({len(path) for _, _, path in rules})
    labels = sorted({host.count(".") + 1 for _, host, _ in rules})
    host, path = host_and_path(F.col("url"))
    asked = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn(
        "keys", asked_keys(F.col("host"), F.col("path"), labels, lengths)
    )
    h1, h2 = _hashes(F.col("key"))
    universe = stage(
        asked.select(F.explode("keys").alias("key")).distinct().select(h1.alias("h1"), h2.alias("h2")),
        "universe",
    )
    cascades = {}
    for verdict in VERDICTS:
        keys = [(h + p,) for v, h, p in rules if v == verdict]
        listed = spark.createDataFrame(keys, "key string").select(h1.alias("h1"), h2.alias("h2"))
        cascades[verdict] = cascade(listed, universe)
    shared = sent(spark, [cascades[v] for v in VERDICTS])

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def code(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        """For each key of a row 0, or the number of its verdict."""
        cascades = shared()
        none = np.zeros(0, "int64")
        for first, second in batches:
            a, b = (np.concatenate([none, *x]).view("uint64") for x in (first, second))
            codes = np.zeros(len(a), int)
            for number, levels in enumerate(cascades, 1):
                codes[cascade_has(levels, a, b)] = number
            yield pd.Series(np.split(codes, np.cumsum(first.map(len).to_numpy())[:-1]), index=first.index)

    coded = asked.withColumn(
        "codes",
        code(
            F.transform("keys", lambda k: _hashes(k)[0]),
            F.transform("keys", lambda k: _hashes(k)[1]),
        ),
    )
    hits = F.filter(F.arrays_zip("keys", "codes"), lambda x: x["codes"] > 0)
    best = F.array_max(
        F.transform(
            hits,
            lambda x: F.struct(
                F.length(x["keys"]), F.instr(x["keys"], "/"), x["keys"].alias("key"), x["codes"].alias("code")
            ),
        )
    )
    verdict = F.element_at(F.array(*map(F.lit, VERDICTS)), F.col("best.code"))
    return coded.withColumn("best", best).select(
        "page_id",
        "host",
        "path",
        F.col("best.key").alias("rule"),
        F.coalesce(F.when(F.col("best").isNotNull(), verdict), F.lit("allow")).alias("verdict"),
    )
