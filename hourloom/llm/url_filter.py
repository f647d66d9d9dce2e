"""URL filters by a cascade of Bloom filters: exact membership of listed keys without a join.

The first level encodes the listed keys. The second encodes those of the corpus's other keys that the first takes
for listed, the third the listed keys that the second takes for such, and so on until no key of the
corpus is taken wrongly. A key's answer is the parity of the first level that does not know it, exact for
every key of the universe the cascade was built over. Levels are arrays of 64-bit words in the plan; what
they are built from stays in Spark, and only their words, a bounded number, pass the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.sources.workspace import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class CascadeSpec:
    """``max_words`` bounds each level (64 MB), ``max_shapes`` the different (labels, path length) forms of rules."""

    later_share: float = 1 / 16
    max_words: int = 8 << 20
    max_shapes: int = 4096


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    seed: int
    words: str

    def knows(self, key: Column) -> Column:
        words = F.split(F.lit(self.words), ",").cast("array<bigint>")  # folded to one literal by the optimizer
        hit = None
        for at in _positions(key, self.bits, self.hashes, self.seed):
            bit = F.get(words, F.floor(at / 64).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int"))) != 0
            hit = bit if hit is None else hit & bit
        return hit


def _positions(key: Column, bits: int, hashes: int, seed: int) -> list[Column]:
    size = F.lit(bits).cast("long")
    first, step = F.pmod(F.xxhash64(F.lit(2 * seed), key), size), F.pmod(F.xxhash64(F.lit(2 * seed + 1), key), size)
    return [F.pmod(first + F.lit(k) * step, size) for k in range(hashes)]


def _level(keys: DataFrame, count: int, share: float, seed: int, spec: CascadeSpec) -> Level:
    hashes = max(1, round(math.log2(1 / share)))
    bits = max(64, 64 * math.ceil(count * hashes / math.log(2) / 64))
    if bits // 64 > spec.max_words:
        raise ValueError(f"a level of {bits} bits exceeds {spec.max_words} words; list fewer keys or split the list by host")
    at = F.explode(F.array(*_positions(F.col("key"), bits, hashes, seed)))
    spread = keys.select(at.alias("at")).select(F.expr("at div 64").cast("int").alias("i"), F.expr("shiftleft(1L, cast(pmod(at, 64) as int))").alias("b"))
    words = [0] * (bits // 64)
    for row in spread.groupBy("i").agg(F.bit_or("b").alias("w")).collect():  # at most max_words rows
        words[row.i] = row.w
    return Level(bits, hashes, seed, ",".join(map(str, words)))


class Cascade:
    """Membership of listed keys, exact for all keys of ``universe`` (a column ``key``, repeats and nulls allowed)."""

    def __init__(self, universe: DataFrame, listed: DataFrame, spec: CascadeSpec | None = None):
        spec = spec or CascadeSpec()
        inside = settle(listed.select("key").filter("key is not null").distinct(), "listed")
        outside = settle(universe.select("key").filter("key is not null").distinct().join(inside, "key", "left_anti"), "others")
        n, others = inside.count(), outside.count()
        self.levels: list[Level] = []
        share = min(0.5, max(1e-6, math.sqrt(0.5) * n / max(1, others)))
        encoded, tested = inside, outside
        while n:
            level = _level(encoded, n, share, len(self.levels) + 1, spec)
            self.levels.append(level)
            wrong = settle(tested.filter(level.knows(F.col("key"))), "wrong")
            encoded, tested, n, share = wrong, encoded, wrong.count(), spec.later_share

    def contains(self, key: Column) -> Column:
        answer = F.lit(len(self.levels) % 2 == 1)  # known to all: the last level says what it encodes
        for i in reversed(range(len(self.levels))):
            answer = F.when(self.levels[i].knows(key), answer).otherwise(F.lit(i % 2 == 1))
        return answer


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_keys(host: Column, path: Column, shapes: Sequence[tuple[int, int]]) -> Column:
    """Host suffix and path prefix, joined, for each (labels, path length) that the url has; longest first, then longest host."""
    parts = F.split(host, r"\.")
    forms = F.array(*(F.struct(F.lit(n).alias("n"), F.lit(q).alias("q")) for n, q in shapes))
    fits = F.filter(forms, lambda s: (F.size(parts) >= s.n) & (F.length(path) >= s.q))
    joined = F.transform(fits, lambda s: F.struct((F.length(F.array_join(F.slice(parts, -s.n, s.n), ".")) + s.q).alias("long"), s.n.alias("n"), F.concat(F.array_join(F.slice(parts, -s.n, s.n), "."), F.substring(path, F.lit(1), s.q)).alias("key")))
    return F.transform(F.sort_array(joined, asc=False), lambda x: x.key)


RESULTS = ("_host", "_path", "_rule", "_verdict")


def filter_urls(pages: DataFrame, rules: DataFrame, listed_hosts: DataFrame, spec: CascadeSpec | None = None, url: str = "url") -> DataFrame:
    """``pages`` with _host, _path, _rule and _verdict, which replace columns of these names; all others stay as they are.

    ``rules``: host, path, verdict (allow or block); a rule fits its host and all subdomains where the url's path starts
    with the rule's, and the longest fitting rule decides. Urls without a rule are blocked if their host is one
    of ``listed_hosts`` (a column ``key``), else allowed. Null urls and urls without ``://`` have an empty host and path
    and are allowed unless the empty host is listed. Of a rule given as both, block counts.
    Repeated rows stay and get the same answer.
    """
    given = [c for c in pages.columns if c not in RESULTS]
    pages = pages.select(F.col(url).alias("url"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(given)))
    spec = spec or CascadeSpec()
    rules = rules.select(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").filter("host is not null")
    shapes = [(r.n, r.q) for r in rules.select(F.size(F.split("host", r"\.")).alias("n"), F.length("path").alias("q")).distinct().limit(spec.max_shapes + 1).collect()]
    if len(shapes) > spec.max_shapes:
        raise ValueError(f"rules have more than {spec.max_shapes} forms")
    located = pages.withColumns({"_host": host_of(F.col("url")), "_path": path_of(F.col("url"))})
    keys = rule_keys(F.col("_host"), F.col("_path"), shapes) if shapes else F.array().cast("array<string>")
    universe = settle(located.select("_host", "_path").distinct().select(F.explode(keys).alias("key")).distinct(), "keys")
    known = {v: Cascade(universe, rules.filter(F.col("verdict") == v).select(F.concat("host", "path").alias("key")), spec) for v in ("block", "allow")}
    hosts = Cascade(located.select(F.col("_host").alias("key")), listed_hosts, spec)
    fitting = F.filter(F.col("_keys"), lambda k: known["block"].contains(k) | known["allow"].contains(k))
    rule = F.get(F.col("_fitting"), 0)
    by_rule = F.when(known["block"].contains(F.col("_rule")), "block").otherwise("allow")
    by_host = F.when(hosts.contains(F.col("_host")), "block").otherwise("allow")
    out = located.withColumn("_keys", keys).withColumn("_fitting", fitting).withColumn("_rule", rule)
    out = out.withColumn("_verdict", F.when(F.col("_rule").isNotNull(), by_rule).otherwise(by_host))
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(given)), *RESULTS)


def hosts_with_words(pages: DataFrame, words: Sequence[str], url: str = "url") -> DataFrame:
    """Distinct hosts (``key``) with one of the words as a whole part between dots and hyphens: a list to block."""
    pattern = rf"(^|[.-])({'|'.join(words)})([.-]|$)"
    return pages.select(host_of(F.col(url)).alias("key")).distinct().filter(F.col("key").rlike(pattern))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) triples as a table."""
    return spark.createDataFrame([(h, p, v) for v, h, p in rules], "host string, path string, verdict string")
