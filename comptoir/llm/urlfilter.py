"""URL filter: exact membership of keys by a cascade of Bloom filters, without joins.

Level 1 encodes the listed keys; level 2 encodes the unlisted keys of the
corpus's universe that level 1 lets through; level 3 the listed keys that level 2
lets through; and so on until a level lets nothing through wrongly. The first
level that rejects a key tells its side, so the answer is exact for every key
of the universe.

Level 1 is sized so that the false positives are about as many as the listed
keys, later levels let a tenth pass. The whole cascade then takes about
``1.44 * log2(universe / listed) + 5`` bits per listed key, whatever the
number of rows; it travels as scalar subqueries, one array of 64-bit words a
level. A list of 10 million keys in a universe of 10 billion takes 24 MB.
Of more than ``MAX_LISTED`` listed keys, the universe is dealt by a hash of the key
to as many cascades as keep within it, and the pages of each are judged by theirs alone: what a
task holds has a bound, whatever the list.

Building is a few aggregations per level over ever smaller key sets. Only
counts and the finished levels reach the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comptoir.llm._util import stage

MAX_LISTED = 50_000_000
LATER = 0.1  # false-positive rate of the levels after the first
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    """Fits the host and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[UrlRule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.name)):  # a later, longer rule goes before
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


@dataclass(frozen=True)
class Level:
    words: DataFrame  # one row: the bit set as an array of 64-bit words
    bits: int
    hashes: int
    seed: int


def _places(key: Column, seed: int, hashes: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed), F.lit(i)), F.lit(bits).cast("long")) for i in range(hashes)]


def _level(keys: DataFrame, bits: int, hashes: int, seed: int) -> Level:
    """Encode the distinct ``key`` values: combined per word before the shuffle."""
    spark = keys.sparkSession
    at = keys.select(F.explode(F.array(*_places(F.col("key"), seed, hashes, bits))).alias("at"))
    word = at.select(F.expr("at div 64").alias("w"), F.expr("shiftleft(1L, cast(at % 64 as int))").alias("b"))
    zero = spark.range(bits // 64).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("b"))
    full = word.unionByName(zero).groupBy("w").agg(F.bit_or("b").alias("b"))
    packed = full.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "b"))), lambda x: x["b"]).alias("words"))
    return Level(stage(packed, "bloom-level"), bits, hashes, seed)


def _passes(key: Column, level: Level) -> Column:
    words = level.words.scalar()
    ok = F.lit(True)
    for at in _places(key, level.seed, level.hashes, level.bits):
        word = F.get(words, F.floor(at / 64).cast("int"))
        ok = ok & (F.call_function("bit_get", word, (at % 64).cast("int")) == 1)
    return ok


def _bits(n: int, p: float) -> tuple[int, int]:
    """Bits (whole words) and hashes of a filter for ``n`` keys at false-positive rate ``p``."""
    bits = math.ceil(n * math.log(1 / p) / math.log(2) ** 2)
    return max(64, -(-bits // 64) * 64), max(1, round(math.log2(1 / p)))


class Cascade:
    """Exact membership for the keys it was built over."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    @classmethod
    def build(cls, universe: DataFrame, listed: Column | DataFrame) -> Cascade:
        """One cascade over the whole universe (see ``Cascades.build``)."""
        return cls._of(_marked(universe, listed))

    @classmethod
    def _of(cls, keys: DataFrame) -> Cascade:
        """Of distinct keys with their mark ``listed``."""
        n_in, n_out = keys.agg(F.count_if("listed"), F.count_if(~F.col("listed"))).first()
        side, other = keys.where("listed").select("key"), keys.where("not listed").select("key")
        levels: list[Level] = []
        n, p = n_in, min(0.5, max(1e-9, math.sqrt(0.5) * n_in / max(n_out, 1)))
        while n:
            level = _level(side, *_bits(n, p), seed=len(levels) + 1)
            levels.append(level)
            wrong = stage(other.where(_passes(F.col("key"), level)), "false-positives")
            side, other, n, p = wrong, side, wrong.count(), LATER
        return cls(levels)

    def contains(self, key: Column) -> Column:
        """Whether ``key`` is listed; false for null."""
        out = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            out = F.when(_passes(key, self.levels[i]), out).otherwise(F.lit(i % 2 == 1))
        return F.when(key.isNull(), F.lit(False)).otherwise(out)


def _marked(universe: DataFrame, listed: Column | DataFrame) -> DataFrame:
    """(key, listed) of the distinct keys, written to the shared folder."""
    keys = universe.where(F.col("key").isNotNull()).select("key").distinct()
    if isinstance(listed, DataFrame):
        on = listed.select(F.col("key").alias("_listed")).where("_listed IS NOT NULL").distinct()
        keys = keys.join(on, F.col("key") == F.col("_listed"), "left").select("key", F.col("_listed").isNotNull().alias("listed"))
    else:
        keys = keys.withColumn("listed", F.coalesce(listed, F.lit(False)))
    return stage(keys, "url-keys")


@dataclass(frozen=True)
class Cascades:
    """A cascade for each part of the universe; a key's part is a hash of it."""

    parts: list[Cascade]

    @classmethod
    def build(cls, universe: DataFrame, listed: Column | DataFrame, most: int = MAX_LISTED) -> Cascades:
        """``universe``: every key of the corpus in a column ``key``, repeats and nulls allowed; ``listed``: a table of
        listed keys (column ``key``; keys out of the universe don't matter), or a function of the key. Null keys are members
        of neither side; an empty universe lists nothing. No part lists more than about ``most`` keys."""
        keys = _marked(universe, listed)
        n = max(1, -(-keys.where("listed").count() // most))
        return cls([Cascade._of(keys.where(_part(F.col("key"), n) == i) if n > 1 else keys) for i in range(n)])


def _part(key: Column, n: int) -> Column:
    return F.coalesce(F.pmod(F.xxhash64(key, F.lit("part")), F.lit(n)), F.lit(0)).cast("int")


def judge(pages: DataFrame, cascade: Cascade | Cascades, rules: list[UrlRule], url: str = "url") -> DataFrame:
    """``pages`` plus host, path, rule and verdict: the longest rule's, else block
    where the cascade holds the page's key (host and path), else allow. Null
    urls and urls without ``://`` have an empty host and path and are allowed
    unless the empty key is listed. Of rules of equal length that fit, the later given counts. Clashing input
    columns are replaced; repeated rows are judged alike; an empty table gives no row; very long urls
    are read whole."""
    if isinstance(cascade, Cascades):
        n = len(cascade.parts)
        if n == 1:
            return judge(pages, cascade.parts[0], rules, url)
        at = _part(page_key(F.coalesce(host_of(F.col(url)), F.lit("")), F.coalesce(path_of(F.col(url)), F.lit(""))), n)
        return reduce(DataFrame.unionByName, [judge(pages.where(at == i), c, rules, url) for i, c in enumerate(cascade.parts)])
    new = ("host", "path", "rule", "verdict")
    d = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("_row"),
                     F.coalesce(host_of(F.col(url)), F.lit("")).alias("host"),
                     F.coalesce(path_of(F.col(url)), F.lit("")).alias("path"))
    d = d.withColumn("_hit", longest_rule(F.col("host"), F.col("path"), rules))
    method = F.when(cascade.contains(page_key(F.col("host"), F.col("path"))), F.lit("block")).otherwise(F.lit("allow"))
    return d.select(*[F.col("_row")[c].alias(c) for c in pages.columns if c.lower() not in new], "host", "path",
                    F.col("_hit.rule").alias("rule"), F.coalesce(F.col("_hit.verdict"), method).alias("verdict"))


def page_key(host: Column, path: Column) -> Column:
    """The key of a page: host and path."""
    return F.concat(host, path)
