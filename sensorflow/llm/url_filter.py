"""URL verdicts: explicit host/path rules, else a Bloom filter cascade.

The cascade holds the listed hosts. Level 0 encodes them; every next level
encodes the false positives that the level before leaves in the complete key
universe of the corpus, alternating between the two sides, until none is left.
A key is listed if the first level that misses it has an odd number, or the
number of levels is odd when no level misses it. Over that universe the answer
is exact, and a URL is judged by bit tests alone, without a join.

A level is a literal of the plan, so it has a greatest size. Keys are dealt into
as many groups as keep all levels below it, each group with a cascade of its
own; rows are judged by the cascade of their key's group, ``PASS_GROUPS`` groups
in a pass over the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import table, work_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (action, host, path) of the explicit rules.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

#: Labels or hyphenated parts of labels that put a host on the list.
LISTED_PARTS = ("adult", "ads", "bets", "casino", "pills", "spam")

#: Bits per key of a level and its number of hash functions.
BITS_PER_KEY, HASHES = 12, 4

#: Bits of a level at most (it is a literal of the plan, 128 KiB), and groups of keys whose cascades are in one plan.
MAX_LEVEL_BITS, PASS_GROUPS = 1 << 20, 32


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct<rule, verdict> of the longest fitting rule, else NULL."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    out = None
    for action, h, p in ordered:
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        hit = F.struct(F.lit(h + p).alias("rule"), F.lit(action).alias("verdict"))
        out = F.when(fits, hit) if out is None else out.when(fits, hit)
    return out


@dataclass
class Cascade:
    """Levels as (number of bits, the bits as an array of 64-bit words)."""

    levels: list[tuple[int, list[int]]]

    def has(self, key: Column) -> Column:
        """Whether ``key``, of the universe, is listed. NULL counts as not listed."""
        n = len(self.levels)
        out = F.lit(n % 2 == 1)
        for i in range(n - 1, -1, -1):
            out = F.when(~_in_level(key, i, *self.levels[i]), F.lit(i % 2 == 1)).otherwise(out)
        return F.coalesce(out & key.isNotNull(), F.lit(False))


class TooManyKeys(ValueError):
    """A level would be larger than ``MAX_LEVEL_BITS``."""


def _positions(key: Column, level: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(level * HASHES + k), key), F.lit(bits)) for k in range(HASHES)]


def _in_level(key: Column, level: int, bits: int, words: list[int]) -> Column:
    stored = F.lit(np.array(words, "int64"))  # one literal
    out = F.lit(True)
    for p in _positions(key, level, bits):
        word = F.element_at(stored, (F.floor(p / 64) + 1).cast("int"))
        out = out & (F.call_function("getbit", word, (p % 64).cast("int")) == 1)
    return out


def _level(keys: DataFrame, n: int, level: int) -> tuple[int, list[int]]:
    """Bits of the given number of keys, put together by Spark 64 at a time."""
    bits = max(64, -(-n * BITS_PER_KEY // 64) * 64)
    if bits > MAX_LEVEL_BITS:
        raise TooManyKeys(f"{n} keys need {bits} bits; a level holds {MAX_LEVEL_BITS}")
    p = F.explode(F.array(*_positions(F.col("key"), level, bits))).alias("p")
    words = (keys.select(p).select(F.floor(F.col("p") / 64).cast("int").alias("w"),
                                   F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("p") % 64).cast("int")).alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")))
    out = [0] * (bits // 64)
    for r in words.collect():  # at most bits / 64 rows
        out[r.w] = r.b
    return bits, out


def _cascade(keys: DataFrame) -> Cascade:
    """Cascade of the keys that are ``listed`` over all of ``keys`` (distinct)."""
    levels: list[tuple[int, list[int]]] = []
    side = keys.where("listed")  # the keys that the next level encodes
    other = keys.where("not listed")
    while n := side.count():
        levels.append(_level(side, n, len(levels)))
        wrong = other.where(_in_level(F.col("key"), len(levels) - 1, *levels[-1]))
        side, other = wrong, side
    return Cascade(levels)


def _universe(universe: DataFrame, key: str, listed: Column, name: str) -> DataFrame:
    return table(universe.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(
        F.max(F.coalesce(listed, F.lit(False))).alias("listed")), name)


def build_cascade(universe: DataFrame, key: str, listed: Column, name: str = "url-cascade") -> Cascade:
    """One cascade of the keys for which ``listed`` holds over all distinct ``key``s of ``universe``."""
    return _cascade(_universe(universe, key, listed, name))


def group_of(key: Column, groups: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(-1), key), F.lit(groups)).cast("int")


def build_cascades(universe: DataFrame, key: str, listed: Column, name: str = "url-cascade") -> list[Cascade]:
    """The cascades of the groups of keys (:func:`group_of`), as few as the size of a level allows."""
    keys = _universe(universe, key, listed, name)
    n = keys.where("listed").count()
    groups = -(-n * BITS_PER_KEY // MAX_LEVEL_BITS) or 1
    groups += groups // 8 if groups > 1 else 0  # hashes do not deal evenly
    while True:
        parts = keys
        if groups > 1:
            path = work_dir(keys.sparkSession, f"{name}-groups")
            keys.withColumn("g", group_of(F.col("key"), groups)).write.partitionBy("g").parquet(path)
            parts = keys.sparkSession.read.schema("key string, listed boolean, g int").parquet(path)
        try:
            return [_cascade(parts.where(F.col("g") == g) if groups > 1 else keys) for g in range(groups)]
        except TooManyKeys:  # a level of false positives, or an uneven group
            groups *= 2


def judged(rows: DataFrame, key: str, cascades: list[Cascade], out: str) -> DataFrame:
    """``rows`` with whether ``key`` is listed in ``out``, which no column is named yet."""
    group = group_of(F.col(key), len(cascades))
    rows = rows.withColumn(out, F.lit(False))
    for a in range(0, len(cascades), PASS_GROUPS):
        hit = F.col(out)
        for g in range(a, min(a + PASS_GROUPS, len(cascades))):
            has = cascades[g].has(F.col(key))
            hit = has if len(cascades) == 1 else F.when(group == g, has).otherwise(hit)
        rows = rows.withColumn(out, hit)
        if a + PASS_GROUPS < len(cascades):
            rows = table(rows, "url-pass")
    return rows


def on_list(host: Column, parts=LISTED_PARTS) -> Column:
    """Whether a label of ``host``, or a part of it between hyphens, is listed."""
    return host.rlike(rf"(?:^|[.-])(?:{'|'.join(parts)})(?:[.-]|$)")


def judge_urls(pages: DataFrame, url: str = "url", rules=RULES, listed=on_list) -> DataFrame:
    """``pages`` with host, path, rule and verdict of each row.

    A URL that is NULL, empty or without ``://`` has an empty host and path, no
    rule, and the verdict of the empty key (allow). Repeated rows are judged
    alike. Columns of ``pages`` named like a result give way to it; any others
    stay as they are. An empty table gives an empty cascade, which lists
    nothing. URLs of any length are judged whole.
    """
    old = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict") or c == url]
    # the caller's columns travel as one, so that no helper column clashes with them
    parsed = pages.select(F.struct(*[F.col(f"`{c}`") for c in old]).alias("row"), host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path"))
    known = judged(parsed, "host", build_cascades(parsed.select("host"), "host", listed(F.col("host"))), "hit")
    known = known.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce(F.col("fit.verdict"), F.when(F.col("hit"), "block").otherwise("allow"))
    return known.select(*[F.col("row").getField(c).alias(c) for c in old], "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"))


def op4_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")


OP4_SQL = r"""
with u as (
  select page_id,
    translate(coalesce(regexp_extract(url, '^[\s\S]*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '^[\s\S]*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
rules(action, h, p) as (values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fit as (
  select u.page_id, u.host, u.path, max_by(r.h || r.p, length(r.h || r.p)) as rule, max_by(r.action, length(r.h || r.p)) as action
  from u left join rules r on (u.host = r.h or ends_with(u.host, '.' || r.h)) and starts_with(u.path, r.p)
  group by u.page_id, u.host, u.path)
select page_id, host, path, rule,
  coalesce(action, case when regexp_matches(host, '(^|[.-])(adult|ads|bets|casino|pills|spam)([.-]|$)') then 'block' else 'allow' end) as verdict
from fit
"""
