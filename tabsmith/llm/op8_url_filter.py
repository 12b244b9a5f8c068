"""URL filter: host and path rules, then a Bloom filter cascade over listed hosts.

The cascade answers "is this key listed?" exactly for every key of the corpus
without a join: level 1 encodes the listed keys; the keys of the corpus that it
lets through by mistake are encoded in level 2, the listed keys that level 2
lets through by mistake in level 3, and so on until a level makes no mistake.
Building it needs the distinct keys of the whole corpus (hosts and their parent
domains, of no more labels than the longest listed host has; pre-aggregated before the shuffle, so one very common host costs a row
per task).  Only the bits of the levels, whose size follows the number of
*listed* keys and is checked, reach the plan, as array literals; a page is
judged where it is read, in generated code.

Beyond ``max_bits`` the listed keys are matched by a shuffled join on the
distinct keys of the corpus instead, which has no bound.

Defined cases: a url that is null or has no ``://`` has an empty host and path,
which no list holds; upper case A-Z in hosts is lowered; ports and user names
stay part of the host; of rules that fit, the longest text (host and path) wins,
then the smaller; null, empty or repeated listed hosts count once or not at all;
no listed host at all means no cascade: everything passes; extra columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsmith.session import materialize

from .common import ascii_lower

#: A level's bits reach the plan as one literal; 2**26 bits are 8 MB.
MAX_BITS = 1 << 26
LATER_RATE = 0.5


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.coalesce(ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return host, path


def host_keys(host: Column, most: int) -> Column:
    """The host and its parent domains of up to ``most`` labels (the host itself
    only if it has no more): no other can be a listed host of so many labels."""
    labels = F.regexp_count(host, F.lit(r"\.")) + 1
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.least(labels, F.lit(max(1, most)))),
                    lambda i: F.call_function("substring_index", host, F.lit("."), -i)))


def rule_column(rules: Sequence[Rule], host: Column, path: Column, value) -> Column:
    """``value(rule)`` of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text), reverse=True):
        fits = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        fits = fits & F.startswith(path, F.lit(rule.path))
        out = F.when(fits, F.lit(value(rule))).otherwise(out)
    return out


@dataclass(frozen=True)
class Level:
    n_bits: int
    n_hashes: int
    words: tuple[int, ...]


def _positions(key: Column, level: int, n_bits: int, n_hashes: int) -> list[Column]:
    """Double hashing; the level is hashed too, so that levels are independent."""
    first = F.xxhash64(F.lit(level), key)
    second = F.xxhash64(key, F.lit(level)).bitwiseOR(F.lit(1))
    return [F.pmod(F.shiftright(first, 20) + F.shiftright(second, 20) * i, F.lit(n_bits)) for i in range(n_hashes)]


def _holds(level: Level, number: int, key: Column) -> Column:
    words = F.split(F.lit(",".join(map(str, level.words))), ",").cast("array<bigint>")
    out = F.lit(True)
    for p in _positions(key, number, level.n_bits, level.n_hashes):
        word = F.get(words, F.shiftright(p, 6).cast("int"))
        out = out & (F.bit_get(word, F.pmod(p, F.lit(64)).cast("int")) == 1)
    return out


def contains(levels: Sequence[Level], key: Column) -> Column:
    """Exact membership for every key of the universe the levels were built on."""
    out = F.lit(len(levels) % 2 == 1)
    for number in range(len(levels) - 1, -1, -1):
        inside = _holds(levels[number], number, key)
        # Through the filter: the next level decides; stopped: the other side.
        out = F.when(inside, out).otherwise(F.lit(number % 2 == 1))
    return out


def _size(n: int, rate: float) -> tuple[int, int]:
    bits = max(64, math.ceil(-n * math.log(rate) / math.log(2) ** 2))
    bits = (bits + 63) // 64 * 64
    return bits, max(1, round(-math.log2(rate)))


def _build_level(keys: DataFrame, n: int, rate: float, number: int) -> Level:
    n_bits, n_hashes = _size(n, rate)
    at = keys.select(F.explode(F.array(*_positions(F.col("key"), number, n_bits, n_hashes))).alias("p"))
    rows = (at.groupBy(F.shiftright("p", 6).alias("w"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("bits")).collect())
    words = [0] * (n_bits // 64)
    for r in rows:
        words[r["w"]] = r["bits"]
    return Level(n_bits, n_hashes, tuple(words))


def build_cascade(universe: DataFrame, max_bits: int = MAX_BITS) -> list[Level] | None:
    """Levels for (key, listed), the distinct keys of the corpus; None when the
    first level would exceed ``max_bits``."""
    counts = {r["listed"]: r["count"] for r in universe.groupBy("listed").count().collect()}
    n, others = counts.get(True, 0), counts.get(False, 0)
    levels: list[Level] = []
    inside, outside = universe.where("listed"), universe.where("not listed")
    while n:
        # The first level is the one that all other keys meet.
        rate = min(LATER_RATE, max(1e-6, n / (math.sqrt(2) * max(others, 1)))) if not levels else LATER_RATE
        if _size(n, rate)[0] > max_bits:
            return None
        number = len(levels)
        levels.append(_build_level(inside, n, rate, number))
        wrong = outside.where(_holds(levels[-1], number, F.col("key")))
        inside, outside = wrong, inside
        n = wrong.count()
    return levels


def filter_urls(pages: DataFrame, rules: Sequence[Rule], listed: DataFrame, url_col: str = "url",
                keep: Sequence[str] = (), max_bits: int = MAX_BITS) -> DataFrame:
    """Judge every page: ``keep`` columns, host, path, rule, verdict.

    ``listed`` is a DataFrame of one column, the blocked hosts; a listed host
    covers its subdomains.
    """
    url = pages.select(F.col(f"`{url_col}`").alias("__url"), *[F.col(f"`{c}`") for c in keep])
    host, path = split_url(F.col("__url"))
    parts = url.select(*[F.col(f"`{c}`") for c in keep], host.alias("__host"), path.alias("__path"))
    hosts = parts.select(F.col("__host").alias("h")).groupBy("h").count()
    column = listed.columns[0]
    blocked = (listed.select(ascii_lower(F.col(f"`{column}`")).alias("key"))
               .where("key is not null and key <> ''").distinct().withColumn("hit", F.lit(True)))
    most = blocked.agg(F.max(F.regexp_count("key", F.lit(r"\.")) + 1)).head()[0] or 1
    keys = hosts.select(F.explode(host_keys(F.col("h"), most)).alias("key")).groupBy("key").count().select("key")
    universe = materialize(keys.join(blocked, "key", "left")
                           .select("key", F.coalesce("hit", F.lit(False)).alias("listed")), "url-keys")
    levels = build_cascade(universe, max_bits)
    host, path = F.col("__host"), F.col("__path")
    if levels is None:
        bad = (hosts.select("h", F.explode(host_keys(F.col("h"), most)).alias("key"))
               .join(universe.where("listed").select("key"), "key", "left_semi")
               .groupBy("h").count().select("h", F.lit(True).alias("__bad")))
        parts = parts.join(bad, host == F.col("h"), "left")
        is_listed = F.coalesce("__bad", F.lit(False))
    elif levels:
        is_listed = F.exists(host_keys(host, most), lambda k: contains(levels, k))
    else:
        is_listed = F.lit(False)
    return parts.select(
        *[F.col(f"`{c}`") for c in keep], host.alias("host"), path.alias("path"),
        rule_column(rules, host, path, lambda r: r.text).alias("rule"),
        F.coalesce(rule_column(rules, host, path, lambda r: r.verdict),
                   F.when(is_listed, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))


#: The rules of the registered query.
QUERY_RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)

#: The hosts that the registered query lists, subdomains included.
QUERY_LISTED = (
    "ads-track.example.com", "ads-track.example.net", "ads-track.example.org",
    "adult-x.example.com", "adult-x.example.net", "adult-x.example.org",
    "casino-win.example.com", "casino-win.example.net", "casino-win.example.org",
    "cheap-pills.example.com", "cheap-pills.example.net", "cheap-pills.example.org",
    "free-bets.example.com", "free-bets.example.net", "free-bets.example.org",
    "spam-farm.example.com", "spam-farm.example.net", "spam-farm.example.org",
)

ORACLE_SQL = r"""
WITH p AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (SELECT page_id, translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM p),
rules(v, h, s) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                          ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
best AS (SELECT page_id, arg_max(r.h || r.s, length(r.h || r.s)) AS rule, arg_max(r.v, length(r.h || r.s)) AS v
         FROM q JOIN rules r ON (q.host = r.h OR ends_with(q.host, '.' || r.h)) AND starts_with(q.path, r.s) GROUP BY page_id),
listed AS (SELECT n || '.example.' || t AS h FROM (VALUES ('ads-track'), ('adult-x'), ('casino-win'), ('cheap-pills'), ('free-bets'), ('spam-farm')) a(n),
                  (VALUES ('com'), ('net'), ('org')) b(t))
SELECT q.page_id, q.host, q.path, best.rule,
       coalesce(best.v, CASE WHEN EXISTS (SELECT 1 FROM listed l WHERE q.host = l.h OR ends_with(q.host, '.' || l.h)) THEN 'block' ELSE 'allow' END) AS verdict
FROM q LEFT JOIN best USING (page_id)
"""
