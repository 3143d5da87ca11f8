"""URL rules by cascades of Bloom filters, in built-in functions only.

A cascade answers membership exactly for every key that the corpus can ask for. Level 1
holds the listed keys, level 2 those keys of the corpus that level 1 takes for listed
though they are not, level 3 the listed keys that level 2 takes for such, and so on
until no key is mistaken. Filtering then needs no join: each url asks for its few keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from abonados.llm.common import lower_ascii, stored

#: Bits for a key in each level, and how many of them a key sets.
BITS_PER_KEY = 16
HASHES = 4
#: The rules of the contract: host, path, verdict.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
    lower case; empty where there is none."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty where there is none."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _positions(key: Column, level: int, words: int) -> list[Column]:
    """The bits a key sets: the number of a 64-bit word, and of a bit in it."""
    hashes = [F.xxhash64(F.lit(level), F.lit(i), key) for i in range(HASHES)]
    return [F.struct(F.pmod(F.shiftright(h, 6), F.lit(words)).alias("word"), h.bitwiseAND(63).alias("bit")) for h in hashes]


@dataclass(frozen=True)
class Level:
    """One Bloom filter, as 64-bit words."""

    number: int
    words: tuple[int, ...]

    def holds(self, key: Column) -> Column:
        bits = F.lit(list(self.words))
        found = F.lit(True)
        for p in _positions(key, self.number, len(self.words)):
            word = F.element_at(bits, (p["word"] + 1).cast("int"))
            found = found & (F.call_function("getbit", word, p["bit"].cast("int")) == 1)
        return found


@dataclass(frozen=True)
class Cascade:
    """Levels that alternate between listed keys and keys mistaken for them."""

    levels: tuple[Level, ...]

    def holds(self, key: Column) -> Column:
        """Whether the key is listed; exact for every key of the universe it was built for."""
        listed = F.lit(False)
        for level in reversed(self.levels):
            listed = level.holds(key) & ~listed
        return listed


def _level(keys: DataFrame, number: int) -> Level | None:
    """A filter of the frame's keys; none if there are no keys. Only the filter's words,
    16 bits for each key, come to the driver."""
    count = keys.count()
    if not count:
        return None
    words = max(1, -(-count * BITS_PER_KEY // 64))
    positions = keys.select(F.explode(F.array(*_positions(F.col("key"), number, words))).alias("p"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p.bit").cast("int"))
    filled = positions.groupBy("p.word").agg(F.bit_or(bit).alias("bits")).collect()
    by_word = {row["word"]: row["bits"] for row in filled}
    return Level(number, tuple(by_word.get(i, 0) for i in range(words)))


def cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """A cascade for the keys ``listed`` that is exact on all of ``universe``; both have
    one column, ``key``. Null keys belong to neither. The filters grow with the list
    (16 bits for each key), not with the universe: of it, level 2 holds the share that
    level 1 mistakes."""
    listed = stored(listed.filter("key IS NOT NULL").distinct(), "listed")
    levels: list[Level] = []
    inside, outside = listed, universe.filter("key IS NOT NULL")
    while level := _level(inside, len(levels) + 1):
        levels.append(level)
        mistaken = outside.filter(level.holds(F.col("key"))).distinct()
        if len(levels) == 1:
            mistaken = mistaken.join(listed, "key", "left_anti")
        inside, outside = stored(mistaken, "mistaken"), inside
    return Cascade(tuple(levels))


@dataclass(frozen=True)
class UrlFilter:
    """Cascades of the allowing and the blocking rules, and the shapes rules have: how
    many labels a host has, how many characters a path."""

    allowed: Cascade
    blocked: Cascade
    shapes: tuple[tuple[int, int], ...]

    def judge(self, host: Column, path: Column) -> Column:
        """A struct of the rule that fits, the longest first, else null, and its verdict,
        else ``allow``: a url that no rule names is not listed."""
        asked = candidates(host, path, self.shapes)
        found = F.filter(
            F.transform(
                asked,
                lambda key: F.struct(
                    key.alias("rule"),
                    F.when(self.blocked.holds(key), "block").when(self.allowed.holds(key), "allow").alias("verdict"),
                ),
            ),
            lambda hit: hit["verdict"].isNotNull(),
        )
        longest = F.element_at(
            F.array_sort(found, lambda x, y: F.char_length(y["rule"]) - F.char_length(x["rule"])), 1
        )
        first = F.try_element_at(F.array(longest), F.lit(1))
        return F.when(
            F.size(found) > 0, F.struct(first["rule"].alias("rule"), first["verdict"].alias("verdict"))
        ).otherwise(F.struct(F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict")))


def candidates(host: Column, path: Column, shapes: Sequence[tuple[int, int]]) -> Column:
    """The keys under which a rule that fits could be listed: for each shape of a rule,
    the host's last labels and the path's first characters, if it has so many."""
    keys = []
    for labels, length in shapes:
        end = F.substring_index(host, ".", -labels)
        enough = (host != "") & (F.char_length(F.translate(end, ".", "")) + (labels - 1) <= F.char_length(end))
        exact = F.size(F.split(end, r"\.")) == labels
        keys.append(F.when(enough & exact & (F.char_length(path) >= length), F.concat(end, F.substring(path, 1, length))))
    return F.array_distinct(F.filter(F.array(*keys), lambda key: key.isNotNull()))


def build_filter(pages: DataFrame, rules: DataFrame, url: str = "url") -> UrlFilter:
    """Cascades of ``rules`` (``host``, ``path``, ``verdict`` allow or block) that are
    exact for every key of every url of ``pages``. A rule that is listed twice with both
    verdicts blocks. Rows with a null are no rules."""
    rules = rules.select("host", "path", "verdict").dropna()
    shape = rules.select(F.size(F.split("host", r"\.")).alias("labels"), F.char_length("path").alias("length"))
    shapes = tuple(sorted((row.labels, row.length) for row in shape.distinct().collect()))
    address = pages.select(host_of(F.col(url)).alias("h"), path_of(F.col(url)).alias("p"))
    universe = address.select(F.explode(candidates(F.col("h"), F.col("p"), shapes)).alias("key"))
    keys = rules.select(F.concat("host", "path").alias("key"), "verdict")
    allowed, blocked = (cascade(keys.filter(F.col("verdict") == v).select("key"), universe) for v in ("allow", "block"))
    return UrlFilter(allowed, blocked, shapes)


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    one = spark.range(1)
    listed = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules])
    return one.select(F.inline(listed))


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    A rule fits its host and all subdomains if the url's path starts with the rule's; the
    longest wins. A null url, or one without ``://``, has an empty host and path and is
    allowed. Columns of these four names in the input are replaced. Repeated rows are
    judged alike; an empty table gives an empty one.
    """
    judged = build_filter(pages, rules, url)
    given = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict") or c == url]
    return (
        pages.select(*[F.col(f"`{c}`") for c in given])
        .withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
        .withColumn("_judged", judged.judge(F.col("host"), F.col("path")))
        .withColumns({"rule": F.col("_judged.rule"), "verdict": F.col("_judged.verdict")})
        .drop("_judged")
    )


ORACLE = r"""
WITH a AS (
  SELECT page_id, regexp_matches(coalesce(url, ''), '(?s)^.*?://') AS has,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1) AS rest FROM pages),
b AS (
  SELECT page_id,
         CASE WHEN has THEN translate(regexp_extract(rest, '^([^/?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN has THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM a),
c AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM b)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM c
"""
