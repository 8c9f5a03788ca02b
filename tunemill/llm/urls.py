"""URL filters: rules by host and path, tested with a Bloom filter cascade.

A rule is a host and the beginning of a path.  It fits its host, all
subdomains, and the paths that start so.  Whether one of a url's keys (a suffix
of its host with a beginning of its path) is listed is asked of a cascade:
level 1 is a Bloom filter of the listed keys, level 2 one of all other keys of
the corpus that level 1 lets through, level 3 one of the listed keys that level
2 lets through, and so on until nothing is let through wrongly.  Built over the
complete key universe of the corpus, the answer is exact for every key in it,
and a url is judged from its own row: no join.

The universe is read once; what level 1 lets through of it is stored, and later
levels look at that alone.  A level is an array of 64-bit words that goes to the
executors inside the expression, ``MAX_BYTES`` at most in all.  For a list that
would need more, which its count says before anything is sent, :func:`judge`
takes :func:`judge_by_join`, which gives the same answers by equality joins.

Only as many labels of a host are looked at as some rule has, so hosts may be of any length.
A NULL url, or one without ``://``, has an empty host and path, and no keys.
Repeated and NULL ``page_id``s: a row each.  An empty table of pages gives no rows, without rules all urls get ``otherwise``.
Other columns of the pages are not read and may have any names.
Ties among fitting rules: the longest host and path together, then the longest host.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunemill.llm.common import stored

RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
"""Fixed values: verdict, host, beginning of the path."""
MAX_BYTES = 64 << 20
FIRST_RATE, NEXT_RATE = 0.02, 0.5
SALTS = 8
SEPARATOR = "\u0000"


class TooLong(ValueError):
    """A list whose filters would exceed ``MAX_BYTES``."""


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z in lower case, and path; both empty without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(
        F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def most_labels(rules: DataFrame) -> int:
    """Labels of the longest host among the rules."""
    host = F.element_at(F.split("key", SEPARATOR), 1)
    return rules.agg(F.max(F.size(F.split(host, r"\.")))).first()[0] or 1


def keys_of(host: Column, path: Column, lengths: Sequence[int], labels: int) -> Column:
    """All keys that a rule fitting the url could have: each suffix of the host of up to ``labels`` labels,
    with each beginning of the path of a length that some rule has.  Longest first."""
    named = F.slice(F.reverse(F.split(host, r"\.")), 1, labels)
    suffixes = F.transform(named, lambda _, i: F.array_join(F.reverse(F.slice(named, 1, i + 1)), "."))
    starts = F.filter(
        F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]), lambda p: p.isNotNull()
    )
    pairs = F.flatten(
        F.transform(suffixes, lambda h: F.transform(starts, lambda p: F.struct(
            (-F.length(h) - F.length(p)).alias("order"), (-F.length(h)).alias("then"), h.alias("host"), p.alias("path")
        )))
    )
    ordered = F.transform(F.array_sort(pairs), lambda k: F.concat(k["host"], F.lit(SEPARATOR), k["path"]))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(ordered)


class Level:
    """A Bloom filter: its words, number of bits and hashes."""

    def __init__(self, keys: DataFrame, rate: float, number: int) -> None:
        n = max(1, keys.count())
        self.bits = 64 * max(1, math.ceil(n * -math.log(rate) / math.log(2) ** 2 / 64))
        self.hashes = max(1, round(-math.log2(rate)))
        self.number = number
        self.bytes = self.bits // 8
        if self.bytes > MAX_BYTES:
            raise TooLong(f"a list of {n} keys needs more than {MAX_BYTES} bytes")
        bit = F.explode(F.array(*self._places(F.col("key")))).alias("bit")
        set_bits = keys.select(bit)
        words = set_bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("value")
        )
        self.words = [0] * (self.bits // 64)
        for row in words.collect():  # a bounded filter, not the keys
            self.words[row["word"]] = row["value"]

    def _places(self, key: Column) -> list[Column]:
        return [
            F.pmod(F.xxhash64(key, F.lit(1000 * self.number + i)), F.lit(self.bits)) for i in range(self.hashes)
        ]

    def lets_through(self, key: Column) -> Column:
        words = F.from_json(F.lit("[" + ",".join(map(str, self.words)) + "]"), "array<bigint>")
        found = F.lit(True)
        for place in self._places(key):
            word = F.get(words, F.shiftright(place, 6).cast("int"))
            found = found & (F.getbit(word, place.bitwiseAND(63).cast("int")) == 1)
        return found


class Cascade:
    """Exact membership in ``listed`` for every key of ``universe``; both have a column ``key``."""

    def __init__(self, universe: DataFrame, listed: DataFrame) -> None:
        inside = listed.where(F.col("key").isNotNull()).select("key").distinct()
        self.levels = [Level(inside, FIRST_RATE, 1)]
        passed = universe.select("key").where(self.levels[0].lets_through(F.col("key"))).distinct()
        outside = stored(passed.join(inside, "key", "left_anti"))
        inside = stored(inside)
        while outside.count():
            level = Level(outside, NEXT_RATE, len(self.levels) + 1)
            self.levels.append(level)
            # Those of the other side that this level lets through must be told apart by the next.
            outside, inside = stored(inside.where(level.lets_through(F.col("key")))), outside
            if sum(x.bytes for x in self.levels) > MAX_BYTES:
                raise TooLong(f"the cascade needs more than {MAX_BYTES} bytes")

    def holds(self, key: Column) -> Column:
        """A key stops at the first level that refuses it: an odd one means not listed, an even one listed."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for i, level in reversed(list(enumerate(self.levels))):
            answer = F.when(~level.lets_through(key), F.lit(i % 2 == 1)).otherwise(answer)
        return answer


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    rows = [(verdict, host + SEPARATOR + path) for verdict, host, path in rules]
    return spark.createDataFrame(rows, "verdict string, key string")


def judge(pages: DataFrame, rules: DataFrame, lengths: Sequence[int], otherwise: str = "allow") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` (the longest that fits, else NULL) and ``verdict``.

    ``rules`` has ``verdict`` and ``key``; a key listed with both verdicts is
    blocked.  One cascade holds all keys, another those that block.
    ``otherwise`` is the verdict on urls that no rule fits.
    """
    host, path = host_and_path(F.col("url"))
    # A generator's output is made once per row, however often the columns are named.
    parts = pages.select("page_id", F.inline(F.array(F.struct(host.alias("host"), path.alias("path")))))
    keys = keys_of(F.col("host"), F.col("path"), lengths, most_labels(rules))
    keyed = parts.select("page_id", "host", "path", keys.alias("_keys"))
    universe = keyed.select(F.explode("_keys").alias("key"))
    try:
        listed = Cascade(universe, rules)
        # What blocks is asked only of listed keys, so these are the second one's universe.
        blocked = Cascade(rules.select("key"), rules.where(F.col("verdict") == "block"))
    except TooLong:
        return judge_by_join(pages, rules, lengths, otherwise)
    fitting = F.get(F.filter("_keys", listed.holds), F.lit(0))
    found = keyed.select("page_id", "host", "path", F.explode(F.array(fitting)).alias("_rule"))
    return found.select(
        "page_id",
        "host",
        "path",
        F.replace("_rule", F.lit(SEPARATOR), F.lit("")).alias("rule"),
        F.when(F.col("_rule").isNull(), otherwise)
        .when(blocked.holds(F.col("_rule")), "block")
        .otherwise("allow")
        .alias("verdict"),
    )


def judge_by_join(pages: DataFrame, rules: DataFrame, lengths: Sequence[int], otherwise: str = "allow") -> DataFrame:
    """The same by an equality join of keys, for lists of any size; rows that are alike are judged once."""
    host, path = host_and_path(F.col("url"))
    rows = ["page_id", "host", "path"]
    parts = pages.select("page_id", host.alias("host"), path.alias("path")).groupBy(*rows).agg(F.count("*").alias("_n"))
    keys = keys_of(F.col("host"), F.col("path"), lengths, most_labels(rules))
    keyed = parts.select("*", F.posexplode_outer(keys).alias("_at", "key"))
    single = rules.where(F.col("key").isNotNull()).groupBy("key").agg(F.max(F.col("verdict") == "block").alias("_block"))
    # A common key has one rule and very many rows: those are dealt over salted copies of the rule.
    salt = F.pmod(F.xxhash64(*rows), F.lit(SALTS)).cast("int")
    salted = single.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    joined = keyed.withColumn("_salt", salt).join(salted, ["key", "_salt"], "left")
    hit = F.when(F.col("_block").isNotNull(), F.struct("_at", "key", "_block"))
    best = joined.groupBy(*rows).agg(F.first("_n").alias("_n"), F.min(hit).alias("_hit"))
    step = F.lit(1 << 16).cast("bigint")
    best = best.withColumn("_from", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"), step)))
    best = best.withColumn("_copy", F.explode(F.sequence("_from", F.least(F.col("_n"), F.col("_from") + step - 1))))
    return best.select(
        "page_id",
        "host",
        "path",
        F.replace(F.col("_hit.key"), F.lit(SEPARATOR), F.lit("")).alias("rule"),
        F.when(F.col("_hit").isNull(), otherwise)
        .when(F.col("_hit._block"), "block")
        .otherwise("allow")
        .alias("verdict"),
    )


ORACLE_SQL = """
WITH parts AS (
  SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages
), split AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), rules(verdict, rhost, rpath) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), best AS (
  SELECT page_id, max_by(rhost || rpath, length(rhost) + length(rpath)) AS rule,
    max_by(verdict, length(rhost) + length(rpath)) AS verdict
  FROM split JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id
)
SELECT s.page_id, s.host, s.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM split s LEFT JOIN best b USING (page_id)
"""
