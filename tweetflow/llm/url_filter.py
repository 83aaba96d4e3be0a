"""URL rules as exact set membership in a cascade of Bloom filters."""

from __future__ import annotations

import math
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tweetflow.llm.common import beside, cut

#: More listed keys are refused: the filters, a few bytes a key, are sent to every task.
MOST_LISTED = 1_000_000
MOST_HASHES = 16


class Bloom(NamedTuple):
    """A filter's bits, 64 to a word, and the number of places a key sets."""

    words: list[int]
    hashes: int


def host_of(url: Column) -> Column:
    """From the first :// to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(/[^?#]*)", 1), F.lit(""))


def candidate_keys(host: Column, path: Column, rules: list[str]) -> Column:
    """The keys of a page that a rule could equal: the host's last n labels with the path's first m characters, for
    every n and m that some rule has."""
    shapes = sorted({(rule.partition("/")[0].count(".") + 1, len(rule) - len(rule.partition("/")[0])) for rule in rules})
    labels = F.size(F.split(host, r"\."))
    keys = [
        F.when(
            (labels >= n) & (F.length(path) >= m) & (host != ""),
            F.concat(F.substring_index(host, ".", -n), F.substring(path, 1, m)),
        )
        for n, m in shapes
    ]
    return F.array_compact(F.array(*keys)) if keys else F.array().cast("array<string>")


def filter_shape(n: int, rate: float) -> tuple[int, int]:
    """Bits and places for n keys, so that other keys are taken for them at about the given rate.

    Bits are a power of two, in which places an odd step apart are all different. A key's places hang on two
    numbers below the bits only, so bits are never so few that whole sequences of places coincide more often.
    """
    hashes = min(MOST_HASHES, max(1, math.ceil(-math.log2(rate))))
    filled = -hashes * n / math.log1p(-(rate ** (1 / hashes)))
    return 1 << max(6, math.ceil(math.log2(max(filled, math.sqrt(2 * n / rate))))), hashes


def _places(key: Column, bits: int, hashes: int, level: int) -> list[Column]:
    below = F.lit(bits - 1).cast("bigint")
    first = F.xxhash64(F.lit(level), key).bitwiseAND(below)
    step = F.xxhash64(key, F.lit(level)).bitwiseAND(below).bitwiseOR(F.lit(1).cast("bigint"))
    return [(first + step * i).bitwiseAND(below) for i in range(hashes)]


def bloom(keys: DataFrame, n: int, rate: float, level: int) -> Bloom:
    """A filter over the n keys of (key)."""
    bits, hashes = filter_shape(n, rate)
    place = keys.select(F.explode(F.array(*_places(F.col("key"), bits, hashes, level))).alias("place"))
    bit = F.expr("shiftleft(1L, CAST(place % 64 AS INT))")
    words = [0] * (bits // 64)
    for row in place.groupBy(F.expr("place div 64").alias("word")).agg(F.bit_or(bit).alias("bits")).collect():
        words[row["word"]] = row["bits"]
    return Bloom(words, hashes)


def maybe_in(key: Column, held: Bloom, level: int) -> Column:
    # One text for all words, which becomes an array when the plan is made.
    table = F.split(F.lit(" ".join(map(str, held.words))), " ").cast("array<bigint>")

    def is_set(place: Column) -> Column:
        word = F.get(table, F.floor(place / 64).cast("int"))
        return word.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 64).cast("int"))) != 0

    return reduce(Column.__and__, map(is_set, _places(key, 64 * len(held.words), held.hashes, level)))


def cascade(listed: DataFrame, universe: DataFrame, n_listed: int, n_universe: int) -> list[Bloom]:
    """Filters that together answer exactly, for every key of the universe, whether it is listed.

    Level 0 holds the listed keys; level 1 the keys of the universe that level 0 takes for listed and that aren't;
    level 2 the listed ones that level 1 takes for those; and so on until a level errs no more. Level 0 is sized so
    that it errs on about as many keys as there are listed, at any size of the universe: its bits follow the list and
    the logarithm of the universe, or the square root of the universe if that is more (a million millions: 256 KB).
    """
    levels = [bloom(listed, n_listed, min(0.25, n_listed / max(n_universe, 1)), 0)]
    wrong = universe.where(maybe_in(F.col("key"), levels[0], 0)).distinct().join(listed, "key", "left_anti")
    inside, outside = listed, cut(wrong)
    while n := outside.count():
        level = len(levels)
        levels.append(bloom(outside, n, 0.25, level))
        inside, outside = outside, cut(inside.where(maybe_in(F.col("key"), levels[-1], level)))
    return levels


def listed_in(key: Column, levels: list[Bloom]) -> Column:
    answer = F.lit(True)
    for level in reversed(range(len(levels))):
        # In this level, and not among what the next level takes back.
        inside = maybe_in(key, levels[level], level)
        answer = inside if level == len(levels) - 1 else inside & ~answer
    return answer


def judge(pages: DataFrame, rules: dict[str, str], carry: list[str]) -> DataFrame:
    """The carried columns with host, path, rule and verdict of every row of pages (url, ...).

    rules: "host/path prefix" to "block" or "allow". A rule fits its host and the host's subdomains where the path
    starts with the rule's; the longest fitting rule decides, and a page that no rule fits is allowed: it is not
    listed. Each verdict has a cascade over all keys the pages could ask for, so membership is exact and pages are
    neither joined nor shuffled; only keys that level 0 lets pass are. A carried column named like one of the result's own
    comes back as <name>_given. Null urls and urls without :// have empty host
    and path, which no rule fits. Repeated pages are judged alike. No rules or no pages: nothing is blocked.
    """
    if len(rules) > MOST_LISTED:
        raise ValueError(f"{len(rules)} rules; filters are made of {MOST_LISTED} at most")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    asked = pages.select(F.explode(candidate_keys(host, path, list(rules))).alias("key"))
    n_universe = asked.agg(F.approx_count_distinct("key")).first()[0] if rules else 0
    spark, by_verdict = pages.sparkSession, {}
    for verdict in sorted(set(rules.values())):
        keys = [(key,) for key in rules if rules[key] == verdict]
        by_verdict[verdict] = cascade(spark.createDataFrame(keys, "key string"), asked, len(keys), n_universe)

    def verdict_of(key: Column) -> Column:
        return F.coalesce(*(F.when(listed_in(key, levels), F.lit(verdict)) for verdict, levels in by_verdict.items()))

    def longest(keys: Column) -> Column:
        judged = F.transform(keys, lambda key: F.struct(F.length(key).alias("long"), key.alias("rule"), verdict_of(key).alias("verdict")))
        return F.array_max(F.filter(judged, lambda found: found["verdict"].isNotNull()))

    empty = F.lit(None).cast("struct<long:int,rule:string,verdict:string>")
    return (
        pages.select(F.struct(*carry).alias("_kept"), host.alias("host"), path.alias("path"))
        .withColumn("_found", longest(candidate_keys(F.col("host"), F.col("path"), list(rules))) if rules else empty)
        .select(
            *beside(carry, "host path rule verdict"), "host", "path", F.col("_found.rule").alias("rule"),
            F.coalesce("_found.verdict", F.lit("allow")).alias("verdict"),
        )
    )
