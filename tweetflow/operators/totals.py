"""Running totals per user, and other aggregates by key.

Sums and minima aggregate on the map side first, so a user who writes or receives a third of all
records costs each task one partial row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tweetflow.fixed import TOTALS

COUNTERS = ["count", "fav", "hashtags", "mentioned"]


def user_table(transformed: DataFrame) -> DataFrame:
    """Totals per author. The name is the one on the author's earliest tweet (``ord``)."""
    return transformed.where("userID IS NOT NULL").groupBy("userID").agg(
        *[F.sum(c).alias(c) for c in COUNTERS[:3]],
        F.min(F.struct("ord", "name"))["name"].alias("name"),
    )


def mentions_table(mentions: DataFrame) -> DataFrame:
    return mentions.groupBy("userID").agg(F.sum("mentioned").alias("mentioned"))


def reconciliation(users: DataFrame, mentions: DataFrame) -> DataFrame:
    """Author totals with the mentions each received; 0 without any. Both sides have one row per user."""
    return users.join(mentions, "userID", "left").select(
        *TOTALS[:-1], F.coalesce("mentioned", F.lit(0).cast("bigint")).alias("mentioned")
    )


def user_deltas(tweets: DataFrame, *extra: Column) -> DataFrame:
    """What each tweet adds to its author and to the users it mentions, in one pass over the tweets.

    ``first`` carries (tweet id, name) on the author's row and is NULL on the others.
    """
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    first = F.struct(F.col("id").alias("ord"), F.col("user.name").alias("name"))

    def delta(user: Column, count: Column, fav: Column, hashtags: Column, mentioned: Column, name: Column) -> Column:
        return F.struct(
            user.alias("userID"), count.alias("count"), fav.alias("fav"),
            hashtags.alias("hashtags"), mentioned.alias("mentioned"), name.alias("first"),
        )

    own = delta(F.col("user.id_str"), one, F.col("favorite_count"), F.size("entities.hashtags").cast("bigint"), zero, first)
    nobody = F.lit(None).cast("struct<ord: bigint, name: string>")
    given = F.transform("entities.user_mentions", lambda m: delta(m["id_str"], zero, zero, zero, one, nobody))
    return tweets.select(*extra, F.inline(F.concat(F.array(own), given))).where("userID IS NOT NULL")


def totals_from_deltas(deltas: DataFrame) -> DataFrame:
    """The reconciliation as one aggregate: one shuffle, one state store, no join.

    Users who are mentioned but never write have count 0 and are dropped.
    """
    sums = [F.sum(c).alias(c) for c in COUNTERS]
    totals = deltas.groupBy("userID").agg(*sums, F.min("first").alias("first"))
    return totals.where("count > 0").withColumn("name", F.col("first.name")).select(*TOTALS)


def count_by(rows: DataFrame, key: str, name: str) -> DataFrame:
    return rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("userid")).agg(F.count(F.lit(1)).alias(name))


def sum_by(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    total = F.sum(F.col(value).cast("bigint"))
    return rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("userid")).agg(total.alias(name))


def top_k(rows: DataFrame, key: str, value: str, k: int, name: str) -> DataFrame:
    """The k greatest values per key as a descending array; equal values are all kept, NULLs are not.

    For k > 1 the rank filter is applied before the shuffle too, so each task sends at most k rows
    per key.
    """
    rows = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("userid"), F.col(value).alias("v"))
    if k == 1:
        return rows.groupBy("userid").agg(F.array_compact(F.array(F.max("v"))).alias(name))
    rank = F.row_number().over(Window.partitionBy("userid").orderBy(F.col("v").desc_nulls_last()))
    best = rows.withColumn("rank", rank).where(F.col("rank") <= k)
    ranked = F.array_sort(F.collect_list(F.when(F.col("v").isNotNull(), F.struct("rank", "v"))))
    return best.groupBy("userid").agg(F.transform(ranked, lambda r: r["v"]).alias(name))


def latest_by_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row per key, a topic read as a table. Also valid on a stream in update mode."""
    rest = [c for c in rows.columns if c not in keys]
    present = rows
    for key in keys:
        present = present.where(F.col(key).isNotNull())
    last = present.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("last"))
    return last.select(*keys, *[F.col("last")[c].alias(c) for c in rest])
