"""Wins reconciled with bids: against the last bid, or against the last bid at the time of the win."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tweetflow.operators.totals import latest_by_key
from tweetflow.schemas import BID_ORDER

# An auction is cut into time slices of this many milliseconds. After one row per instant is made of its
# bids and wins, a slice holds at most this many rows.
SLICE_MS = 3_600_000


def bid_proper_key(bids: DataFrame) -> DataFrame:
    return bids.select("id", F.col("clickProbability").alias("cP"))


def win_proper_key(wins: DataFrame) -> DataFrame:
    return wins.select("auctid", "winPrice")


def bid_table(bids: DataFrame) -> DataFrame:
    """The last bid per auction."""
    ordered = bids.select("id", F.col("clickProbability").alias("cP"), *BID_ORDER)
    return latest_by_key(ordered, ["id"], BID_ORDER).select("id", "cP")


def reco(wins: DataFrame, table: DataFrame) -> DataFrame:
    """Every win with the last bid of its auction, NULL where there is none.

    The table has one row per auction, so adaptive execution may split the wins of a busy one.
    """
    bids = table.withColumnRenamed("id", "auctid")
    return wins.select("auctid", "winPrice").where("auctid IS NOT NULL").join(bids, "auctid", "left").select("auctid", "winPrice", "cP")


def reco_copartitioned(wins: DataFrame, bids: DataFrame) -> DataFrame:
    """The same from tables of wins and bids that are stored in equal buckets by auction: nothing is shuffled.

    Sorted merge at every size: with a broadcast of the bids the wins' buckets would be of no use.
    """
    return reco(wins, bid_table(bids).hint("merge"))


def reco_valid(reconciled: DataFrame) -> DataFrame:
    """Keeps matched wins with a probability of 0 or more; NULL is dropped too."""
    return reconciled.where("cP >= 0").select("*")


def tagged_events(wins: DataFrame, bids: DataFrame) -> DataFrame:
    """Bids and wins in one shape; ``side`` puts the bids of an instant before its wins.

    An event without a time counts as older than all others.
    """
    beginning = F.lit(-(2**63))
    nothing = [F.lit(None).cast("bigint").alias(c) for c in BID_ORDER[1:]]
    no_price, no_bid = F.lit(None).cast("double").alias("winPrice"), F.lit(None).cast("double").alias("cP")
    bid_rows = bids.select("id", *BID_ORDER, F.lit(0).alias("side"), no_price, F.col("clickProbability").alias("cP"))
    win_rows = wins.select(F.col("auctid").alias("id"), "timestamp", *nothing, F.lit(1).alias("side"), "winPrice", no_bid)
    events = bid_rows.unionByName(win_rows).where("id IS NOT NULL")
    return events.withColumn("timestamp", F.coalesce("timestamp", beginning))


def reco_asof(wins: DataFrame, bids: DataFrame, slice_ms: int = SLICE_MS) -> DataFrame:
    """Every win with the last bid placed at or before it."""
    return answer_events(tagged_events(wins, bids), slice_ms)


def answer_events(events: DataFrame, slice_ms: int = SLICE_MS) -> DataFrame:
    """The wins among tagged events, each with its auction's last bid up to then.

    One plan for auctions of any size. Wins of one instant share their answer, and of the bids of one instant the last
    decides, so events shrink to one row per auction and instant before they are shuffled. The running bid is taken
    inside each slice of time, and the last bid before the slice, from one row per auction and slice, fills what is
    still open. Last, the answers go back to the wins, one row per instant, so that adaptive execution may split the
    wins of a busy one.
    """
    bid = F.when(F.col("side") == 0, F.struct(*BID_ORDER, F.struct("cP").alias("bid")))
    instants = (
        events.groupBy("id", "timestamp").agg(F.max(bid).alias("last"), F.max("side").alias("asked"))
        # Never NULL, and said so: a filter on it would tell the two branches apart.
        .withColumn("slice", F.coalesce(F.floor(F.col("timestamp") / slice_ms), F.lit(0)))
    )
    in_slice = Window.partitionBy("id", "slice").orderBy("timestamp").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = instants.withColumn("so_far", F.last("last", ignorenulls=True).over(in_slice)).where("asked = 1")
    earlier = Window.partitionBy("id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    # Only slices with wins need an opening bid. Asking for it also keeps both branches alike, so that
    # they share one shuffle of the instants.
    opening = (
        instants.groupBy("id", "slice").agg(F.max("last").alias("last"), F.max("asked").alias("asked"))
        .select("id", "slice", "asked", F.last("last", ignorenulls=True).over(earlier).alias("opening"))
        .where("asked = 1").drop("asked")
    )
    answers = running.join(opening, ["id", "slice"]).select("id", "timestamp", F.coalesce("so_far", "opening")["bid"]["cP"].alias("cP"))
    asked = events.where("side = 1").select("id", "timestamp", "winPrice")
    return asked.join(answers, ["id", "timestamp"], "left").select(F.col("id").alias("auctid"), "winPrice", "cP")
