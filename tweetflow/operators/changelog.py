"""The changelog of a table, compacted by interval, and back to the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tweetflow.fixed import TOTALS
from tweetflow.operators.totals import COUNTERS, latest_by_key, user_deltas


def changelog_by_interval(tweets: DataFrame, interval: Column) -> DataFrame:
    """Each user's running totals at the end of every interval in which the user's row changed.

    The deltas are summed per (user, interval) before the running sum, so the window holds at most
    one row per interval for a user, however many tweets there were. ``interval`` must order as text
    or number the way time does; tweets without one are left out (``rejected_tweets`` with ``dated`` returns them).
    """
    deltas = user_deltas(tweets, interval.alias("bucket")).where("bucket IS NOT NULL")
    per_interval = deltas.groupBy("userID", "bucket").agg(
        *[F.sum(c).alias(c) for c in COUNTERS], F.min("first").alias("first")
    )
    so_far = Window.partitionBy("userID").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = per_interval.select(
        "bucket", "userID", *[F.sum(c).over(so_far).alias(c) for c in COUNTERS], F.min("first").over(so_far)["name"].alias("name")
    )
    return running.where("count > 0").select("bucket", *TOTALS)


def changelog_to_table(changelog: DataFrame, order: str = "bucket") -> DataFrame:
    """The current table: the last changelog row per user."""
    return latest_by_key(changelog, ["userID"], [order]).select(*TOTALS)
