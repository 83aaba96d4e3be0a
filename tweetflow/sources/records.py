"""Topic records (key, value) to typed columns, with bad records set aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tweetflow import schemas
from tweetflow.functions import millis

# What every tweet operator needs. Queries that skip a column need not declare it to the parser.
TWEET_CORE = ["id", "favorite_count", "user", "entities"]


def open_json(records: DataFrame, schema: T.StructType, mode: str = "PERMISSIVE", keep: tuple[str, ...] = ("key",)) -> DataFrame:
    """Parse ``value`` once and lay its fields out as columns.

    The parsed struct goes through ``inline`` because Catalyst would otherwise copy the parse into
    every filter on one of its fields and read each JSON text several times.
    """
    parsed = F.from_json("value", schema, {"mode": mode})
    return records.select(*keep, F.inline(F.array(parsed)))


def _is_read(schema: T.StructType) -> Column:
    """Whether a text held any of the fields; a malformed one holds none."""
    return F.coalesce(*[F.when(F.col(name).isNotNull(), F.lit(True)) for name in schema.names]).isNotNull()


def rejected_records(records: DataFrame, schema: T.StructType) -> DataFrame:
    """The bids, wins or SQL tweets that their parser leaves out, as they came, with the reason."""
    opened = open_json(records, schema, keep=("key", "value"))
    return opened.where(~_is_read(schema)).select("key", "value", F.lit("malformed").alias("reason"))


def _tweet_is_complete() -> Column:
    return (
        F.col("id").isNotNull()
        & F.col("user.id_str").isNotNull()
        & F.col("favorite_count").isNotNull()
        & F.col("entities.hashtags").isNotNull()
        & F.col("entities.user_mentions").isNotNull()
    )


def feed_is_complete() -> Column:
    """Whether a tweet has what the keyword feed prints beyond the core fields, its time apart."""
    nameless_tag = F.exists("entities.hashtags", lambda h: h["text"].isNull())
    return F.col("id_str").isNotNull() & F.col("user.name").isNotNull() & ~nameless_tag


def parse_tweets(records: DataFrame, also: list[str] | None = None, mode: str = "PERMISSIVE") -> DataFrame:
    """Typed tweets. ``also`` names the fields wanted beyond the core ones.

    A record that is not JSON or lacks a core field is left out (``rejected_tweets`` returns it), or
    fails the job under ``mode="FAILFAST"``.
    """
    schema = schemas.subset(schemas.TWEET, TWEET_CORE + (also or []))
    tweets = open_json(records, schema, mode)
    complete = _tweet_is_complete()
    if mode.upper() == "FAILFAST":
        complete = F.when(complete, F.lit(True)).otherwise(F.raise_error(F.lit("tweet lacks a required field")))
    return tweets.where(complete)


def judged_tweets(records: DataFrame, also: list[str]) -> DataFrame:
    """Records as they came, their fields, and why the tweet operators leave one out (``reason``, NULL for the others)."""
    opened = open_json(records, schemas.subset(schemas.TWEET, TWEET_CORE + also), keep=("key", "value"))
    return opened.withColumn("reason", _why_left_out(TWEET_CORE + also))


def _why_left_out(names: list[str]) -> Column:
    something_read = F.coalesce(*[F.when(F.col(name).isNotNull(), F.lit(True)) for name in names])
    return F.when(something_read.isNull(), F.lit("malformed")).when(~_tweet_is_complete(), F.lit("incomplete"))


def rejected_tweets(records: DataFrame, feed: bool = False, dated: bool = False) -> DataFrame:
    """The records ``parse_tweets`` leaves out, as they came, with the reason.

    ``feed`` adds the ones that only the keyword feed leaves out, for want of a readable time or a field; ``dated`` the ones
    that a changelog by interval leaves out, for want of a readable time.
    """
    names = TWEET_CORE + ["id_str", "timestamp_ms"]
    opened = open_json(records, schemas.subset(schemas.TWEET, names), keep=("key", "value"))
    reason = _why_left_out(names)
    if feed:
        reason = reason.when(~feed_is_complete(), F.lit("incomplete"))
    if feed or dated:
        reason = reason.when(millis(F.col("timestamp_ms")).isNull(), F.lit("undated"))
    return opened.select("key", "value", reason.alias("reason")).where("reason IS NOT NULL")


def parse_sql_tweets(records: DataFrame) -> DataFrame:
    """The SQL feed's declared columns, nested objects kept as JSON text; malformed texts are left out."""
    opened = open_json(records, schemas.SQL_TWEET, keep=())
    return opened.where(_is_read(schemas.SQL_TWEET)).withColumn("timestamp_ms", millis(F.col("timestamp_ms")))


def parse_bids(records: DataFrame, sequenced: bool = False) -> DataFrame:
    """Typed bids; ``sequenced`` adds the fields that order bids of one id and instant. Malformed texts are left out."""
    schema = schemas.SEQUENCED_BID if sequenced else schemas.BID
    return open_json(records, schema, keep=()).where(_is_read(schema))


def parse_wins(records: DataFrame) -> DataFrame:
    return open_json(records, schemas.WIN, keep=()).where(_is_read(schemas.WIN))


def parse_user_totals(records: DataFrame) -> DataFrame:
    """Read an output topic back: its keyed JSON as typed totals."""
    return open_json(records, schemas.USER_TOTALS, keep=())
