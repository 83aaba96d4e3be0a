"""Tweet projections and filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.avro.functions import from_avro, to_avro

from tweetflow import schemas
from tweetflow.fixed import LANG, WORD
from tweetflow.functions import (
    contains_ignoring_case,
    epoch_ms_to_date,
    hashtag_text,
    json_record,
    media_text,
    millis,
    same_ignoring_case,
    to_int_clamped,
)
from tweetflow.sources.records import feed_is_complete

MARIO_FIELDS = ["id_str", "timestamp_ms", "text", "lang"]


def tweet_transformed(tweets: DataFrame, ordered: bool = False) -> DataFrame:
    """One row per tweet, keyed by its author. ``ordered`` keeps the tweet id, which orders names."""
    return tweets.select(
        F.col("user.id_str").alias("userID"),
        F.lit(1).cast("bigint").alias("count"),
        F.col("favorite_count").alias("fav"),
        F.size("entities.hashtags").cast("bigint").alias("hashtags"),
        F.col("user.name").alias("name"),
        *([F.col("id").alias("ord")] if ordered else []),
    )


def user_mentions(tweets: DataFrame) -> DataFrame:
    """One row per mention, keyed by the mentioned user; a tweet without mentions gives none."""
    mentions = tweets.select(F.explode("entities.user_mentions.id_str").alias("userID"))
    return mentions.where("userID IS NOT NULL").select("userID", F.lit(1).cast("bigint").alias("mentioned"))


def matches(lang: str = LANG, word: str = WORD) -> Column:
    """Whether a tweet is of a language and its text contains a word, both compared without regard to case."""
    return same_ignoring_case(F.col("lang"), lang) & contains_ignoring_case(F.col("text"), word)


def keyword_feed(tweets: DataFrame, lang: str = LANG, word: str = WORD) -> DataFrame:
    """Tweets of one language that contain a word, both compared without regard to case.

    ``screen_name`` holds the user's display name. Tweets without a readable time or a printed field are
    left out.
    """
    matching = tweets.where(matches(lang, word))
    dated = matching.withColumn("ms", millis(F.col("timestamp_ms"))).where(F.col("ms").isNotNull() & feed_is_complete())
    return dated.select(
        "key",
        F.col("id_str").alias("id"),
        F.col("user.id_str").alias("user_id"),
        F.col("user.name").alias("screen_name"),
        epoch_ms_to_date(F.col("ms")).alias("created_at"),
        "text",
        media_text(F.col("entities.media")).alias("medias"),
        hashtag_text(F.col("entities.hashtags")).alias("hashtags"),
    )


def sql_tweets_transformed(tweets_raw: DataFrame) -> DataFrame:
    """The SQL feed flattened: nested text opened by path, each text parsed once.

    A scalar comes out as its text, an object or array as JSON text, an absent path as NULL.
    """
    user = F.from_json("user", "id string, name string, screen_name string")
    entities = F.from_json("entities", "hashtags string, user_mentions string")
    opened = tweets_raw.withColumns({"u": user, "e": entities})
    return opened.select(
        epoch_ms_to_date(F.col("timestamp_ms")).alias("created_at"),
        "id",
        "text",
        F.col("favorite_count").alias("fav"),
        F.col("u.id").alias("user_id"),
        F.col("u.name").alias("user_name"),
        F.col("u.screen_name").alias("user_screen_name"),
        F.col("e.hashtags").alias("hashtags"),
        F.col("e.user_mentions").alias("user_mentions"),
        "lang",
    )


def sql_keyword_feed(transformed: DataFrame, lang: str = LANG, word: str = WORD) -> DataFrame:
    """The SQL feed's variant: both comparisons respect case, ``screen_name`` is the real one."""
    return transformed.where(F.contains("text", F.lit(word)) & (F.col("lang") == lang)).select(
        "id", "user_id", F.col("user_screen_name").alias("screen_name"), "created_at", "hashtags", "text"
    )


def keyed_json(records: DataFrame, key: str | None, fields: list[str]) -> DataFrame:
    """(key, value) records ready for a topic. Without a key column the input's own key passes through."""
    return records.select(F.col(key or "key").alias("key"), json_record(*fields).alias("value"))


def user_records(totals: DataFrame) -> DataFrame:
    """Totals as typed records with 32-bit counters, checked against the declared schema."""
    typed = {name: to_int_clamped(F.col(name)) for name in ("count", "fav", "hashtags", "mentioned")}
    return totals.withColumns(typed).select(*schemas.USER_RECORD.names).to(schemas.USER_RECORD)


def avro_records(records: DataFrame, key: str = "userID") -> DataFrame:
    """Typed user records as (key, Avro value); needs the Avro package on the classpath.

    Columns that do not fit the declared schema fail before a job starts.
    """
    value = to_avro(F.struct(*schemas.USER_RECORD.names), schemas.USER_RECORD_AVRO)
    return records.select(F.col(key).alias("key"), value.alias("value"))


def from_avro_records(records: DataFrame) -> DataFrame:
    """Read a topic of Avro user records back; needs the Avro package on the classpath."""
    return records.select(from_avro("value", schemas.USER_RECORD_AVRO).alias("r")).select("r.*")


def user_lookup(totals: DataFrame, user_id: str) -> DataFrame:
    """The totals of one user."""
    return totals.where(F.col("userID") == user_id)
