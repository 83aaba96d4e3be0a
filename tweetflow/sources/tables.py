"""Record streams derived from the given tables (FIXTURES.md): one JSON text per event, bid or win."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tweetflow.functions import epoch_ms

# Restricts the source table before records are built, so that the filter reaches the Parquet scan.
Narrow = Callable[[DataFrame], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _first(items: list[int], count: Column) -> Column:
    """The first ``count`` of a short literal list."""
    return F.slice(F.array(*[F.lit(i).cast("bigint") for i in items]), 1, count.cast("int"))


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows without a key dealt evenly, at every size, as a producer deals them to a topic's partitions.

    The tables come in files that one task has to read whole; the session's shuffle partitions say how many tasks
    make and parse records. Rows are still a few numbers here, no texts.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _record(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields))


def tweet_records(spark: SparkSession, sf_dir: str, narrow: Narrow | None = None) -> DataFrame:
    """One tweet per event, its text and language taken from a document."""
    documents = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("doc_text"), F.col("lang").alias("doc_lang"))
    events = table(spark, sf_dir, "events")
    document_count = documents.select(F.count(F.lit(1))).scalar()
    user_count = events.select(F.max("user_id") + 1).scalar()
    if narrow:
        events = narrow(events)

    event, user = F.col("event_id"), F.col("user_id")
    events = events.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        epoch_ms("ts").alias("ms"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        (event % document_count).alias("doc_id"),
        F.floor(user_count * 4 / 3).alias("mentionable"),
    )
    k = F.col("k")
    prefix = F.when(event % 7 == 0, "Mario ").when(event % 7 == 1, "mario ").when(event % 7 == 2, "MARIO ").otherwise("")
    mentioned = F.filter(
        F.transform(_first([0, 1], k % 3), lambda i: (user * 7 + i * 13 + event) % F.col("mentionable")),
        lambda m: m % 10 != 0,
    )
    media_url = lambda i: F.concat(F.lit("http://media.example/"), event, F.lit("/"), i, F.lit(".jpg"))
    media = F.transform(
        _first([0, 1], k % 2 + 1),
        lambda i: F.struct(
            (event * 10 + i).cast("string").alias("id_str"),
            F.when(event % 11 != 0, media_url(i)).alias("media_url"),
        ),
    )
    entities = F.struct(
        F.transform(_first([0, 1, 2], k % 4), lambda i: F.struct(F.concat(F.lit("tag"), (k + i) % 10).alias("text"))).alias("hashtags"),
        F.transform(mentioned, lambda m: F.struct(m.cast("string").alias("id_str"))).alias("user_mentions"),
        F.when(F.col("event_type") == "view", media).alias("media"),
    )
    author = F.struct(
        user.alias("id"),
        user.cast("string").alias("id_str"),
        F.concat(F.lit("User "), user, F.lit(" v"), event % 3).alias("name"),
        F.concat(F.lit("u"), user, F.lit("_"), event % 4).alias("screen_name"),
    )
    # Both sides grow with the data, so neither is offered for a broadcast.
    return events.hint("shuffle_merge").join(documents, "doc_id").select(
        F.lit(None).cast("string").alias("key"),
        _record(
            event.alias("id"),
            event.cast("string").alias("id_str"),
            F.col("ms").cast("string").alias("timestamp_ms"),
            F.concat(prefix, "doc_text").alias("text"),
            F.when(event % 5 == 0, F.upper("doc_lang")).otherwise(F.col("doc_lang")).alias("lang"),
            F.floor("value").alias("favorite_count"),
            author.alias("user"),
            entities.alias("entities"),
        ).alias("value"),
    )


def bid_records(spark: SparkSession, sf_dir: str, narrow: Narrow | None = None) -> DataFrame:
    """One bid per order line; the auction is the order."""
    lines = table(spark, sf_dir, "lineitem")
    lines = narrow(lines) if narrow else lines
    lines = lines.select("l_shipdate", "l_orderkey", "l_suppkey", "l_discount", "l_linenumber", "l_partkey")
    return _dealt(lines).select(
        F.lit(None).cast("string").alias("key"),
        _record(
            epoch_ms("l_shipdate").alias("timestamp"),
            F.col("l_orderkey").cast("string").alias("id"),
            F.col("l_suppkey").cast("string").alias("advertiserId"),
            ((F.round(F.col("l_discount") * 100).cast("int") - 3) / F.lit(100.0)).alias("clickProbability"),
            F.col("l_linenumber").alias("seq_a"),
            F.col("l_partkey").alias("seq_b"),
            F.col("l_suppkey").alias("seq_c"),
        ).alias("value"),
    )


def win_records(spark: SparkSession, sf_dir: str, narrow: Narrow | None = None) -> DataFrame:
    """One win per order."""
    orders = table(spark, sf_dir, "orders")
    orders = narrow(orders) if narrow else orders
    return _dealt(orders.select("o_orderdate", "o_orderkey", "o_custkey", "o_totalprice")).select(
        F.lit(None).cast("string").alias("key"),
        _record(
            epoch_ms("o_orderdate").alias("timestamp"),
            F.col("o_orderkey").cast("string").alias("auctid"),
            F.col("o_custkey").cast("string").alias("advertiserId"),
            F.col("o_totalprice").alias("winPrice"),
        ).alias("value"),
    )
