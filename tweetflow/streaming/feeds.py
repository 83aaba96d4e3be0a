"""One tweet topic fanned out: transformed tweets, the keyword feed, and the reconciliation.

Each branch is its own streaming query with its own checkpoint, which plays the part of an
application id: started again on the same checkpoint, it goes on where it stopped.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tweetflow.fixed import COMPACTION, MARIO, TRANSFORMED
from tweetflow.operators.totals import totals_from_deltas, user_deltas
from tweetflow.operators.tweets import MARIO_FIELDS, keyed_json, keyword_feed, matches, tweet_transformed
from tweetflow.session import settings, state_settings
from tweetflow.sinks import BatchWriter, append_stream, batch_stream
from tweetflow.sources.records import judged_tweets, parse_tweets
from tweetflow.streaming.running import batch_sums, totals_of_batches


def start_transformed(records: DataFrame, path: str, checkpoint: str, trigger: dict = COMPACTION) -> StreamingQuery:
    out = keyed_json(tweet_transformed(parse_tweets(records)), "userID", TRANSFORMED)
    return append_stream(out, path, checkpoint, trigger)


def start_keyword_feed(records: DataFrame, path: str, checkpoint: str, trigger: dict = COMPACTION) -> StreamingQuery:
    out = keyed_json(keyword_feed(parse_tweets(records, MARIO_FIELDS)), None, MARIO)
    return append_stream(out, path, checkpoint, trigger)


def start_reconciliation(
    records: DataFrame, writers: list[BatchWriter], checkpoint: str, trigger: dict = COMPACTION,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Running totals per user; every writer gets the users that changed in a micro-batch.

    The state is one row per user, kept for ever, in ``state_partitions`` partitions (by default the
    session's shuffle partitions); the checkpoint fixes their number on the first start.
    """
    totals = totals_from_deltas(user_deltas(parse_tweets(records)))
    with settings(records.sparkSession, state_settings(state_partitions)):
        return batch_stream(totals, writers, checkpoint, trigger, "update")


# Where a topology writes what; the sums of its micro-batches are read on by the totals.
SUMMED = "userID string, count long, fav long, hashtags long, mentioned long, ord long, name string, batch_id long"


def only_needed(judged: DataFrame) -> DataFrame:
    """Judged tweets without what no output of a topology prints: the text as it came of accepted records, and the text and
    media of tweets that the keyword feed passes over. What is kept of a micro-batch for its outputs is narrow then.
    """
    printed = F.col("reason").isNull() & matches()
    return judged.select(
        "key", F.when(F.col("reason").isNotNull(), F.col("value")).alias("value"), "id", "id_str", "timestamp_ms",
        F.when(printed, F.col("text")).alias("text"), "lang", "favorite_count",
        F.col("user").dropFields("id", "screen_name").alias("user"),
        F.col("entities").withField("media", F.when(printed, F.col("entities.media"))).alias("entities"), "reason",
    )


def start_topology(records: DataFrame, path: str, checkpoint: str, trigger: dict = COMPACTION) -> StreamingQuery:
    """One read and one parse of a topic for all it feeds, each below ``path`` in a folder of the micro-batch.

    ``transformed`` and ``mario`` are keyed JSON, ``rejected`` has the records that are left out with the reason, and ``sums``
    what each user's totals grow by, which ``start_totals`` reads. A micro-batch that runs again replaces its folders.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        # A micro-batch may be larger than what executors can spare.
        batch.persist(StorageLevel.DISK_ONLY)
        try:
            accepted = batch.where("reason IS NULL")
            outputs = {
                "transformed": keyed_json(tweet_transformed(accepted), "userID", TRANSFORMED),
                "mario": keyed_json(keyword_feed(accepted), None, MARIO),
                "rejected": batch.where("reason IS NOT NULL").select("key", "value", "reason"),
                "sums": batch_sums(accepted).withColumn("batch_id", F.lit(batch_id).cast("long")),
            }
            for name, rows in outputs.items():
                rows.write.mode("overwrite").parquet(f"{path}/{name}/{batch_id:09}")
        finally:
            batch.unpersist()

    judged = only_needed(judged_tweets(records, MARIO_FIELDS))
    return judged.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def start_totals(
    spark: SparkSession, path: str, writers: list[BatchWriter], checkpoint: str, trigger: dict = COMPACTION,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Running totals per user from what a topology writes below ``path``; every writer gets the users that changed."""
    sums = spark.readStream.schema(SUMMED).option("recursiveFileLookup", "true").parquet(f"{path}/sums")
    with settings(spark, state_settings(state_partitions)):
        return batch_stream(totals_of_batches(sums), writers, checkpoint, trigger, "update")


def read_output(spark: SparkSession, path: str, name: str) -> DataFrame:
    """What a topology has written of one output: (key, value), and the reason of a rejected record."""
    schema = "key string, value string" + (", reason string" if name == "rejected" else "")
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{path}/{name}")
