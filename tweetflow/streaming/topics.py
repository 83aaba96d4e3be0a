"""Topics as streaming sources: a broker, or a folder that files arrive in."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Everything that is there, then stop.
DRAIN = {"availableNow": True}


def kafka_topic(spark: SparkSession, servers: str, topic: str, starting: str = "latest", max_records: int | None = None) -> DataFrame:
    """A topic as (key, value) text. ``starting`` holds for the first start; later the checkpoint decides.

    Needs the Kafka package on the classpath.
    """
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    reader = reader.option("startingOffsets", starting)
    if max_records:
        reader = reader.option("maxOffsetsPerTrigger", max_records)
    return reader.load().select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def names_of_partition(partition: int) -> str:
    """The names of a topic partition's files, where a folder of split lines is dealt to ten partitions.

    Spark numbers the files a task splits its lines into; the last digit, before the ending, says the partition, so every
    file is in exactly one.
    """
    return f"*{partition}.txt*"


def _first_start(spark: SparkSession, path: str) -> datetime:
    """The instant kept in a folder, or this one, kept there from now on."""
    try:
        (kept,) = spark.read.schema("value string").text(path).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        kept = datetime.now(timezone.utc).isoformat()
        spark.createDataFrame([(kept,)], "value string").coalesce(1).write.text(path)
    return datetime.fromisoformat(kept)


def drain_all(started: Iterable[StreamingQuery]) -> None:
    """Start streams side by side and wait until each has ended; if one fails, the others are stopped."""
    queries = []
    try:
        for query in started:
            queries.append(query)
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            query.stop()


def file_topic(
    spark: SparkSession, path: str, starting: str | datetime = "earliest", files_per_trigger: int | None = None,
    started: str | None = None, names: str | None = None,
) -> DataFrame:
    """JSON-lines files that arrive in a folder, oldest first, as (key, value) with no key; of given ``names`` only, a glob pattern.

    ``starting`` is ``earliest``, ``latest`` (files that arrive from the first start on) or a time. ``started`` is a
    folder that keeps the instant of the first start for later ones; ``latest`` needs it.
    """
    reader = spark.readStream.option("latestFirst", "false")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if names:
        reader = reader.option("pathGlobFilter", names)
    lines = reader.text(path)
    if starting == "latest":
        if not started:
            raise ValueError("latest needs a folder that keeps the instant of the first start")
        starting = _first_start(spark, started)
    if starting != "earliest":
        lines = lines.where(F.col("_metadata.file_modification_time") >= F.lit(starting))
    return lines.select(F.lit(None).cast("string").alias("key"), "value")
