"""Tables read from the state of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tweetflow.fixed import TOTALS
from tweetflow.operators.totals import COUNTERS

# The reconciliation's state of a user, in the order of its aggregates.
_USER = ", ".join([*(f"{c}: bigint" for c in COUNTERS), "first: struct<ord: bigint, name: string>"])


def state_of(spark: SparkSession, checkpoint: str, batch_id: int | None = None, variable: str | None = None) -> DataFrame:
    """(key, value, partition_id) of a stream's state after its last micro-batch, or after an earlier one that is kept."""
    reader = spark.read.format("statestore")
    for option, value in (("batchId", batch_id), ("stateVarName", variable)):
        if value is not None:
            reader = reader.option(option, value)
    return reader.load(checkpoint)


def user_totals(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The reconciliation as the state of its stream has it: one row per user who has written.

    Nothing but the state is read, so it takes as long as there are users, however many updates there were; the stream may
    be running, stopped or on its way back.
    """
    users = state_of(spark, checkpoint, batch_id).select("key.userID", F.col("value").cast(f"struct<{_USER}>").alias("v"))
    return users.select("userID", "v.*").where("count > 0").withColumn("name", F.col("first.name")).select(*TOTALS)


def last_bids(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The last bid (id, cP) of each auction as the live reconciliation's state has it."""
    slots = state_of(spark, checkpoint, batch_id, "last")
    return slots.select(F.inline(F.arrays_zip(F.col("value.ids").alias("id"), F.col("value.cPs").alias("cP"))))
