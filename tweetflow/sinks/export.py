"""Export files that fill up over micro-batches, named by topic partition and first offset."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tweetflow.fixed import PARTITIONS, ROWS_PER_FILE
from tweetflow.session import settings
from tweetflow.sinks import BatchWriter, partition_of

_PLACE = T.StructType([T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType())])
_NEXT = "partition int, next long"
# An attempt that runs again writes files of the same names and rows, and a micro-batch that does replaces its folder, so nothing
# needs to be held back until all tasks are done.
_COMMIT_BY_TASKS = "mapreduce.fileoutputcommitter.algorithm.version"
# Folders are listed by a task each, by default; so many tasks per core list what there is, and so many write.
_LISTED_BY, _LISTERS, _TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism", 4, 8
# Consecutive files that lie in one folder, at most.
FILES_PER_FOLDER = 10


def _or_nothing(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """What a folder holds; no rows if there is no such folder."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def with_offsets(rows: DataFrame, stage: str, before: DataFrame) -> DataFrame:
    """Rows (partition, ...) with the offset of each in its partition: gapless, from ``before`` (partition, next) on.

    Rows are written to a stage once, with their place in their task, so that numbers stay as they are when a task runs
    again. An offset is the place within the task and partition, after what tasks before it have of the partition: a prefix
    sum over one row per task and partition. No partition's rows are brought together.
    """
    placed = rows.sortWithinPartitions("partition").select("*", F.spark_partition_id().alias("_task"), F.monotonically_increasing_id().alias("_id"))
    placed.write.mode("overwrite").parquet(stage)
    staged = rows.sparkSession.read.schema(placed.schema).parquet(stage)
    counts = staged.groupBy("partition", "_task").agg(F.count("*").alias("many"), F.min("_id").alias("least"))
    so_far = Window.partitionBy("partition").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.withColumn("tasks", F.coalesce(F.sum("many").over(so_far), F.lit(0))).join(before, "partition", "left")
    start = F.coalesce("next", F.lit(0).cast("long")) + F.col("tasks") - F.col("least")
    shifts = shifts.select("partition", "_task", start.alias("_start"))
    numbered = staged.join(shifts, ["partition", "_task"])
    return numbered.withColumn("offset", F.col("_start") + F.col("_id")).drop("_task", "_id", "_start")


def rolling_writer(path: str, key: str = "userID", rows_per_file: int = ROWS_PER_FILE, partitions: int = PARTITIONS, fmt: str = "parquet") -> BatchWriter:
    """Appends each micro-batch to export files of exactly ``rows_per_file`` rows, in the order of offsets.

    Files lie in folders ``batch_id=B/partition=P/from_offset=N``, of the micro-batch that filled them; N is the first offset of a
    folder's first file, and the others follow in the order of their numbers (c000, c001 and so on), so folder and number name
    the first offset of each. A file is complete, however many micro-batches it took to fill. Rows that do not fill a file
    yet wait with the micro-batch that left them, and open the next one's files. A micro-batch that runs
    again starts from what the one before left and writes the same folders. The writer has to be called for every
    micro-batch of its stream.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        waiting = _or_nothing(spark, f"{path}/open/batch_id={batch_id - 1}", T.StructType(batch.schema.fields + _PLACE.fields))
        before = _or_nothing(spark, f"{path}/offsets/batch_id={batch_id - 1}", _NEXT)
        new = with_offsets(batch.withColumn("partition", partition_of(key, partitions)), f"{path}/stage/batch_id={batch_id}", before)
        ends = new.groupBy("partition").agg((F.max("offset") + 1).alias("next"))
        after = before.unionByName(ends).groupBy("partition").agg(F.max("next").alias("next"))
        after.write.mode("overwrite").parquet(f"{path}/offsets/batch_id={batch_id}")
        after = spark.read.schema(_NEXT).parquet(f"{path}/offsets/batch_id={batch_id}")
        full = after.select("partition", (F.col("next") - F.col("next") % rows_per_file).alias("_full"))
        old = before.select("partition", (F.col("next") - F.col("next") % rows_per_file).alias("_begun"))
        # At most one row per topic partition.
        rows = waiting.unionByName(new).join(F.broadcast(full), "partition").join(F.broadcast(old), "partition", "left")
        rows.where(F.col("offset") >= F.col("_full")).drop("_full", "_begun").write.mode("overwrite").parquet(f"{path}/open/batch_id={batch_id}")
        filled = rows.where(F.col("offset") < F.col("_full"))
        filled = filled.withColumn("first_offset", F.col("offset") - F.col("offset") % rows_per_file)
        folder = F.col("offset") - F.col("offset") % (FILES_PER_FOLDER * rows_per_file)
        filled = filled.withColumn("from_offset", F.greatest(folder, "_begun")).drop("_full", "_begun")
        # Files cost time by their number, not by their bytes, so the number of tasks is given. They put their files in place
        # themselves; one by one that would take the driver longer than all tasks write.
        tasks = _TASKS * spark.sparkContext.defaultParallelism
        (
            filled.repartition(tasks, "partition", "from_offset").sortWithinPartitions("partition", "from_offset", "offset")
            .write.mode("overwrite").option("partitionOverwriteMode", "static").option(_COMMIT_BY_TASKS, "2")
            .option("maxRecordsPerFile", rows_per_file).partitionBy("partition", "from_offset")
            .format(fmt).save(f"{path}/files/batch_id={batch_id}")
        )

    return write


def read_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """The rows of the complete files, with partition, first_offset and offset."""
    laid = T.StructType([*schema.fields, *_PLACE.fields, T.StructField("first_offset", T.LongType())])
    with settings(spark, {_LISTED_BY: str(_LISTERS * spark.sparkContext.defaultParallelism)}):
        read = spark.read.format(fmt).schema(laid).load(f"{path}/files")
    return read.drop("batch_id", "from_offset")


def read_waiting(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows that do not fill a file yet, with partition and offset."""
    last = spark.read.schema(f"{_NEXT}, batch_id long").parquet(f"{path}/offsets").agg(F.max("batch_id")).first()[0]
    return _or_nothing(spark, f"{path}/open/batch_id={last or 0}", T.StructType([*schema.fields, *_PLACE.fields]))
