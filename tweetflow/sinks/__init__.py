"""Where results go: topics, files, an index by key, named tables, the console.

Batch writers that a stream calls once per micro-batch write to a folder of that batch and replace it
when the batch is run again, so a restart neither loses nor doubles rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tweetflow import schemas
from tweetflow.fixed import PARTITIONS, ROWS_PER_FILE, TOTALS
from tweetflow.operators.totals import latest_by_key
from tweetflow.operators.tweets import keyed_json, user_records

# An index has one bucket for so many keys, and so many at least; every so many micro-batches it is written whole.
KEYS_PER_BUCKET, LEAST_BUCKETS, WHOLE_EVERY = 10_000_000, 16, 16
# Rows of a bucket of co-partitioned tables.
ROWS_PER_BUCKET = 2_000_000
# How lines of a topic are packed; readers go by the file's ending.
PACKED = "gzip"

BatchWriter = Callable[[DataFrame, int], None]


def partition_of(key: str | Column, partitions: int = PARTITIONS) -> Column:
    """The partition a key belongs to; NULL keys share one."""
    return F.pmod(F.hash(key), F.lit(partitions)).alias("partition")


def write_topic(records: DataFrame, path: str, key: str = "key", partitions: int = PARTITIONS, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write (key, value) records, one folder per partition so that a key stays in one place.

    Every task writes its own files into the folders: rows of one key meet without a shuffle, and a key
    with very many rows burdens no single task.
    """
    records.withColumn("partition", partition_of(key, partitions)).write.mode(mode).partitionBy("partition").format(fmt).save(path)


def read_topic(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).schema("key string, value string, partition int").load(path).select("key", "value")


def write_kafka(records: DataFrame, servers: str, topic: str) -> None:
    """Write (key, value) records to a broker; needs the Kafka package on the classpath."""
    records.select("key", "value").write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def kafka_writer(servers: str, topic: str, key: str = "userID", fields: list[str] | None = None) -> BatchWriter:
    """Sends each micro-batch of a table's updates to a broker as keyed JSON."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_kafka(keyed_json(batch, key, fields or batch.columns), servers, topic)

    return write


def write_files(
    rows: DataFrame, path: str, key: str = "userID", rows_per_file: int = ROWS_PER_FILE,
    partitions: int = PARTITIONS, fmt: str = "parquet", mode: str = "overwrite",
) -> None:
    """Export rows as files of at most ``rows_per_file`` rows, one folder per partition of the key.

    ``fmt="avro"`` needs the Avro package on the classpath.
    """
    (
        rows.withColumn("partition", partition_of(key, partitions))
        .write.mode(mode).option("maxRecordsPerFile", rows_per_file).partitionBy("partition").format(fmt).save(path)
    )


def split_lines(records: DataFrame, path: str, lines_per_file: int = ROWS_PER_FILE, mode: str = "append", compression: str = "none") -> None:
    """Write record values as text files of at most ``lines_per_file`` lines, the input of a replay.

    ``compression=PACKED`` makes files of a fraction of their lines' bytes, each of which one task reads.
    """
    lines = records.select("value").write.mode(mode).option("maxRecordsPerFile", lines_per_file)
    lines.option("compression", compression).text(path)


def _bucket(key: str | Column, buckets: int) -> Column:
    return F.pmod(F.hash(key), F.lit(buckets)).alias("bucket")


def _batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def changelog_writer(path: str, key: str = "userID", fields: list[str] | None = None) -> BatchWriter:
    """Appends each micro-batch of a table's updates as keyed JSON."""

    def write(batch: DataFrame, batch_id: int) -> None:
        keyed_json(batch, key, fields or batch.columns).write.mode("overwrite").parquet(_batch_folder(path, batch_id))

    return write


def read_changelog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("key string, value string, batch_id bigint").parquet(path)


def typed_writer(path: str, fmt: str = "parquet") -> BatchWriter:
    """Appends each micro-batch of user totals as typed records."""

    def write(batch: DataFrame, batch_id: int) -> None:
        user_records(batch).write.mode("overwrite").format(fmt).save(_batch_folder(path, batch_id))

    return write


def index_writer(path: str, key: str = "userID", buckets: int | None = None, whole_every: int = WHOLE_EVERY) -> BatchWriter:
    """Upserts each micro-batch into an index by key: the row of the latest batch counts.

    Rows are laid out by bucket of the key and sorted by key, so that a lookup opens one bucket. Every task writes
    into the buckets it has keys of, so the number of buckets bounds no writers.

    Every ``whole_every`` batches the index as it stands is written whole, and batches after it add to that folder,
    so a read meets so many batches at most however long the stream has run. The number of buckets is chosen anew
    then, by the number of keys, and kept beside the index in one of two slots in turn: the earlier folder and its
    slot stay until the new ones are complete, and a batch that is run again finds them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last = _last_whole(spark, path, batch_id)
        if last and batch_id - last["start"] < whole_every:
            _write_buckets(batch, f"{path}/whole={last['start']}", batch_id, key, last["buckets"])
            return
        rows = batch
        if last:
            before = _index_rows(spark, path, last).where(F.col("batch_id") < batch_id).drop("bucket")
            both = before.unionByName(batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")))
            rows = latest_by_key(both, [key], ["batch_id"]).drop("batch_id").repartitionByRange(_bucket(key, last["buckets"]), key)
        chosen = buckets or max(LEAST_BUCKETS, -(-rows.count() // KEYS_PER_BUCKET))
        _write_buckets(rows, f"{path}/whole={batch_id}", batch_id, key, chosen)
        layout = spark.createDataFrame([(batch_id, chosen)], "start bigint, buckets int").coalesce(1)
        layout.write.mode("overwrite").parquet(f"{path}-layout/slot={1 - last['slot'] if last else 0}")

    return write


def _write_buckets(rows: DataFrame, folder: str, batch_id: int, key: str, buckets: int) -> None:
    laid = rows.withColumn("bucket", _bucket(key, buckets)).sortWithinPartitions("bucket", key)
    laid.write.mode("overwrite").partitionBy("bucket").parquet(_batch_folder(folder, batch_id))


def _last_whole(spark: SparkSession, path: str, before: int | None = None) -> Row | None:
    """Where the index was last written whole (start, buckets, slot), of those before a micro-batch if one is given."""
    try:
        kept = spark.read.schema("start bigint, buckets int, slot int").parquet(f"{path}-layout")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    kept = kept if before is None else kept.where(F.col("start") < before)
    return kept.orderBy(F.col("start").desc()).first()


def _index_rows(spark: SparkSession, path: str, whole: Row) -> DataFrame:
    layout = [T.StructField("batch_id", T.LongType()), T.StructField("bucket", T.IntegerType())]
    return spark.read.schema(T.StructType(schemas.USER_TOTALS.fields + layout)).parquet(f"{path}/whole={whole['start']}")


def _written(spark: SparkSession, path: str) -> Row:
    whole = _last_whole(spark, path)
    if whole is None:
        raise ValueError(f"no index at {path}")
    return whole


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The index as it stands: the last row written per key."""
    return latest_by_key(_index_rows(spark, path, _written(spark, path)), ["userID"], ["batch_id"]).select(*TOTALS)


def lookup_index(spark: SparkSession, path: str, user_id: str) -> DataFrame:
    """One document by its id: reads one bucket, with the id pushed to the scan."""
    whole = _written(spark, path)
    rows = _index_rows(spark, path, whole).where(
        (F.col("bucket") == _bucket(F.lit(user_id), whole["buckets"])) & (F.col("userID") == user_id)
    )
    return latest_by_key(rows, ["userID"], ["batch_id"]).select(*TOTALS)


def compact_index(spark: SparkSession, path: str, target: str, batch_id: int) -> None:
    """Write the index as it stands to another folder, as the batch a stream's next ones will follow."""
    index_writer(target)(read_index(spark, path), batch_id)


def console_writer(line: Callable[[str], None] = print) -> BatchWriter:
    """Prints every row of each micro-batch where it is, on the executors."""

    def show(rows: Iterator[Row]) -> None:
        for row in rows:
            line(str(row.asDict()))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.foreachPartition(show)

    return write


def create_stream_as(rows: DataFrame, name: str) -> None:
    """Put a name on a query; nothing is stored, and an earlier query of that name is replaced."""
    rows.createOrReplaceTempView(name)


def create_table_as(rows: DataFrame, name: str, path: str) -> None:
    """Store a query's rows as a named table below a path. An earlier table is replaced once all rows are written."""
    place = f"{path}/{uuid.uuid4().hex}"
    rows.write.parquet(place)
    rows.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    rows.sparkSession.catalog.createTable(name, place, "parquet", rows.schema)


def store_stream_as(rows: DataFrame, name: str, path: str, key: str, partitions: int = PARTITIONS) -> DataFrame:
    """Store a query as a named stream partitioned by a key, and read it back under its name."""
    rows.withColumn("partition", partition_of(key, partitions)).write.mode("errorifexists").partitionBy("partition").parquet(path)
    rows.sparkSession.read.schema(rows.schema).parquet(path).select(*rows.columns).createOrReplaceTempView(name)
    return rows.sparkSession.table(name)


def store_copartitioned(rows: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Store rows as a named table partitioned by a key into so many buckets, each one sorted file.

    Tables of equal bucket numbers are joined on the key, and grouped by it, without a shuffle; the one here is paid once, at
    writing. A key's rows are in one bucket, so for keys that hold a large share of all rows a join that may split them is
    the better one.
    """
    rows.repartition(buckets, key).write.mode("errorifexists").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return rows.sparkSession.table(name)


def bucket_count(*tables: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Buckets for tables that are to be joined: by the rows of the largest."""
    return max(1, *(-(-table.count() // rows_per_bucket) for table in tables))


def send_stream(records: DataFrame, servers: str, topic: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    """Send a stream of (key, value) records to a broker; needs the Kafka package on the classpath."""
    return (
        records.select("key", "value").writeStream.outputMode("append").format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def batch_stream(rows: DataFrame, writers: list[BatchWriter], checkpoint: str, trigger: dict, mode: str = "append") -> StreamingQuery:
    """Hand every micro-batch of a stream to writers, computed once for all of them."""

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for write in writers:
                write(batch, batch_id)
        finally:
            batch.unpersist()

    return rows.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def append_stream(records: DataFrame, path: str, checkpoint: str, trigger: dict, fmt: str = "parquet") -> StreamingQuery:
    """Write a stream of new rows to files; each row lands exactly once."""
    return (
        records.writeStream.outputMode("append").format(fmt).option("path", path)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )
