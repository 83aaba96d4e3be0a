"""Files, topics, the index, named tables."""

import json
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tweetflow import schemas, sinks
from tweetflow.operators import tweets
from tweetflow.session import shared_dir
from tweetflow.sinks import export
from tweetflow.streaming import replay


def users(spark, n=1000, partitions=3):
    zero = F.lit(0).cast("bigint")
    return spark.range(0, n, 1, partitions).select(
        F.col("id").cast("string").alias("userID"), F.col("id").alias("count"), zero.alias("fav"), zero.alias("hashtags"),
        F.concat(F.lit("n"), "id").alias("name"), zero.alias("mentioned"),
    )


def files(path, pattern):
    return [f for f in Path(path).glob(pattern) if not f.name.startswith((".", "_"))]


def test_exported_files_hold_100_rows_at_most(spark):
    path = shared_dir(spark, "export")
    sinks.write_files(users(spark, 2500, 1), path)
    written = files(path, "partition=*/part-*")
    sizes = [spark.read.parquet(str(f)).count() for f in written]
    assert max(sizes) == 100 and sum(sizes) == 2500
    assert len(list(Path(path).glob("partition=*"))) == 10


def test_a_key_stays_in_one_partition(spark):
    path = shared_dir(spark, "topic")
    frame = users(spark).unionAll(users(spark)).select(F.col("userID").alias("key"), F.col("name").alias("value"))
    sinks.write_topic(frame, path)
    spread = spark.read.parquet(path).groupBy("key").agg(F.countDistinct("partition").alias("n"))
    assert spread.where("n > 1").count() == 0
    assert rows(sinks.read_topic(spark, path)) == rows(frame)


def test_partitioned_writing_needs_no_shuffle(spark):
    frame = users(spark).withColumn("partition", sinks.partition_of("userID"))
    assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()


def test_keyless_records_are_kept(spark):
    path = shared_dir(spark, "keyless")
    sinks.write_topic(spark.sql("SELECT CAST(NULL AS string) AS key, 'v' AS value"), path)
    assert rows(sinks.read_topic(spark, path)) == [(None, "v")]


def test_split_keeps_order_and_100_lines(spark):
    path = shared_dir(spark, "split")
    sinks.split_lines(spark.range(0, 250, 1, 1).select(F.col("id").cast("string").alias("value")), path)
    texts = [f.read_text().split() for f in sorted(files(path, "part-*"))]
    assert [len(t) for t in texts] == [100, 100, 50]
    assert sum(texts, []) == [str(i) for i in range(250)]


def test_index_lookup_opens_one_bucket_and_pushes_the_id(spark):
    path = shared_dir(spark, "index")
    writer = sinks.index_writer(path)
    writer(users(spark), 0)
    writer(users(spark, 10).withColumn("count", F.col("count") + 100), 1)
    found = sinks.lookup_index(spark, path, "7")
    assert rows(found, "userID", "count") == [("7", 107)]
    assert rows(sinks.lookup_index(spark, path, "70"), "userID", "count") == [("70", 70)]
    assert sinks.lookup_index(spark, path, "none").count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(userID,7)" in plan and "PartitionFilters: [isnotnull(bucket" in plan
    read = spark.read.parquet(path).where((F.col("userID") == "7")).select("bucket").distinct()
    assert read.count() == 1


def test_compacted_index_reads_the_same(spark):
    path = shared_dir(spark, "log")
    for batch in range(3):
        sinks.index_writer(path)(users(spark, 50).withColumn("count", F.lit(batch).cast("bigint")), batch)
    sinks.compact_index(spark, path, f"{path}-compact", 2)
    assert spark.read.parquet(f"{path}-compact").count() == 50
    assert rows(sinks.read_index(spark, f"{path}-compact")) == rows(sinks.read_index(spark, path))


def test_index_reads_cost_the_same_after_many_batches(spark):
    """Every third batch the index is written whole; reads open that folder alone, and a batch may run again."""
    path = shared_dir(spark, "long")
    write = sinks.index_writer(path, whole_every=3)
    counted = {}
    for batch in range(9):
        change = users(spark, 40).where(F.col("count") % 9 <= batch).withColumn("count", F.lit(batch).cast("bigint"))
        change = change.where(F.col("userID").cast("int") % 4 == batch % 4)
        counted |= {r["userID"]: batch for r in change.collect()}
        for _ in range(2):
            write(change, batch)
        read = sinks.read_index(spark, path)
        assert dict(rows(read, "userID", "count")) == counted
        start = batch // 3 * 3
        assert {f.split("/batch_id=")[0].rsplit("/", 1)[1] for f in read.inputFiles()} == {f"whole={start}"}
        assert len({f.split("/batch_id=")[1].split("/")[0] for f in read.inputFiles()}) <= 3
    assert sinks.lookup_index(spark, path, "7").count() == 1
    assert spark.read.parquet(f"{path}-layout").count() == 2


def test_a_whole_write_that_broke_off_leaves_the_index_as_it_was(spark):
    path = shared_dir(spark, "broken")
    write = sinks.index_writer(path, whole_every=2)
    write(users(spark, 30), 0)
    write(users(spark, 10).withColumn("fav", F.lit(1).cast("bigint")), 1)
    before = rows(sinks.read_index(spark, path))
    failing = users(spark, 20).withColumn("fav", F.expr("CASE WHEN count = 19 THEN raise_error('lost') ELSE 2 END").cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        write(failing, 2)
    assert rows(sinks.read_index(spark, path)) == before
    write(users(spark, 20).withColumn("fav", F.lit(2).cast("bigint")), 2)
    assert rows(sinks.read_index(spark, path).groupBy("fav").count()) == [(0, 10), (2, 20)]


def test_buckets_follow_the_number_of_keys(spark, monkeypatch):
    monkeypatch.setattr(sinks, "KEYS_PER_BUCKET", 10)
    path = shared_dir(spark, "grown")
    write = sinks.index_writer(path, whole_every=2)
    for batch, n in enumerate((50, 400, 10)):
        write(users(spark, n), batch)
    assert spark.read.parquet(f"{path}/whole=0").select(F.max("bucket")).first()[0] < 16
    assert 16 <= spark.read.parquet(f"{path}/whole=2").select(F.max("bucket")).first()[0] < 40
    assert sinks.lookup_index(spark, path, "399").count() == 1 and sinks.read_index(spark, path).count() == 400


def test_named_tables_are_replaced(spark):
    path = shared_dir(spark, "named")
    sinks.create_table_as(spark.range(3), "named_rows", f"{path}/a")
    sinks.create_table_as(spark.range(5).withColumnRenamed("id", "n"), "named_rows", f"{path}/b")
    assert spark.table("named_rows").columns == ["n"] and spark.table("named_rows").count() == 5
    sinks.create_table_as(spark.range(2), "named_rows", f"{path}/b")
    assert spark.table("named_rows").count() == 2
    broken = spark.range(2).selectExpr("raise_error('no')")
    with pytest.raises(Exception, match="no"):
        sinks.create_table_as(broken, "named_rows", f"{path}/c")
    assert spark.table("named_rows").count() == 2
    stored = sinks.store_stream_as(spark.range(500).selectExpr("id AS k", "id * 2 AS v"), "stored_stream", f"{path}/s", "k")
    assert spark.table("stored_stream").columns == ["k", "v"] and stored.count() == 500
    assert spark.read.parquet(f"{path}/s").select("partition").distinct().count() == 10
    sinks.create_stream_as(spark.range(2), "named_query")
    sinks.create_stream_as(spark.range(4), "named_query")
    assert spark.table("named_query").count() == 4


def test_shared_dir_uses_the_folder_the_session_names(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_typed_records_must_fit_the_declared_schema(spark):
    assert tweets.user_records(users(spark, 3)).schema.simpleString() == schemas.USER_RECORD.simpleString()
    with pytest.raises(Exception, match="name"):
        tweets.user_records(users(spark, 3).drop("name"))


def test_avro_and_kafka_need_their_packages(spark):
    fields = {f["name"]: f["type"] for f in json.loads(schemas.USER_RECORD_AVRO)["fields"]}
    assert fields == {"userID": "string", "count": "int", "fav": "int", "hashtags": "int", "name": ["null", "string"], "mentioned": "int"}
    typed = tweets.user_records(users(spark, 3))
    with pytest.raises(Exception, match="(?i)avro"):
        tweets.avro_records(typed).collect()
    with pytest.raises(Exception, match="(?i)avro"):
        sinks.write_files(typed, shared_dir(spark, "avro"), fmt="avro")
    with pytest.raises(Exception, match="(?i)kafka"):
        sinks.kafka_writer("localhost:9092", "tweets-reconciliation")(typed, 0)


def test_lines_of_a_topic_are_packed(spark):
    path = shared_dir(spark, "packed")
    lines = spark.range(2_000).selectExpr("repeat(concat('line ', id, ' '), 20) AS value")
    sinks.split_lines(lines.coalesce(1), f"{path}/split", 500, compression=sinks.PACKED)
    replay.topic_sender(f"{path}/sent", sinks.PACKED)(lines, 0)
    for folder, least in ((f"{path}/split", 4), (f"{path}/sent/*", 1)):
        read = spark.read.text(folder)
        sizes = read.select("_metadata.file_path", "_metadata.file_size").distinct().collect()
        assert len(sizes) >= least and all(r["file_path"].endswith(".gz") for r in sizes)
        assert sum(r["file_size"] for r in sizes) * 5 < lines.selectExpr("sum(length(value))").first()[0]
        assert rows(read) == rows(lines)


def test_every_core_writes_the_index(spark):
    """The number of buckets bounds no writers: each task writes the buckets it has keys of."""
    path = shared_dir(spark, "writers")
    sinks.index_writer(path, buckets=2)(users(spark, 400).repartition(4), 0)
    assert spark.read.parquet(path).select("_metadata.file_path").distinct().count() == 4 * 2
    assert sinks.read_index(spark, path).count() == 400


def test_export_files_fill_up_over_micro_batches(spark):
    path = shared_dir(spark, "rolling")
    schema = "userID string, v long"
    write = export.rolling_writer(path, rows_per_file=10, partitions=3)

    def batch(low, high):
        # One key with most rows, and one without a key.
        return spark.range(low, high, numPartitions=4).selectExpr("IF(id % 3 < 2, 'hot', IF(id % 2 = 0, CAST(id AS string), NULL)) AS userID", "id AS v")

    def state():
        files = export.read_files(spark, path, batch(0, 1).schema).select("*", "_metadata.file_path").collect()
        waiting = export.read_waiting(spark, path, batch(0, 1).schema).collect()
        return files, waiting

    def check(high):
        files, waiting = state()
        assert sorted(r["v"] for r in [*files, *waiting]) == list(range(high))
        folders = {}
        for r in files:
            assert r["first_offset"] == r["offset"] - r["offset"] % 10
            folders.setdefault((r["partition"], r["first_offset"]), []).append((r["file_path"], r["offset"]))
        for (_, first), found in folders.items():
            assert len({file for file, _ in found}) == 1 and [offset for _, offset in found] == list(range(first, first + 10))
        for partition in {r["partition"] for r in [*files, *waiting]}:
            offsets = sorted(r["offset"] for r in [*files, *waiting] if r["partition"] == partition)
            assert offsets == list(range(len(offsets)))
            assert sum(r["partition"] == partition for r in waiting) < 10
        return set(folders)

    write(batch(0, 57), 0)
    first = check(57)
    write(batch(57, 58), 1)
    assert check(58) >= first
    write(batch(58, 200), 2)
    names = check(200)
    # Run again, a micro-batch writes the same folders.
    write(batch(58, 200), 2)
    assert check(200) == names
    write(spark.createDataFrame([], schema), 3)
    assert check(200) == names
    write(batch(200, 203), 4)
    check(203)


def test_consecutive_export_files_share_a_folder(spark):
    path = shared_dir(spark, "folders")
    write = export.rolling_writer(path, rows_per_file=10, partitions=2)
    rows_of = lambda low, high: spark.range(low, high, numPartitions=3).selectExpr("CAST(id AS string) AS userID", "id AS v")
    write(rows_of(0, 235), 0)
    for _ in range(2):
        write(rows_of(235, 1000), 1)
    read = export.read_files(spark, path, rows_of(0, 1).schema).select("partition", "first_offset", "_metadata.file_path").distinct().collect()
    assert len(read) > 90 and len({r["file_path"] for r in read}) == len(read)
    assert len({r["file_path"].rsplit("/", 1)[0] for r in read}) < len(read) / 5
    for r in read:
        folder, name = r["file_path"].rsplit("/", 1)
        # Folder and number of a file name its first offset.
        assert f"/partition={r['partition']}/" in folder
        assert int(folder.rsplit("from_offset=", 1)[1]) + 10 * int(name.split(".c", 1)[1][:3]) == r["first_offset"]
