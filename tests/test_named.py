"""Continuous named queries, running tables of their own state, and tables read from state."""

import random
import time

import pytest
from conftest import rows, tweet
from pyspark.sql import functions as F
from test_streaming import expected, publish

from tweetflow import sinks
from tweetflow.operators import totals
from tweetflow.session import shared_dir
from tweetflow.sources import records as source
from tweetflow.streaming import feeds, named, running, state, topics


@pytest.fixture
def to(spark):
    return named.Statements(spark, shared_dir(spark, "named"), 2)


def arrive(to, *pairs):
    to.session.createDataFrame(pairs, "k string, v string").coalesce(1).write.mode("append").json(f"{to.path}/in")
    return to.session.readStream.schema("k string, v string").json(f"{to.path}/in")


def test_queries_on_queries_go_on_after_a_restart(to, spark):
    """A stream, a stream over it, a table over that and a stream of the table's updates."""
    def chain(rows_in):
        again = named.Statements(spark, to.path, 2)
        again.create_stream_as("n_all", rows_in, topics.DRAIN).awaitTermination()
        again.create_stream_as("n_some", again.stream("n_all").where("v <> 'x'"), topics.DRAIN).awaitTermination()
        again.create_table_as("n_count", totals.count_by(again.stream("n_some"), "k", "count"), topics.DRAIN).awaitTermination()
        again.create_stream_as("n_log", again.stream("n_count"), topics.DRAIN).awaitTermination()
        return again

    now = chain(arrive(to, ("a", "1"), ("a", "x"), ("b", "2"), (None, "3")))
    assert rows(now.table("n_count", "userid")) == [("a", 1), ("b", 1)]
    now = chain(arrive(to, ("a", "4"), ("c", "5"), ("c", "x")))
    assert rows(now.rows("n_some"), "v") == [("1",), ("2",), ("3",), ("4",), ("5",)]
    assert rows(now.table("n_count", "userid")) == [("a", 2), ("b", 1), ("c", 1)]
    # Only keys that changed are in the second update; the stream over the table has every update once.
    assert rows(now.rows("n_log")) == [("a", 1, 0), ("a", 2, 1), ("b", 1, 0), ("c", 1, 1)]
    now = chain(now.session.readStream.schema("k string, v string").json(f"{to.path}/in"))
    assert now.rows("n_log").count() == 4


def test_rows_of_a_named_stream_are_packed(to):
    to.create_stream_as("n_packed", arrive(to, ("a", "1"), ("b", "2")), topics.DRAIN).awaitTermination()
    held = to.rows("n_packed")
    assert rows(held) == [("a", "1"), ("b", "2")] and all(file.endswith(".zstd.parquet") for file in held.inputFiles())


def test_a_dropped_name_may_be_taken_by_another_query(to):
    read = arrive(to, ("a", "1"), ("b", "2"))
    query = to.create_stream_as("n_taken", read, {"processingTime": "1 second"})
    query.processAllAvailable()
    assert query.isActive and query.name == "n_taken"
    to.drop("n_taken")
    assert not query.isActive
    to.create_table_as("n_taken", totals.count_by(read, "k", "n"), topics.DRAIN).awaitTermination()
    assert rows(to.table("n_taken", "userid")) == [("a", 1), ("b", 1)]
    to.drop("n_taken")
    to.drop("n_taken")


def test_the_callers_options_stay(spark, to):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    to.create_table_as("n_options", totals.count_by(arrive(to, ("a", "1")), "k", "n"), topics.DRAIN).awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before != to.session.conf.get("spark.sql.shuffle.partitions")


@pytest.mark.parametrize("k", [1, 3])
def test_running_top_k_equals_the_batch_form(to, k):
    """Repeats are kept, NULL keys and values are not; keys without a value have an empty list."""
    rng = random.Random(k)
    pairs = [(rng.choice(["a", "b", "hot", "hot", "hot", None]), rng.choice([*"abcdeé漢", None])) for _ in range(300)]
    pairs = [("empty", None), *pairs, ("empty", None)]
    for wave in (pairs[:100], pairs[100:110], pairs[110:]):
        read = arrive(to, *wave)
        name = f"n_top{k}"
        to.create_table_as(name, running.running_top_k(read, "k", "v", k, "best"), topics.DRAIN).awaitTermination()
    batch = totals.top_k(to.session.createDataFrame(pairs, "k string, v string"), "k", "v", k, "best")
    assert rows(to.table(name, "userid")) == rows(batch)
    to.drop(name)


def test_a_list_that_stays_is_not_sent_again(to):
    for wave in ([("a", "9"), ("b", "1")], [("a", "2"), ("b", "5")]):
        read = arrive(to, *wave)
        to.create_table_as("n_same", running.running_top_k(read, "k", "v", 1, "best"), topics.DRAIN).awaitTermination()
    assert rows(to.rows("n_same")) == [("a", ["9"], 0), ("b", ["1"], 0), ("b", ["5"], 1)]
    to.drop("n_same")


def compact(to, name, interval_ms):
    read = source.parse_tweets(topics.file_topic(to.session, f"{to.path}/in"))
    return to.create_table_as(name, running.compacted_totals(read, interval_ms), {"processingTime": "300 milliseconds"})


def test_updates_are_held_back_for_an_interval(spark, to, records):
    """Several updates within an interval give one record; ids beyond doubles keep their order; a restart loses nothing held."""
    big = 2**60
    interval = 8_000
    first = [tweet(big + 1, user="1", name="B", fav=1), tweet(2, user="2", mentions=["1", "9"])]
    second = [tweet(big, user="1", name="A", fav=2, mentions=["2"])]
    publish(spark, f"{to.path}/in", *first)
    query = compact(to, "n_held", interval)
    try:
        # Begin right after an interval's end, so that both updates fall into one.
        while not query.recentProgress or not query.recentProgress[0]["numInputRows"]:
            time.sleep(0.1)
    finally:
        query.stop()
    publish(spark, f"{to.path}/in", *second)
    query = compact(to, "n_held", interval)
    try:
        running.await_quiet(query, interval, 120)
        publish(spark, f"{to.path}/in", tweet(big + 2, user="1", name="C"))
        running.await_quiet(query, interval, 120)
    finally:
        query.stop()
    log = to.rows("n_held").orderBy("until").collect()
    assert rows(to.table("n_held", "userID").drop("until")) == expected(records, *first, *second, tweet(big + 2, user="1", name="C"))
    by_interval = {(r["userID"], r["until"]) for r in log}
    assert len(by_interval) == len(log), "one record per user and interval"
    assert all(r["until"] % interval == 0 for r in log)
    assert {r["name"] for r in log if r["userID"] == "1" and r["count"] > 1} == {"A"}
    assert "9" not in {r["userID"] for r in log}
    to.drop("n_held")


def test_await_quiet_gives_up(spark, to):
    publish(spark, f"{to.path}/in", tweet(1))
    query = compact(to, "n_slow", 3_600_000)
    try:
        with pytest.raises(TimeoutError):
            running.await_quiet(query, 3_600_000, 2)
    finally:
        to.drop("n_slow")


def test_the_table_from_state(spark, records):
    path = shared_dir(spark, "state")
    waves = [[tweet(1, user="1", mentions=["2", "3"])], [tweet(2, user="2", fav=7), tweet(3, user="1", name="Z")]]
    for wave in waves:
        publish(spark, f"{path}/in", *wave)
        lines = topics.file_topic(spark, f"{path}/in")
        feeds.start_reconciliation(lines, [sinks.changelog_writer(f"{path}/out")], f"{path}/c", topics.DRAIN).awaitTermination()
    assert rows(state.user_totals(spark, f"{path}/c")) == expected(records, *waves[0], *waves[1])
    assert rows(state.user_totals(spark, f"{path}/c", 0)) == expected(records, *waves[0])
    # The user who is only mentioned is in the state, and counts once it writes.
    assert "3" in {r["key"]["userID"] for r in state.state_of(spark, f"{path}/c").collect()}


def test_state_reads_no_update(spark):
    path = shared_dir(spark, "state")
    publish(spark, f"{path}/in", tweet(1))
    feeds.start_reconciliation(topics.file_topic(spark, f"{path}/in"), [sinks.changelog_writer(f"{path}/out")], f"{path}/c", topics.DRAIN).awaitTermination()
    plan = state.user_totals(spark, f"{path}/c").where(F.col("userID") == "1")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "FileScan" not in plan
