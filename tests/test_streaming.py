"""Streams: restart, pace, start position, arrival order, and the same end state as batch."""

import json
import time
from datetime import datetime, timezone

import pytest
from conftest import rows, tweet
from pyspark.sql import functions as F

from tweetflow import sinks
from tweetflow.fixed import MARIO, PACED, TRANSFORMED
from tweetflow.operators import reconcile, totals, tweets
from tweetflow.session import settings, shared_dir
from tweetflow.sources import records as source
from tweetflow.streaming import feeds, named, running, state, topics


def publish(spark, path, *values, files=1):
    lines = [(json.dumps(v) if not isinstance(v, str) else v,) for v in values]
    spark.createDataFrame(lines, "value string").coalesce(files).write.mode("append").text(path)


def reconcile_stream(spark, path, writers):
    lines = topics.file_topic(spark, f"{path}/in")
    feeds.start_reconciliation(lines, writers, f"{path}/checkpoint", topics.DRAIN).awaitTermination()


def expected(records, *tweets_):
    return rows(totals.totals_from_deltas(totals.user_deltas(source.parse_tweets(records(*tweets_)))))


def test_totals_go_on_after_a_restart(spark, records):
    path = shared_dir(spark, "restart")
    first = [tweet(1, user="1", fav=1), tweet(2, user="2", mentions=["1", "3"])]
    second = [tweet(3, user="1", name="B", fav=2), tweet(4, user="3", mentions=["1"])]
    writers = [sinks.index_writer(f"{path}/index"), sinks.changelog_writer(f"{path}/log"), sinks.typed_writer(f"{path}/typed")]
    publish(spark, f"{path}/in", *first)
    reconcile_stream(spark, path, writers)
    assert rows(sinks.read_index(spark, f"{path}/index")) == expected(records, *first)
    publish(spark, f"{path}/in", *second)
    reconcile_stream(spark, path, writers)
    assert rows(sinks.read_index(spark, f"{path}/index")) == expected(records, *first, *second)
    # Only users that changed are emitted again: 1 and the new 3, not 2.
    log = sinks.read_changelog(spark, f"{path}/log")
    assert rows(log.where("batch_id = 1"), "key") == [("1",), ("3",)]
    typed = spark.read.parquet(f"{path}/typed")
    assert dict(typed.dtypes)["mentioned"] == "int"
    # A run without new input changes nothing.
    reconcile_stream(spark, path, writers)
    assert rows(sinks.read_index(spark, f"{path}/index")) == expected(records, *first, *second)


def test_a_mention_alone_emits_its_receiver_again(spark):
    path = shared_dir(spark, "mention")
    publish(spark, f"{path}/in", tweet(1, user="1"))
    reconcile_stream(spark, path, [sinks.changelog_writer(f"{path}/log")])
    publish(spark, f"{path}/in", tweet(2, user="2", mentions=["1", "4"]))
    reconcile_stream(spark, path, [sinks.changelog_writer(f"{path}/log")])
    last = sinks.read_changelog(spark, f"{path}/log").where("batch_id = 1")
    mentioned = {r["key"]: json.loads(r["value"])["mentioned"] for r in last.collect()}
    assert mentioned == {"1": 1, "2": 0}


def test_writing_a_batch_again_replaces_it(spark):
    path = shared_dir(spark, "again")
    frame = spark.createDataFrame([("1", 1, 0, 0, "A", 0)], "userID string, count long, fav long, hashtags long, name string, mentioned long")
    for writer, folder in ((sinks.index_writer(f"{path}/index"), "index"), (sinks.changelog_writer(f"{path}/log"), "log")):
        writer(frame, 3)
        writer(frame, 3)
        assert spark.read.parquet(f"{path}/{folder}").count() == 1


def test_bad_records_do_not_stop_a_stream(spark, records):
    path = shared_dir(spark, "bad")
    publish(spark, f"{path}/in", "{not json", tweet(1), '{"id": 2}')
    reconcile_stream(spark, path, [sinks.index_writer(f"{path}/index")])
    assert rows(sinks.read_index(spark, f"{path}/index")) == expected(records, tweet(1))


def test_replay_takes_one_file_per_trigger(spark):
    path = shared_dir(spark, "paced")
    for i in range(3):
        publish(spark, f"{path}/in", tweet(i))
    lines = topics.file_topic(spark, f"{path}/in", files_per_trigger=1)
    batches = []
    query = lines.writeStream.foreachBatch(lambda b, i: batches.append(b.count())).trigger(**PACED).start()
    try:
        deadline = time.time() + 60
        while sum(batches) < 3 and time.time() < deadline:
            time.sleep(0.5)
    finally:
        query.stop()
    assert batches[:3] == [1, 1, 1]


def test_start_position(spark):
    path = shared_dir(spark, "start")
    publish(spark, f"{path}/in", tweet(1))
    time.sleep(1.1)
    now = datetime.now(timezone.utc)
    publish(spark, f"{path}/in", tweet(2))

    def read(starting):
        out = shared_dir(spark, "out")
        lines = topics.file_topic(spark, f"{path}/in", starting).select(F.get_json_object("value", "$.id_str").alias("id"))
        sinks.append_stream(lines, f"{out}/rows", f"{out}/checkpoint", topics.DRAIN).awaitTermination()
        return rows(spark.read.schema("id string").parquet(f"{out}/rows"))

    assert read("earliest") == [("1",), ("2",)]
    assert read(now) == [("2",)]


def test_latest_counts_from_the_first_start(spark):
    """A file that arrives between two runs is read, once."""
    path = shared_dir(spark, "latest")

    def run():
        lines = topics.file_topic(spark, f"{path}/in", "latest", started=f"{path}/started")
        ids = lines.select(F.get_json_object("value", "$.id_str").alias("id"))
        sinks.append_stream(ids, f"{path}/rows", f"{path}/checkpoint", topics.DRAIN).awaitTermination()
        return rows(spark.read.schema("id string").parquet(f"{path}/rows"))

    publish(spark, f"{path}/in", tweet(1))
    time.sleep(1.1)
    assert run() == []
    time.sleep(1.1)
    publish(spark, f"{path}/in", tweet(2))
    assert run() == [("2",)]
    publish(spark, f"{path}/in", tweet(3))
    assert run() == [("2",), ("3",)]
    with pytest.raises(ValueError):
        topics.file_topic(spark, f"{path}/in", "latest")


def test_kafka_branch_needs_its_package(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        topics.kafka_topic(spark, "localhost:9092", "tweets")


def test_fan_out_on_one_topic(spark):
    path = shared_dir(spark, "fanout")
    publish(spark, f"{path}/in", tweet(1, text="Mario"), tweet(2, lang="en", text="mario"))
    lines = topics.file_topic(spark, f"{path}/in")
    feeds.start_transformed(lines, f"{path}/t", f"{path}/ct", topics.DRAIN).awaitTermination()
    feeds.start_keyword_feed(lines, f"{path}/m", f"{path}/cm", topics.DRAIN).awaitTermination()
    transformed = spark.read.parquet(f"{path}/t")
    assert rows(transformed, "key") == [("1",), ("1",)]
    feed = spark.read.parquet(f"{path}/m").collect()
    assert [(r["key"], json.loads(r["value"])["id"]) for r in feed] == [(None, "1")]


def run_topology(spark, path):
    query = feeds.start_topology(topics.file_topic(spark, f"{path}/in"), path, f"{path}/c", topics.DRAIN)
    query.awaitTermination()
    writers = [sinks.index_writer(f"{path}/index"), sinks.typed_writer(f"{path}/typed")]
    feeds.start_totals(spark, path, writers, f"{path}/ct", topics.DRAIN, 2).awaitTermination()
    return query


def test_one_read_feeds_all_outputs(spark, records):
    path = shared_dir(spark, "topology")
    waves = [
        [tweet(5, user="1", name="B", text="Mario", mentions=["2", "9"], fav=3), "{no json", tweet(2, user="2", lang="en", text="mario")],
        [tweet(1, user="1", name="A", text="x"), '{"id": 7, "lang": "fr"}', tweet(6, user="3", text="MARIO", timestamp_ms="soon", mentions=["1"])],
    ]
    for wave in waves:
        publish(spark, f"{path}/in", *wave)
        query = run_topology(spark, path)
    raw = records(*waves[0], *waves[1])
    tweets_ = source.parse_tweets(raw, tweets.MARIO_FIELDS)
    out = {name: feeds.read_output(spark, path, name) for name in ("transformed", "mario", "rejected")}
    assert rows(out["transformed"]) == rows(tweets.keyed_json(tweets.tweet_transformed(tweets_), "userID", TRANSFORMED))
    assert rows(out["mario"]) == rows(tweets.keyed_json(tweets.keyword_feed(tweets_), None, MARIO))
    assert rows(out["rejected"]) == rows(source.rejected_tweets(raw))
    assert rows(sinks.read_index(spark, f"{path}/index")) == expected(records, *waves[0], *waves[1])
    plan = query._jsq.explainInternal(True)
    assert plan.split("== Physical Plan ==")[1].count("FileScan") == 1


def test_a_topology_keeps_only_what_its_outputs_print(spark, records):
    """Neither the record as it came nor the text of a tweet that no output prints is kept of a micro-batch."""
    long = "x" * 10_000
    media = [{"id_str": "1", "media_url": "u"}]
    raw = records(tweet(1, text=long, media=media), tweet(2, text="Mario", media=media), tweet(3, lang="en", text="Mario"), "{no json" + long)
    judged = source.judged_tweets(raw, tweets.MARIO_FIELDS)
    kept = feeds.only_needed(judged)
    assert rows(kept, "id", "text", "value") == [(1, None, None), (2, "Mario", None), (3, None, None), (None, None, "{no json" + long)]
    accepted = [frame.where("reason IS NULL") for frame in (judged, kept)]
    for output in (tweets.tweet_transformed, tweets.keyword_feed, running.batch_sums):
        assert rows(output(accepted[1])) == rows(output(accepted[0]))


def test_sums_that_arrive_again_count_once(spark, records):
    """A micro-batch written a second time, as after a crash before its commit, in files of other names."""
    path = shared_dir(spark, "again")
    first, second = [tweet(1, user="1", fav=2, mentions=["2"])], [tweet(2, user="2", fav=1), tweet(3, user="1", fav=5)]
    publish(spark, f"{path}/in", *first)
    run_topology(spark, path)
    sums = running.batch_sums(source.parse_tweets(records(*first))).withColumn("batch_id", F.lit(0).cast("long"))
    sums.write.mode("overwrite").parquet(f"{path}/sums/{0:09}")
    publish(spark, f"{path}/in", *second)
    run_topology(spark, path)
    assert rows(sinks.read_index(spark, f"{path}/index")) == expected(records, *first, *second)


def test_console_writer_prints_every_row(spark, tmp_path):
    path = shared_dir(spark, "console")
    lines = str(tmp_path / "lines")

    def line(text):
        with open(lines, "a") as out:
            out.write(text + "\n")

    publish(spark, f"{path}/in", tweet(1, user="4711"))
    more = [tweet(i, user=str(5000 + i)) for i in range(2, 40)]
    publish(spark, f"{path}/in", *more)
    reconcile_stream(spark, path, [sinks.console_writer(line)])
    printed = open(lines).read()
    assert all(f"'{user}'" in printed for user in [4711, *range(5002, 5040)])


def bid(id, ts, cp, seq=0):
    return {"timestamp": ts, "id": id, "clickProbability": cp, "seq_a": seq, "seq_b": 0, "seq_c": 0}


def win(id, ts, price):
    return {"timestamp": ts, "auctid": id, "winPrice": price}


def live(spark, path):
    to = named.Statements(spark, path, 2)
    name = f"reco_{path.rsplit('-', 1)[1]}"
    bids = source.parse_bids(topics.file_topic(to.session, f"{path}/bids"), sequenced=True)
    wins = source.parse_wins(topics.file_topic(to.session, f"{path}/wins"))
    to.create_stream_as(name, running.live_reco(wins, bids), topics.DRAIN).awaitTermination()
    return rows(to.rows(name)), rows(state.last_bids(spark, to.checkpoint(name)))


def test_live_reco_sees_the_bids_that_have_arrived(spark):
    """After restarts too, whatever the number of partitions the session asks for by then."""
    path = shared_dir(spark, "live")
    publish(spark, f"{path}/bids", bid("a", 10, 0.1), bid("b", 10, 0.2), bid("b", 10, 0.3, seq=1), bid("n", 10, 0.4), bid("n", 11, None))
    publish(spark, f"{path}/wins", win("a", 5, 1.0), win("b", 10, 2.0), win("c", 50, 3.0), win("n", 12, 4.0), win(None, 12, 9.0))
    first = [("a", 1.0, None), ("b", 2.0, 0.3), ("c", 3.0, None), ("n", 4.0, None)]
    known = [("a", 0.1), ("b", 0.3), ("n", None)]
    assert live(spark, path) == (first, known)
    # A later bid changes no earlier answer; a later win sees it even when its time is earlier.
    publish(spark, f"{path}/bids", bid("c", 40, 0.7))
    publish(spark, f"{path}/wins", win("a", 30, 5.0), win("a", 6, 6.0), win("b", 9, 7.0), win("n", 20, 8.0), win("c", 41, 10.0))
    more = [("a", 5.0, 0.1), ("a", 6.0, 0.1), ("b", 7.0, 0.3), ("n", 8.0, None), ("c", 10.0, 0.7)]
    known = sorted([*known, ("c", 0.7)], key=repr)
    with settings(spark, {"spark.sql.shuffle.partitions": "7"}):
        assert live(spark, path) == (sorted(first + more, key=repr), known)
    for price in (11.0, 12.0):
        publish(spark, f"{path}/wins", win("n", 1, price), win("b", 1, price))
        more += [("n", price, None), ("b", price, 0.3)]
        assert live(spark, path) == (sorted(first + more, key=repr), known)


def test_live_reco_of_a_busy_auction_equals_the_batch_form(spark):
    path = shared_dir(spark, "busy")
    bids = [bid(("hot", "cold")[i % 4 == 0], i, i / 100, i) for i in range(60)]
    wins = [win(("hot", "cold")[i % 5 == 0], i % 61, float(i % 7)) for i in range(200)]
    for low, high in ((0, 20), (20, 45), (45, 99)):
        publish(spark, f"{path}/bids", *[b for b in bids if low <= b["timestamp"] < high])
        publish(spark, f"{path}/wins", *[w for w in wins if low <= w["timestamp"] < high])
        got, _ = live(spark, path)
    lines = [spark.read.text(f"{path}/{side}").selectExpr("CAST(NULL AS string) AS key", "value") for side in ("wins", "bids")]
    assert got == rows(reconcile.reco_asof(source.parse_wins(lines[0]), source.parse_bids(lines[1], sequenced=True)))


def test_auctions_share_calls_and_state(spark, monkeypatch):
    """Many auctions, few states; null is told from no number, in answers, prices and state, also after a restart."""
    monkeypatch.setattr(running, "SLOTS", 3)
    path = shared_dir(spark, "slots")
    ids = [f"a{i}" for i in range(50)]
    given = {id: [0.5, None, "NaN"][i % 3] for i, id in enumerate(ids)}
    publish(spark, f"{path}/bids", *[bid(id, 10, given[id]) for id in ids], bid("other", 1, 0.1))
    publish(spark, f"{path}/wins", *[win(id, 11, 1.0) for id in ids], win("a0", 9, "NaN"), win("a0", 12, None))
    first, known = live(spark, path)
    as_read = {id: float("nan") if cP == "NaN" else cP for id, cP in given.items()}
    answers = [(id, 1.0, as_read[id]) for id in ids] + [("a0", float("nan"), None), ("a0", None, 0.5)]
    assert repr(first) == repr(sorted(answers, key=repr))
    assert repr(known) == repr(sorted([*as_read.items(), ("other", 0.1)], key=repr))
    publish(spark, f"{path}/bids", bid("new", 20, 0.7))
    publish(spark, f"{path}/wins", *[win(id, 5, 2.0) for id in ids])
    second, _ = live(spark, path)
    assert repr(second) == repr(sorted(answers + [(id, 2.0, as_read[id]) for id in ids], key=repr))
    checkpoint = named.Statements(spark, path).checkpoint(f"reco_{path.rsplit('-', 1)[1]}")
    assert state.state_of(spark, checkpoint, variable="last").count() <= 3


def test_stream_joined_with_a_finished_table(spark):
    path = shared_dir(spark, "static")
    publish(spark, f"{path}/in", win("a", 5, 1.0), win("z", 5, 2.0))
    table = spark.createDataFrame([("a", 0.1)], "id string, cP double")
    out = reconcile.reco(source.parse_wins(topics.file_topic(spark, f"{path}/in")), table)
    sinks.append_stream(out, f"{path}/out", f"{path}/checkpoint", topics.DRAIN).awaitTermination()
    assert rows(spark.read.parquet(f"{path}/out")) == [("a", 1.0, 0.1), ("z", 2.0, None)]


def test_topic_as_a_table_in_a_stream(spark):
    path = shared_dir(spark, "table")
    publish(spark, f"{path}/in", bid("a", 1, 0.1), bid("a", 2, 0.2), bid("b", 1, 0.3))
    seen = []
    table = reconcile.bid_table(source.parse_bids(topics.file_topic(spark, f"{path}/in"), sequenced=True))
    query = table.writeStream.outputMode("update").foreachBatch(lambda b, i: seen.extend(rows(b))).trigger(availableNow=True).start()
    query.awaitTermination()
    assert seen == [("a", 0.2), ("b", 0.3)]
