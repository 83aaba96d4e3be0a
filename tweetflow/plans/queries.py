"""One query per operator, from the given tables to a result."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tweetflow import fixed, schemas, sinks
from tweetflow.functions import epoch_ms, epoch_ms_to_date, millis
from tweetflow.operators import changelog, reconcile, totals, tweets
from tweetflow.session import log_settings, settings, shared_dir
from tweetflow.sinks import export
from tweetflow.sources import records, tables
from tweetflow.streaming import feeds, named, replay, running, state, topics

Query = Callable[[SparkSession, str], DataFrame]

# Streams are fed in this many steps; each step is one run of the stream to its end.
WAVES = 2
LINES_PER_FILE = 100_000
# A replay without its pauses.
AT_ONCE = {"processingTime": "0 seconds"}
# So many files make a micro-batch at most.
FILES_PER_TRIGGER = 64
LOOKED_UP = "7"
# The interval of the compacted changelog: the SQL feed's.
COMPACT_MS = 2_000


def _tweets(spark: SparkSession, sf_dir: str, also: list[str] | None = None) -> DataFrame:
    return records.parse_tweets(tables.tweet_records(spark, sf_dir), also)


def _bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.parse_bids(tables.bid_records(spark, sf_dir), sequenced=True)


def _wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.parse_wins(tables.win_records(spark, sf_dir))


# Tweets


def tweet_transformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tweets.tweet_transformed(_tweets(spark, sf_dir))


def user_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tweets.user_mentions(_tweets(spark, sf_dir))


def user_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.user_table(tweets.tweet_transformed(_tweets(spark, sf_dir), ordered=True))


def mentions_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.mentions_table(user_mentions(spark, sf_dir))


def reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two tables joined, as the tables stand."""
    return totals.reconciliation(user_table(spark, sf_dir), mentions_table(spark, sf_dir))


def reconciliation_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same totals in one pass and one shuffle."""
    return totals.totals_from_deltas(totals.user_deltas(_tweets(spark, sf_dir)))


def mario_fr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tweets.keyword_feed(_tweets(spark, sf_dir, tweets.MARIO_FIELDS)).drop("key")


def avro_user_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tweets.user_records(reconciliation_union(spark, sf_dir))


def keyed_json_transformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tweets.keyed_json(tweet_transformed(spark, sf_dir), "userID", fixed.TRANSFORMED)


def keyed_json_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tweets.keyed_json(reconciliation_union(spark, sf_dir), "userID", fixed.TOTALS)


def keyed_json_mario(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = tweets.keyword_feed(_tweets(spark, sf_dir, tweets.MARIO_FIELDS))
    return tweets.keyed_json(feed, None, fixed.MARIO)


def keyed_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals written to a topic as keyed JSON and read back."""
    path = shared_dir(spark, "topic")
    sinks.write_topic(keyed_json_reconciliation(spark, sf_dir), path)
    return records.parse_user_totals(sinks.read_topic(spark, path))


def file_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed records exported to files of 100 rows and read back."""
    path = shared_dir(spark, "export")
    sinks.write_files(avro_user_records(spark, sf_dir), path)
    return spark.read.schema(schemas.USER_RECORD).parquet(path).select(*fixed.TOTALS)


def user_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One user's document, looked up in an index of all users."""
    path = shared_dir(spark, "index")
    sinks.index_writer(path)(reconciliation_union(spark, sf_dir), 0)
    return sinks.lookup_index(spark, path, LOOKED_UP)


def changelog_by_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = epoch_ms_to_date(millis(F.col("timestamp_ms")))
    return changelog.changelog_by_interval(_tweets(spark, sf_dir, ["timestamp_ms"]), day)


def changelog_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.changelog_to_table(changelog_by_interval(spark, sf_dir))


# The SQL feed


def ksql_tweets_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.parse_sql_tweets(tables.tweet_records(spark, sf_dir))


def ksql_tweets_transformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tweets.sql_tweets_transformed(ksql_tweets_raw(spark, sf_dir))


def ksql_mario_fr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tweets.sql_keyword_feed(ksql_tweets_transformed(spark, sf_dir))


def userid_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.count_by(ksql_tweets_transformed(spark, sf_dir), "user_id", "count")


def userid_fav(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.sum_by(ksql_tweets_transformed(spark, sf_dir), "user_id", "fav", "fav")


def _top_names(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    top = totals.top_k(ksql_tweets_transformed(spark, sf_dir), "user_id", "user_screen_name", k, "name")
    return top.withColumn("name", F.array_join("name", ","))


def userid_name_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top_names(spark, sf_dir, 1)


def userid_name_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top_names(spark, sf_dir, 3)


def ctas_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A named query stored as a table, then replaced by another under the same name."""
    path = shared_dir(spark, "table")
    run = path.rsplit("-", 1)[1]
    flattened = sinks.store_stream_as(ksql_tweets_transformed(spark, sf_dir), f"tweets_transformed_{run}", f"{path}/stream", "user_id")
    name = f"userid_totals_{run}"
    sinks.create_table_as(totals.sum_by(flattened, "user_id", "fav", "fav"), name, f"{path}/first")
    sinks.create_table_as(totals.count_by(flattened, "user_id", "count"), name, f"{path}/second")
    return spark.table(name)


# Bids and wins


def bid_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.parse_bids(tables.bid_records(spark, sf_dir))


def win_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wins(spark, sf_dir)


def bid_proper_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bids under their proper key, stored as a stream partitioned by it."""
    return _partitioned(reconcile.bid_proper_key(bid_raw(spark, sf_dir)), "bid_proper_key", "id")


def win_proper_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wins under their proper key, stored as a stream partitioned by it."""
    return _partitioned(reconcile.win_proper_key(_wins(spark, sf_dir)), "win_proper_key", "auctid")


def _partitioned(rows: DataFrame, name: str, key: str) -> DataFrame:
    path = shared_dir(rows.sparkSession, name)
    return sinks.store_stream_as(rows, path.rsplit("/", 1)[1].replace("-", "_"), path, key)


def tbid_latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.bid_table(_bids(spark, sf_dir))


def reco(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.reco(_wins(spark, sf_dir), tbid_latest_by_key(spark, sf_dir))


def reco_copartitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bids and wins stored under their proper keys in equal buckets, and joined bucket by bucket."""
    path = shared_dir(spark, "copartitioned")
    bids, wins = _bids(spark, sf_dir), reconcile.win_proper_key(_wins(spark, sf_dir))
    buckets = sinks.bucket_count(tables.table(spark, sf_dir, "lineitem"), tables.table(spark, sf_dir, "orders"))
    stored_bids = sinks.store_copartitioned(bids, _name(path, "bids"), f"{path}/bids", "id", buckets)
    stored_wins = sinks.store_copartitioned(wins, _name(path, "wins"), f"{path}/wins", "auctid", buckets)
    return reconcile.reco_copartitioned(stored_wins, stored_bids)


def reco_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.reco_valid(reco(spark, sf_dir))


def reco_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.reco_asof(_wins(spark, sf_dir), _bids(spark, sf_dir))


# Streams. The given tables are published to a topic folder in waves, and the stream is run to its end
# after each wave, so that it also resumes from its checkpoint.


def _waves(measured: DataFrame) -> Iterator[tuple[int | None, int | None]]:
    """Half-open ranges that cut a single-column frame into WAVES parts of about equal size; one without bounds if it has no value."""
    shares = F.array(*[F.lit(i / WAVES) for i in range(1, WAVES)])
    (cuts,) = measured.select(F.percentile_approx(measured.columns[0], shares)).first()
    bounds = [None, *(cuts or []), None]
    return zip(bounds[:-1], bounds[1:])


def _between(column: str, low, high) -> tables.Narrow:
    """From low, or from the beginning, to before high; without an end, rows that have no value are in it too."""

    def narrow(rows: DataFrame) -> DataFrame:
        if high is not None:
            rows = rows.where(F.col(column) < high)
            return rows if low is None else rows.where(F.col(column) >= low)
        return rows if low is None else rows.where((F.col(column) >= low) | F.col(column).isNull())

    return narrow


def _state_partitions(spark: SparkSession) -> int:
    """One state partition per core."""
    return spark.sparkContext.defaultParallelism


def _topic(spark: SparkSession, path: str) -> DataFrame:
    """A topic folder as a stream, in micro-batches of bounded size."""
    return topics.file_topic(spark, path, files_per_trigger=FILES_PER_TRIGGER)


def _tweet_waves(spark: SparkSession, sf_dir: str, path: str, lines: int = LINES_PER_FILE) -> Iterator[None]:
    for low, high in _waves(tables.table(spark, sf_dir, "events").select("event_id")):
        sinks.split_lines(tables.tweet_records(spark, sf_dir, _between("event_id", low, high)), path, lines, compression=sinks.PACKED)
        yield


def stream_replay_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tweets replayed from files of 100 lines, one file per trigger; one id per tweet read.

    Each partition of the topic has a stream of its own, which reads one of its files per trigger, oldest first.
    """
    path = shared_dir(spark, "replay")
    for _ in _tweet_waves(spark, sf_dir, f"{path}/in", fixed.ROWS_PER_FILE):
        # The logs of sources are opened after a start, so the options hold to the end of the wave.
        with settings(spark, log_settings(spark)):
            topics.drain_all(_start_ids(spark, path, partition) for partition in range(fixed.PARTITIONS))
    read = [spark.read.schema("id_str string").parquet(f"{path}/out/{partition}") for partition in range(fixed.PARTITIONS)]
    return reduce(DataFrame.unionAll, read)


def _start_ids(spark: SparkSession, path: str, partition: int) -> StreamingQuery:
    """The ids of one topic partition's tweets, one file per trigger."""
    lines = topics.file_topic(spark, f"{path}/in", files_per_trigger=1, names=topics.names_of_partition(partition))
    ids = lines.select(F.get_json_object("value", "$.id_str").alias("id_str"))
    return sinks.append_stream(ids, f"{path}/out/{partition}", f"{path}/checkpoint/{partition}", topics.DRAIN)


def stream_replay_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reconciliation of tweets that a replay sends twice: one pass, and after a restart from its checkpoint another.

    Nothing is deduplicated, so every total doubles; a consumer reads the topic after each pass. The files are dealt to one
    producer per partition of the topic, each of which sends one of its files per trigger.
    """
    path = shared_dir(spark, "replay-twice")
    sinks.split_lines(tables.tweet_records(spark, sf_dir), f"{path}/files", LINES_PER_FILE, compression=sinks.PACKED)
    # The topic is there before the first file is sent.
    sinks.split_lines(tables.tweet_records(spark, sf_dir).limit(0), f"{path}/topic/start/none")
    for passes in (1, 2):
        sent = replay.start_replays(
            spark, f"{path}/files", lambda partition: replay.topic_sender(f"{path}/topic/{partition}", sinks.PACKED),
            f"{path}/sent", fixed.PARTITIONS, passes, AT_ONCE,
        )
        try:
            for producer in sent:
                producer.processAllAvailable()
        finally:
            for producer in sent:
                producer.stop()
        feeds.start_reconciliation(
            _topic(spark, f"{path}/topic/*/*"), [sinks.changelog_writer(f"{path}/out")], f"{path}/checkpoint", topics.DRAIN,
            _state_partitions(spark),
        ).awaitTermination()
    log = sinks.read_changelog(spark, f"{path}/out")
    return records.parse_user_totals(totals.latest_by_key(log, ["key"], ["batch_id"]))


def stream_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reconciliation kept by a stream; its changelog of keyed JSON turned back into the table."""
    path = shared_dir(spark, "reconciliation")
    for _ in _tweet_waves(spark, sf_dir, f"{path}/in"):
        lines = _topic(spark, f"{path}/in")
        writers = [sinks.changelog_writer(f"{path}/out")]
        feeds.start_reconciliation(
            lines, writers, f"{path}/checkpoint", topics.DRAIN, _state_partitions(spark)
        ).awaitTermination()
    log = sinks.read_changelog(spark, f"{path}/out")
    return records.parse_user_totals(totals.latest_by_key(log, ["key"], ["batch_id"]))


def upsert_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reconciliation kept by a stream and upserted into an index; the index as it stands."""
    path = shared_dir(spark, "upsert")
    for _ in _tweet_waves(spark, sf_dir, f"{path}/in"):
        lines = _topic(spark, f"{path}/in")
        writers = [sinks.index_writer(f"{path}/index"), sinks.typed_writer(f"{path}/typed")]
        feeds.start_reconciliation(
            lines, writers, f"{path}/checkpoint", topics.DRAIN, _state_partitions(spark)
        ).awaitTermination()
    return sinks.read_index(spark, f"{path}/index")


def _fanned_out(spark: SparkSession, sf_dir: str, spoilt: bool = False) -> str:
    """One topic read once for all branches: transformed tweets, keyword feed, rejects, and totals indexed and as typed records."""
    path = shared_dir(spark, "fanout")
    for low, high in _waves(tables.table(spark, sf_dir, "events").select("event_id")):
        raw = tables.tweet_records(spark, sf_dir, _between("event_id", low, high))
        sinks.split_lines(_spoilt(raw) if spoilt else raw, f"{path}/in", LINES_PER_FILE, compression=sinks.PACKED)
        feeds.start_topology(_topic(spark, f"{path}/in"), path, f"{path}/checkpoint", topics.DRAIN).awaitTermination()
        writers = [sinks.index_writer(f"{path}/index"), sinks.typed_writer(f"{path}/typed")]
        feeds.start_totals(
            spark, path, writers, f"{path}/checkpoint-totals", topics.DRAIN, _state_partitions(spark)
        ).awaitTermination()
    return path


def stream_fanout_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the three branches that one topic feeds."""
    path = _fanned_out(spark, sf_dir)
    branches = {name: feeds.read_output(spark, path, name) for name in ("transformed", "mario")}
    branches["reconciliation"] = sinks.read_index(spark, f"{path}/index")
    counted = [rows.agg(F.lit(name).alias("branch"), F.count(F.lit(1)).alias("n")) for name, rows in branches.items()]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def stream_transformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the transformed branch wrote."""
    return feeds.read_output(spark, _fanned_out(spark, sf_dir), "transformed")


def stream_mario(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the keyword branch wrote."""
    return feeds.read_output(spark, _fanned_out(spark, sf_dir), "mario")


def stream_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last typed record the totals branch wrote of each user."""
    log = spark.read.schema(schemas.with_batch(schemas.USER_RECORD)).parquet(f"{_fanned_out(spark, sf_dir)}/typed")
    return totals.latest_by_key(log, ["userID"], ["batch_id"]).select(*fixed.TOTALS)


def stream_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records the running topology set aside, of a topic in which some are spoilt."""
    rejected = feeds.read_output(spark, _fanned_out(spark, sf_dir, spoilt=True), "rejected")
    return rejected.select(F.get_json_object("value", "$.id_str").alias("id_str"), "reason")


def _spoilt(raw: DataFrame) -> DataFrame:
    """Tweets of which one in 97 is made unreadable and one in 89 loses a needed field."""
    number = F.get_json_object("value", "$.id").cast("bigint")
    broken = F.when(number % 97 == 0, F.concat(F.lit("no JSON "), number)).when(
        number % 89 == 0, F.regexp_replace("value", '"favorite_count":[-0-9]+,', "")
    )
    return raw.withColumn("value", F.coalesce(broken, "value"))


def rejected_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tweets set aside after one in 97 was made unreadable and one in 89 lost a needed field."""
    rejected = records.rejected_tweets(_spoilt(tables.tweet_records(spark, sf_dir)))
    return rejected.select(F.get_json_object("value", "$.id_str").alias("id_str"), "reason")


def _live_reco(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Folder and name of a live reconciliation, bids and wins arriving in the order of their time."""
    path = shared_dir(spark, "reco")

    def instant(ms: int | None):
        if ms is None:
            return None
        return F.expr(f"timestamp_ntz'{datetime.fromtimestamp(ms / 1000, timezone.utc):%Y-%m-%d %H:%M:%S.%f}'")

    for low, high in _waves(tables.table(spark, sf_dir, "orders").select(epoch_ms("o_orderdate").alias("ms"))):
        for name, make, column in (("bids", tables.bid_records, "l_shipdate"), ("wins", tables.win_records, "o_orderdate")):
            wave = make(spark, sf_dir, _between(column, instant(low), instant(high)))
            sinks.split_lines(wave, f"{path}/{name}", LINES_PER_FILE, compression=sinks.PACKED)
        statements = named.Statements(spark, path, _state_partitions(spark))
        # A wave is one micro-batch: cut at files, bids and wins of one time would arrive at different ones.
        bids = records.parse_bids(topics.file_topic(statements.session, f"{path}/bids"), sequenced=True)
        wins = records.parse_wins(topics.file_topic(statements.session, f"{path}/wins"))
        statements.create_stream_as(_name(path, "reco"), running.live_reco(wins, bids), topics.DRAIN).awaitTermination()
    return path, _name(path, "reco")


def stream_reco(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wins answered live, by a stream that keeps each auction's last bid in its state."""
    path, name = _live_reco(spark, sf_dir)
    return named.Statements(spark, path).rows(name)


def _name(path: str, name: str) -> str:
    """A name that no other run has."""
    return f"{name}_{path.rsplit('-', 1)[1]}"


def _named(spark: SparkSession, sf_dir: str, name: str, define) -> tuple[named.Statements, str]:
    """The SQL feed as named streams: tweets flattened under one name, and from that name what ``define`` makes of it.

    Both queries are ended after each wave and go on from their checkpoints in the next.
    """
    path = shared_dir(spark, "named")
    flat, derived = _name(path, "tweets_transformed"), _name(path, name)
    for _ in _tweet_waves(spark, sf_dir, f"{path}/in"):
        statements = named.Statements(spark, path, _state_partitions(spark))
        raw = records.parse_sql_tweets(_topic(statements.session, f"{path}/in"))
        statements.create_stream_as(flat, tweets.sql_tweets_transformed(raw), topics.DRAIN).awaitTermination()
        define(statements, derived, statements.stream(flat)).awaitTermination()
    return statements, derived


def stream_ksql_mario_fr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SQL keyword feed as a named stream over the named stream of flattened tweets."""
    statements, name = _named(spark, sf_dir, "mario_fr", lambda to, name, flat: to.create_stream_as(name, tweets.sql_keyword_feed(flat), topics.DRAIN))
    return statements.rows(name)


def _named_table(spark: SparkSession, sf_dir: str, name: str, of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    statements, name = _named(spark, sf_dir, name, lambda to, name, flat: to.create_table_as(name, of(flat), topics.DRAIN))
    return statements.table(name, "userid")


def stream_userid_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tweets per user as a running table over a named stream."""
    return _named_table(spark, sf_dir, "userid_count", lambda flat: totals.count_by(flat, "user_id", "count"))


def stream_userid_fav(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Favourites per user as a running table over a named stream."""
    return _named_table(spark, sf_dir, "userid_fav", lambda flat: totals.sum_by(flat, "user_id", "fav", "fav"))


def _running_top(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    top = _named_table(spark, sf_dir, f"userid_name_top{k}", lambda flat: running.running_top_k(flat, "user_id", "user_screen_name", k, "name"))
    return top.withColumn("name", F.array_join("name", ","))


def stream_userid_name_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The greatest screen name per user as a running table."""
    return _running_top(spark, sf_dir, 1)


def stream_userid_name_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three greatest screen names per user, repeats kept, as a running table."""
    return _running_top(spark, sf_dir, 3)


def stream_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transformed tweets exported to files of 100 rows that fill up over micro-batches; all rows read back."""
    path = shared_dir(spark, "export")
    for _ in _tweet_waves(spark, sf_dir, f"{path}/in"):
        rows = tweets.tweet_transformed(records.parse_tweets(_topic(spark, f"{path}/in")))
        sinks.batch_stream(rows, [export.rolling_writer(f"{path}/out")], f"{path}/checkpoint", topics.DRAIN).awaitTermination()
    schema = rows.schema
    filled, waiting = export.read_files(spark, f"{path}/out", schema), export.read_waiting(spark, f"{path}/out", schema)
    return filled.select(*schema.names).unionByName(waiting.select(*schema.names))


def stream_state_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reconciliation read from the state of its stream after a restart."""
    path = shared_dir(spark, "state")
    for _ in _tweet_waves(spark, sf_dir, f"{path}/in"):
        lines = _topic(spark, f"{path}/in")
        feeds.start_reconciliation(
            lines, [sinks.changelog_writer(f"{path}/out")], f"{path}/checkpoint", topics.DRAIN, _state_partitions(spark)
        ).awaitTermination()
    return state.user_totals(spark, f"{path}/checkpoint")


def stream_state_bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of last bids read from the state of the live reconciliation."""
    path, name = _live_reco(spark, sf_dir)
    return state.last_bids(spark, named.Statements(spark, path).checkpoint(name))


def stream_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reconciliation from a changelog that has each changed user once per interval of two seconds."""
    path = shared_dir(spark, "compacted")
    name = _name(path, "compacted")
    for _ in _tweet_waves(spark, sf_dir, f"{path}/in"):
        statements = named.Statements(spark, path, _state_partitions(spark))
        read = records.parse_tweets(_topic(statements.session, f"{path}/in"))
        query = statements.create_table_as(name, running.compacted_totals(read, COMPACT_MS), {"processingTime": "1 second"})
        try:
            running.await_quiet(query, COMPACT_MS)
        finally:
            query.stop()
    return statements.table(name, "userID").select(*fixed.TOTALS)


ALL: list[Query] = [
    tweet_transformed, user_mentions, user_table, mentions_table, reconciliation, reconciliation_union, mario_fr,
    avro_user_records, keyed_json_transformed, keyed_json_reconciliation, keyed_json_mario, keyed_json_roundtrip,
    file_sink_roundtrip, user_lookup, changelog_by_interval, changelog_to_table,
    ksql_tweets_raw, ksql_tweets_transformed, ksql_mario_fr, userid_count, userid_fav, userid_name_top1,
    userid_name_top3, ctas_overwrite,
    bid_raw, win_raw, bid_proper_key, win_proper_key, tbid_latest_by_key, reco, reco_copartitioned, reco_valid, reco_asof,
    stream_replay_rows, stream_replay_twice, stream_reconciliation, upsert_snapshot, stream_fanout_counts, stream_reco,
    stream_transformed, stream_mario, stream_typed, rejected_by_reason,
    stream_ksql_mario_fr, stream_userid_count, stream_userid_fav, stream_userid_name_top1, stream_userid_name_top3,
    stream_state_totals, stream_state_bids, stream_compacted, stream_export, stream_rejected,
]


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in ALL}
