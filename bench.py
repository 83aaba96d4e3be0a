"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the number of local threads. Batch queries
are run to a sink that drops the rows: one warm-up, then the median of BENCH_RUNS. Stream queries write
files as part of the query and are run once.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from tweetflow.plans.queries import queries
from tweetflow.session import local_session

BATCH = [
    "tweet_transformed", "user_table", "mentions_table", "reconciliation", "reconciliation_union", "mario_fr",
    "changelog_by_interval", "ksql_tweets_transformed", "userid_count", "userid_name_top3",
    "tbid_latest_by_key", "reco", "reco_valid", "reco_asof", "file_sink_roundtrip",
]
STREAMS = ["stream_reconciliation", "stream_fanout_counts", "stream_reco"]


def seconds(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    # Spark and its Python workers may print; only the result goes to standard output.
    result = os.dup(1)
    os.dup2(2, 1)
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus, runs = os.environ.get("BENCH_CPUS", "8"), int(os.environ.get("BENCH_RUNS", "3"))
    folder = tempfile.mkdtemp(prefix="run-")
    places = {"spark__checkpoint__dir": f"{folder}/shared", "spark__sql__warehouse__dir": f"{folder}/warehouse"}
    spark, registered = local_session(cpus, **places), queries()
    took = {}
    for name in BATCH:
        seconds(registered[name], spark, sf_dir)
        took[name] = round(statistics.median(seconds(registered[name], spark, sf_dir) for _ in range(runs)), 3)
    for name in STREAMS:
        took[name] = round(seconds(registered[name], spark, sf_dir), 3)
    spark.stop()
    line = {
        "metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    os.write(result, (json.dumps(line) + "\n").encode())


if __name__ == "__main__":
    main()
