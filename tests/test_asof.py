"""Auctions that hold a third of all rows or more: same rows as brute force, and no window that gets them all."""

import random

import pytest
from conftest import rows

from tweetflow.operators import reconcile

BID = "timestamp bigint, id string, clickProbability double, seq_a bigint, seq_b bigint, seq_c bigint"
WIN = "timestamp bigint, auctid string, winPrice double"


def brute_force(wins, bids):
    out = []
    for ts, auction, price in wins:
        seen = [b for b in bids if b[1] == auction and b[0] <= ts]
        out.append((auction, price, max(seen, key=lambda b: (b[0], b[3]))[2] if seen else None))
    return sorted(out, key=repr)


def skewed(seed, n=1500):
    """Two hot auctions over many slices, one hot instant, copies, NULL probabilities and cold auctions."""
    pick = random.Random(seed)
    auction = lambda: pick.choice(["hot"] * 4 + ["hot2"] * 2 + [f"a{pick.randrange(n)}"] * 3)
    when = lambda: pick.choice([500, pick.randrange(2000)])
    bids = [(when(), auction(), pick.choice([None, pick.random()]), i, 0, 0) for i in range(n)]
    wins = [(when(), auction(), float(pick.randrange(5))) for _ in range(n)] + [(500, "hot", 1.0)] * (n // 3)
    return wins, bids


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("slice_ms", [7, 100, reconcile.SLICE_MS])
def test_asof_with_hot_auctions(spark, seed, slice_ms):
    wins, bids = skewed(seed)
    w, b = spark.createDataFrame(wins, WIN), spark.createDataFrame(bids, BID)
    assert rows(reconcile.reco_asof(w, b, slice_ms=slice_ms)) == brute_force(wins, bids)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_no_window_over_all_events_of_an_auction(spark):
    """Windows are over instants of a slice, and over slices of an auction."""
    wins, bids = skewed(4)
    got = reconcile.reco_asof(spark.createDataFrame(wins, WIN), spark.createDataFrame(bids, BID), slice_ms=100)
    text = plan(got)
    windows = [line for line in text.splitlines() if " Window [" in line]
    assert len(windows) == 2 and all("slice#" in line for line in windows)
    got.collect()
    assert "ReusedExchange" in plan(got)


def test_the_plan_is_made_without_a_job(spark):
    """Nothing about the data decides what the plan is."""
    wins, bids = skewed(3)
    w, b = spark.createDataFrame(wins, WIN), spark.createDataFrame(bids, BID)
    spark.sparkContext.setJobGroup("building", "")
    reconcile.reco_asof(w, b)
    reconcile.reco(w, reconcile.bid_table(b))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext.setJobGroup("", "")


def test_events_without_a_time_are_older_than_all(spark):
    wins, bids = [(None, "hot", 1.0)] * 50 + [(5, "hot", 2.0)] * 50, [(None, "hot", 0.5, 1, 0, 0), (4, "hot", 0.7, 2, 0, 0)]
    w, b = spark.createDataFrame(wins, WIN), spark.createDataFrame(bids, BID)
    assert rows(reconcile.reco_asof(w, b)) == [("hot", 1.0, 0.5)] * 50 + [("hot", 2.0, 0.7)] * 50


def test_every_win_meets_the_last_bid(spark):
    wins, bids = skewed(3)
    table = reconcile.bid_table(spark.createDataFrame(bids, BID))
    got = reconcile.reco(spark.createDataFrame(wins, WIN), table)
    last = {}
    for bid in sorted(bids, key=lambda b: (b[0], b[3])):
        last[bid[1]] = bid[2]
    assert rows(got) == sorted(((a, p, last.get(a)) for _, a, p in wins), key=repr)
