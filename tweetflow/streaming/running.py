"""Running tables that need state of their own: top-k lists, the last bid of an auction, updates held back for an interval."""

from __future__ import annotations

import heapq
import time
from bisect import bisect_right
from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tweetflow.fixed import TOTALS
from tweetflow.operators.reconcile import tagged_events
from tweetflow.operators.totals import user_deltas
from tweetflow.schemas import BID_ORDER


class _Best(StatefulProcessor):
    """The k greatest values of a key, equal ones kept."""

    def __init__(self, k: int, kind: T.DataType, columns: list[str]):
        self.k, self.columns = k, columns
        self.schema = T.StructType([T.StructField("best", T.ArrayType(kind))])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getValueState("best", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last = self.best.get()
        known = list(last[0]) if last else None
        best = known or []
        for frame in rows:
            best = heapq.nlargest(self.k, [*best, *(v for values in frame["v"] for v in values)])
        if best != known:
            self.best.update((best,))
            yield pd.DataFrame(dict(zip(self.columns, ([key[0]], [best]))))

    def close(self) -> None:
        pass


def running_top_k(rows: DataFrame, key: str, value: str, k: int, name: str) -> DataFrame:
    """The k greatest values per key of a stream as a descending array, again whenever it changes.

    Equal values are all kept, NULLs are not: a key of NULLs alone has an empty array. State is one array of k values per
    key. Tasks cut what they read to k values per key and block of rows before it is shuffled, so a key with a third of all
    rows costs each block one row.
    """
    kind = rows.schema[value].dataType

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                lists = frame.groupby("userid", sort=False)["v"].agg(lambda v: heapq.nlargest(k, v.dropna().tolist()))
                yield pd.DataFrame({"userid": lists.index.to_numpy(), "v": lists.to_numpy()})

    narrow = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("userid"), F.col(value).alias("v"))
    few = narrow.mapInPandas(cut, T.StructType([narrow.schema["userid"], T.StructField("v", T.ArrayType(kind))]))
    out = T.StructType([narrow.schema["userid"], T.StructField(name, T.ArrayType(kind))])
    return few.groupBy("userid").transformWithStateInPandas(_Best(k, kind, ["userid", name]), out, "update", "none")


# Auctions share so many states by a hash of their id: one call, one read and one write of state serve those of a slot.
SLOTS = 1 << 14
_EVENT = ["id", *BID_ORDER, "side", "winPrice", "priced", "cP", "given"]


class _LastBids(StatefulProcessor):
    """Answers the wins of a slot's auctions; keeps the probability of each one's last bid."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "ids array<string>, cPs array<double>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        bids: dict[str, dict[int, tuple]] = {}
        wins: list[tuple] = []
        for frame in rows:
            for auction, at, a, b, c, side, price, priced, cP, given in zip(*(frame[name].tolist() for name in _EVENT)):
                if side:
                    wins.append((auction, at, price, priced))
                    continue
                order, instants = (at, a, b, c), bids.setdefault(auction, {})
                if at not in instants or order >= instants[at][0]:
                    instants[at] = order, cP if given else None
        if not bids and not wins:
            return
        last = self.last.get()
        known = dict(zip(*last)) if last else {}
        if wins:
            times = {auction: sorted(bids.get(auction, ())) for auction, *_ in wins}
            answers = []
            for auction, at, _, _ in wins:
                earlier = bisect_right(times[auction], at)
                answers.append(bids[auction][times[auction][earlier - 1]][1] if earlier else known.get(auction))
            ids, _, prices, priced = zip(*wins)
            # A frame has one mark for null and for no number; flags beside the values tell them apart.
            yield pd.DataFrame({
                "auctid": ids, "winPrice": pd.Series(prices, dtype=float), "priced": pd.Series(priced, dtype=bool),
                "cP": pd.Series(answers, dtype=float), "given": [answer is not None for answer in answers],
            })
        if bids:
            known.update((auction, instants[max(instants)][1]) for auction, instants in bids.items())
            self.last.update((list(known), list(known.values())))

    def close(self) -> None:
        pass


def live_reco(wins: DataFrame, bids: DataFrame) -> DataFrame:
    """Every win of a stream with the bid that is current when the win is processed; a later bid changes nothing.

    Within a micro-batch bids and wins of an auction take effect by time, bids of an instant before its wins; what a micro-batch
    brings is later than all before it. State is the last probability of each auction, kept for ever, by slots of
    auctions: a micro-batch reads the slots it has events of and writes those it has bids of. A task holds of one slot the
    wins of the micro-batch and one bid per auction and instant at a time; the size of micro-batches is bounded where the
    topic is read.
    """
    events = tagged_events(wins, bids)
    # A missing sequence number is older than all others, and orders are compared as they are, without nulls.
    events = events.withColumns({c: F.coalesce(c, F.lit(-(2**63))) for c in BID_ORDER[1:]})
    events = events.withColumns({
        "slot": F.pmod(F.xxhash64("id"), F.lit(SLOTS)), "priced": F.col("winPrice").isNotNull(), "given": F.col("cP").isNotNull(),
    })
    out = "auctid string, winPrice double, priced boolean, cP double, given boolean"
    answered = events.select("slot", *_EVENT).groupBy("slot").transformWithStateInPandas(_LastBids(), out, "append", "none")

    def told(value: str, flag: str) -> Column:
        return F.when(F.col(flag), F.coalesce(value, F.lit(float("nan")))).alias(value)

    return answered.select("auctid", told("winPrice", "priced"), told("cP", "given"))


SUMS = ["count", "fav", "hashtags", "mentioned"]
# The tweet id of a user who has not written yet.
_NEVER = 2**63 - 1


class _Totals(StatefulProcessor):
    """Running totals of a user from one row per micro-batch; a row of a micro-batch that was counted is passed over."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState("totals", ", ".join(f"{c} long" for c in SUMS) + ", ord long, name string, batch_id long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        *sums, first, name, counted = self.totals.get() or (0, 0, 0, 0, _NEVER, None, -1)
        new = sorted((row for row in rows if row.batch_id > counted), key=lambda row: row.batch_id)
        for row in new:
            if row.batch_id > counted:
                sums, counted = [total + row[c] for total, c in zip(sums, SUMS)], row.batch_id
                if row.ord < first:
                    first, name = row.ord, row["name"]
        if new:
            self.totals.update((*sums, first, name, counted))
            if sums[0]:
                yield Row(userID=key[0], count=sums[0], fav=sums[1], hashtags=sums[2], name=name, mentioned=sums[3])

    def close(self) -> None:
        pass


def batch_sums(tweets: DataFrame) -> DataFrame:
    """What tweets add to each user: sums, and the least tweet id with its name."""
    sums = [F.sum(c).alias(c) for c in SUMS]
    users = user_deltas(tweets).groupBy("userID").agg(*sums, F.min("first").alias("first"))
    return users.select("userID", *SUMS, F.coalesce("first.ord", F.lit(_NEVER)).alias("ord"), F.col("first.name").alias("name"))


def totals_of_batches(sums: DataFrame) -> DataFrame:
    """Running totals from a stream of ``batch_sums`` with the micro-batch of each, every changed user once.

    A micro-batch whose sums arrive again, as it was written twice, counts once.
    """
    out = ", ".join(f"{c} {'string' if c in ('userID', 'name') else 'long'}" for c in TOTALS)
    return sums.groupBy("userID").transformWithState(_Totals(), out, "update", "none")


class _HeldBack(StatefulProcessor):
    """Running totals of a user; a changed user is due at the end of the interval in which it first changed."""

    def __init__(self, interval_ms: int):
        self.interval_ms = interval_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", ", ".join(f"{c} long" for c in SUMS) + ", ord long, name string, due long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        *sums, first, name, due = self.totals.get() or (0, 0, 0, 0, _NEVER, None, None)
        for row in rows:
            sums = [total + row[c] for total, c in zip(sums, SUMS)]
            if row.ord < first:
                first, name = row.ord, row["name"]
        if due is None:
            due = (timerValues.getCurrentProcessingTimeInMs() // self.interval_ms + 1) * self.interval_ms
            self.handle.registerTimer(due)
        self.totals.update((*sums, first, name, due))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        *sums, first, name, due = self.totals.get()
        self.totals.update((*sums, first, name, None))
        if sums[0]:
            yield Row(userID=key[0], count=sums[0], fav=sums[1], hashtags=sums[2], name=name, mentioned=sums[3], until=due)

    def close(self) -> None:
        pass


def compacted_totals(tweets: DataFrame, interval_ms: int) -> DataFrame:
    """The changelog of the user totals of a stream of tweets, at most one row per user and interval of processing time.

    A user that changed is held back until the interval ends (``until``, epoch millis) and comes once then, with the totals
    of that time, by a timer of its state; nothing that keeps changing keeps it back longer. Needs a trigger that goes on
    without new data. Users who are mentioned only are not emitted. Deltas are summed per user and block of rows before the shuffle.
    """
    ord_, name = F.coalesce("first.ord", F.lit(_NEVER)).alias("ord"), F.col("first.name").alias("name")
    deltas = user_deltas(tweets).select("userID", *SUMS, ord_, name)
    columns = deltas.columns

    def summed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            # Of a user's names the one of the least tweet id; mentions carry none and come last.
            users = frame.sort_values("ord").groupby("userID", sort=False)
            if len(frame):
                yield users[SUMS].sum().join(users.head(1).set_index("userID")[["ord", "name"]]).reset_index()[columns]

    few = deltas.mapInPandas(summed, deltas.schema)
    out = ", ".join(f"{c} {'string' if c in ('userID', 'name') else 'long'}" for c in [*TOTALS, "until"])
    return few.groupBy("userID").transformWithState(_HeldBack(interval_ms), out, "update", "processingTime")


def await_quiet(query: StreamingQuery, interval_ms: int, seconds: float = 600) -> None:
    """Wait until a query that holds updates back for an interval has read all there is and handed all of it on.

    That is so once a micro-batch without new data begins a whole interval after the last one with new data ended: all
    timers are due by then.
    """
    def begun(progress) -> float:
        return datetime.fromisoformat(progress["timestamp"]).timestamp() * 1000

    until = time.monotonic() + seconds
    last = time.time() * 1000
    while time.monotonic() < until:
        if query.exception():
            raise query.exception()
        for progress in query.recentProgress:
            if progress["numInputRows"]:
                last = max(last, begun(progress) + progress["durationMs"]["triggerExecution"])
            elif begun(progress) > last + interval_ms:
                return
        time.sleep(0.2)
    raise TimeoutError(f"{query.name} still has updates to hand on after {seconds} seconds")
