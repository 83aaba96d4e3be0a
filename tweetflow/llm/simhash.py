"""SimHash near-duplicates by a self-join of a binary trie of fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tweetflow.llm.common import beside, cut, row_digest
from tweetflow.llm.components import connected

SEED = 42
# Words hashed at once, node pairs held at once, and leaf pairs compared at once: they bound memory, not results.
BLOCK, PAIRS, LEAF = 1 << 16, 1 << 15, 32
# Subtrees are split until none holds more fingerprints, at least and at most to these depths.
SUBTREE, LEAST_DEPTH, DEEPEST = 1 << 15, 4, 16


def simhash(text: bytes | None, shingle: int) -> int:
    """64 bits, each set if it is set in over half of the hashes of all shingles of the lower-cased words."""
    found = (text or b"").lower().split()
    if not found:
        return 0
    if len(found) < shingle:
        found = [b" ".join(found)]
    else:
        found = list(map(b" ".join, zip(*(found[i:] for i in range(shingle)))))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(found), BLOCK):
        part = found[at : at + BLOCK]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, part, repeat(SEED)), np.uint64, len(part))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > len(found), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, carry: list[str], shingle: int = 3) -> DataFrame:
    """(_kept: a struct of the carried columns, doc_id, fp: the fingerprint as a long). Null or wordless text: zero."""

    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([simhash(text, shingle) for text in batch], dtype="int64")

    # Bytes, whose lower() and split() know ASCII only.
    udf = F.pandas_udf(of, "long")
    return docs.select(F.struct(*carry).alias("_kept"), "doc_id", udf(F.col("text").cast("binary")).alias("fp"))


class Trie:
    """A binary trie over sorted fingerprints; a node of a level is the run of fingerprints that share its prefix."""

    def __init__(self, sorted_fps: np.ndarray):
        self.fps, self.levels = sorted_fps, {}

    def level(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """First fingerprint and number of fingerprints of each node."""
        if depth not in self.levels:
            prefix = self.fps >> np.uint64(64 - depth) if depth else np.zeros(len(self.fps), np.uint64)
            first = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]])
            self.levels[depth] = first, np.diff(np.r_[first, len(self.fps)])
        return self.levels[depth]

    def children(self, depth: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nodes one level below, by the next bit; -1 where there is none."""
        (first, many), (below, _) = self.level(depth), self.level(depth + 1)
        at, end = first[nodes], first[nodes] + many[nodes]
        child = np.searchsorted(below, at)
        two = np.searchsorted(below, end) - child == 2
        bit = (self.fps[at] >> np.uint64(63 - depth)) & np.uint64(1) == 1
        return np.where(bit, -1, child), np.where(two, child + 1, np.where(bit, child, -1))


def unite(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Labels after joining left and right; a label is the least index of its set."""
    while True:
        a, b = label[left], label[right]
        apart = a != b
        if not apart.any():
            return label
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(further := label[label], label):
            label = further


def trie_links(fps: np.ndarray, starts: list[tuple[int, int, int]], depth: int, budget: int, agree: int = 0) -> np.ndarray:
    """Labels of the sets that links of at most `budget` bits form among sorted fingerprints.

    starts: pairs of nodes at `depth` with the bits their prefixes differ in. Pairs of nodes are taken down together;
    a pair whose prefixes differ in more bits, or in one of the first `agree`, goes. Pairs of few fingerprints are compared
    whole, and link whatever their first bits.
    """
    trie, label = Trie(fps), np.arange(len(fps))
    todo = [(depth, *(np.array(column, np.int64) for column in zip(*starts)))]
    while todo:
        depth, a, b, err = todo.pop()
        if len(a) > PAIRS:
            half = len(a) // 2
            todo += [(depth, a[:half], b[:half], err[:half]), (depth, a[half:], b[half:], err[half:])]
            continue
        first, many = trie.level(depth)
        small = (many[a] * many[b] <= LEAF) | (depth == 64)
        if small.any():
            x, y = a[small], b[small]
            each = many[x] * many[y]
            within = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            wide = np.repeat(many[y], each)
            left, right = np.repeat(first[x], each) + within // wide, np.repeat(first[y], each) + within % wide
            near = np.bitwise_count(fps[left] ^ fps[right]) <= budget
            label = unite(label, left[near], right[near])
        a, b, err = a[~small], b[~small], err[~small]
        if len(a):
            (a0, a1), (b0, b1) = trie.children(depth, a), trie.children(depth, b)
            x, y = np.r_[a0, a1, a0, a1], np.r_[b0, b1, b1, b0]
            bits = np.r_[err, err, err + 1, err + 1]
            # A node with itself has the pair of its two children once.
            go = (x >= 0) & (y >= 0) & (bits <= (budget if depth >= agree else 0)) & (x <= y)
            if go.any():
                todo.append((depth + 1, x[go], y[go], bits[go]))
    return label


def blocks_of(budget: int) -> list[int]:
    """Where the blocks of bits begin of which two fingerprints within the budget have one in common at least."""
    return [64 * i // (budget + 1) for i in range(budget + 1)]


def turned(classes: DataFrame, budget: int) -> DataFrame:
    """(block, fp): each fingerprint once per block, turned so that the block's bits come first."""

    def by(bits: int) -> Column:
        return F.shiftleft("fp", bits).bitwiseOR(F.shiftrightunsigned("fp", 64 - bits)) if bits else F.col("fp")

    each = (F.struct(F.lit(i).alias("block"), by(at).alias("fp")) for i, at in enumerate(blocks_of(budget)))
    return classes.select(F.explode(F.array(*each)).alias("one")).select("one.*")


def split_depths(sent: DataFrame, budget: int) -> list[int]:
    """For each block the least depth at which no subtree has over SUBTREE fingerprints; 2**DEEPEST counts a block at most."""
    deepest = min(DEEPEST, 64 // (budget + 1))
    counts = np.zeros((budget + 1, 1 << deepest), np.int64)
    prefix = F.shiftrightunsigned("fp", 64 - deepest)
    for row in sent.groupBy("block", prefix.alias("prefix")).count().collect():
        counts[row["block"], row["prefix"]] = row["count"]

    def least(of: np.ndarray) -> int:
        fits = (d for d in range(min(LEAST_DEPTH, deepest), deepest) if of.reshape(1 << d, -1).sum(axis=1).max() <= SUBTREE)
        return next(fits, deepest)

    return [least(of) for of in counts]


def fingerprint_links(classes: DataFrame, budget: int = 3) -> DataFrame:
    """Links (u, v) between fingerprints that have the same components as all pairs within `budget` bits.

    Two of them agree in one of budget + 1 blocks of bits at least. There is a trie for each block, which has the block's
    bits first, so each fingerprint is sent budget + 1 times at every size. A trie is split into subtrees by its
    first bits; pairs agree in these, so a subtree is joined with itself alone. A task returns one link for each fingerprint
    at most: to the least of the set that its own pairs form.
    """
    begins = blocks_of(budget)
    ends = [*begins[1:], 64]
    sent = turned(classes, budget)
    depths = split_depths(sent, budget)
    subtree = F.coalesce(*(F.when(F.col("block") == i, F.shiftrightunsigned("fp", 64 - depth)) for i, depth in enumerate(depths)))

    def links(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        block = int(key[0])
        fps = np.sort(rows["fp"].to_numpy().view(np.uint64))
        label = trie_links(fps, [(0, 0, 0)], depths[block], budget, ends[block] - begins[block] if budget else 0)
        joined = np.flatnonzero(label != np.arange(len(label)))
        if begins[block]:
            back = np.uint64(begins[block])
            fps = (fps >> back) | (fps << (np.uint64(64) - back))
        return pd.DataFrame({"u": fps[joined].view(np.int64), "v": fps[label[joined]].view(np.int64)})

    return sent.withColumn("subtree", subtree).groupBy("block", "subtree").applyInPandas(links, "u long, v long")


def near_duplicates(docs: DataFrame, carry: list[str], shingle: int = 3, budget: int = 3) -> DataFrame:
    """(carried columns, fp, component, component_id) for every row of docs (doc_id, text, ...).

    Documents link if their fingerprints differ in at most `budget` bits; component_id is the least doc_id that links
    reach, component the fingerprint that stands for them. Links are looked for between distinct fingerprints, so copies cost nothing. Null or wordless text has
    the fingerprint zero and links like any other; a null doc_id never names a component unless it has no other. No
    rows: no rows. A carried column named like one of the result's own comes back as <name>_given.
    """
    printed = cut(fingerprints(docs, carry, shingle))
    classes = cut(printed.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    root = connected(fingerprint_links(classes, budget))
    rooted = classes.join(root.select(F.col("u").alias("fp"), "v"), "fp", "left").withColumn("v", F.coalesce("v", "fp"))
    least = rooted.groupBy("v").agg(F.min("least_id").alias("component_id"))
    named = rooted.join(least, "v").select("fp", F.col("v").alias("component"), "component_id")
    return printed.join(named, "fp").select(*beside(carry, "fp component component_id"), "fp", "component", "component_id")


def one_per_group(docs: DataFrame, shingle: int = 3, budget: int = 3) -> DataFrame:
    """Of every component the row with the least doc_id (nulls last, then by digest), with the columns of docs.

    Of rows equal in id and text one stays.
    """
    named = docs.withColumn("_row", row_digest(F.col("doc_id"), F.col("text"))).select("doc_id", "text", "_row")
    grouped = near_duplicates(named, ["doc_id", "_row"], shingle, budget)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_row"))
    first = grouped.groupBy("component").agg(F.min(order).alias("first")).select(F.col("first._row").alias("_keep"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), row_digest(F.col("doc_id"), F.col("text")).alias("_row"))
    chosen = rows.join(first, F.col("_row") == F.col("_keep"))
    same = Window.partitionBy("_row").orderBy("_row")
    return chosen.withColumn("_nth", F.row_number().over(same)).where("_nth = 1").select("row.*")
