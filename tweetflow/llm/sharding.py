"""Shards of near equal bytes: ranges between sampled splitters, overfull ranges subdivided."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Ranges per shard, and keys drawn per range. They set how even shards are, and bound what the driver holds.
FINE, DRAWN = 64, 16


def _uniform(*columns: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("draw"), *columns), F.lit(1 << 30)) / (1 << 30)


def splitters(keyed: DataFrame, ranges: int, total: int) -> np.ndarray:
    """Quantile boundaries from a sample of keys drawn in proportion to size; about ranges * DRAWN keys."""
    share = F.col("size") * (ranges * DRAWN / max(total, 1))
    drawn = keyed.where(_uniform(F.col("key"), F.col("tie")) < share).select("key", F.greatest(share, F.lit(1.0)).alias("weight"))
    # Copies of one text are one row, so that a group of them is one key of great weight.
    rows = drawn.groupBy("key").agg(F.sum("weight").alias("weight")).toPandas().sort_values("key")
    if rows.empty:
        return np.array([], np.int64)
    reached = rows["weight"].cumsum().to_numpy()
    at = np.searchsorted(reached, reached[-1] * np.arange(1, ranges) / ranges)
    return np.unique(rows["key"].to_numpy()[np.minimum(at, len(rows) - 1)])


def range_of(key: Column, bounds: np.ndarray) -> Column:
    """A key at a boundary is a range of its own between two others, so a heavy key can be subdivided alone."""

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            keys = batch.to_numpy()
            yield pd.Series(np.searchsorted(bounds, keys, "left") + np.searchsorted(bounds, keys, "right"), dtype="int32")

    return F.pandas_udf(of, "int")(key)


def assign(docs: DataFrame, shards: int = 16, carry: list[str] | None = None) -> DataFrame:
    """(row: the carried columns, doc_id, size, shard, slot) for every row of docs (doc_id, text, ...).

    size: the text's bytes in UTF-8, null none, and 1. The key is a hash of the text, so equal texts are one group and lie
    side by side in the order of keys. Splitters are drawn from the keys in proportion to size; exact bytes and rows are
    then summed by range. A range with more than its share of either is subdivided by a second hash of the key, so equal
    texts stay together; one that is a single key, by a hash of the id, so a group of copies with a third of all rows is
    spread over as many parts as it fills. Parts in order are dealt to shards by
    the bytes before them, which makes shards equal but for one part each. Slots are counted within parts,
    from the part's first slot. The driver holds the sample and the parts: a number given by `shards`, not by the input.
    Null and empty texts are one group each of size 1; rows equal in id and text get slots of their own. No rows: no
    rows.
    """
    keyed = docs.select(
        F.struct(*(carry or docs.columns)).alias("row"), "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.xxhash64("text").alias("key"), F.xxhash64(F.lit("tie"), "doc_id").alias("tie"),
    )
    narrow = keyed.select("size", "key", "tie")
    total, rows = narrow.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    ranges = shards * FINE
    bounds = splitters(narrow, ranges, total)
    filled = (
        narrow.groupBy(range_of(F.col("key"), bounds).alias("range"))
        .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        .toPandas()
    )
    fill = np.maximum(filled["bytes"] * ranges / max(total, 1), filled["rows"] * ranges / max(rows, 1))
    parts = np.ones(2 * len(bounds) + 1, np.int64)
    parts[filled["range"]] = np.ceil(fill).astype(np.int64).clip(1)
    n_parts = F.get(F.lit([int(x) for x in parts]).cast("array<int>"), F.col("range"))
    # Odd ranges are single keys.
    finer = F.when(F.col("range") % 2 == 1, F.col("tie")).otherwise(F.xxhash64(F.lit("part"), "key"))

    def in_parts(rows: DataFrame) -> DataFrame:
        return rows.withColumn("range", range_of(F.col("key"), bounds)).withColumn("part", F.pmod(finer, n_parts).cast("int"))

    placed = in_parts(keyed)
    sums = (
        in_parts(narrow).groupBy("range", "part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        .toPandas().sort_values(["range", "part"])
    )
    middle = sums["bytes"].cumsum() - sums["bytes"] / 2
    sums["shard"] = np.minimum(middle * shards // max(total, 1), shards - 1).astype("int32")
    sums["first"] = sums.groupby("shard")["rows"].cumsum() - sums["rows"]
    spark = docs.sparkSession
    columns = ["range", "part", "shard", "first"]
    table = spark.createDataFrame(list(map(tuple, sums[columns].astype("int64").to_numpy().tolist())), "range int, part int, shard int, first long")
    nth = F.row_number().over(Window.partitionBy("range", "part").orderBy("key", "doc_id")) - 1
    return (
        placed.withColumn("nth", nth).join(F.broadcast(table), ["range", "part"])
        .select("row", "doc_id", "size", "shard", (F.col("first") + F.col("nth")).alias("slot"))
    )
