"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tweetflow.llm.common import words

# Positions are whole numbers of 1/2**26 of a copy, so that sums are exact up to 4e10 documents a source.
UNIT = 26


def size_band(size: Column) -> Column:
    """Groups sizes that differ by under a thirty-second; at most 64 bands for each binary order of magnitude."""
    digits = F.length(F.bin(size))
    return F.when(size < 64, size).otherwise(
        digits.cast("long") * 64 + F.expr("shiftright(size, length(bin(size)) - 6)")
    )


def hex_number(text: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """(source, source_size, target) from (source, words); one row a source, so the one unpartitioned window is small.

    All sizes are shared by weight. A source takes at most `most` times its size; sorted by the level at which
    they fill up, sources full below the common level are the ones for which the rest, shared, would exceed it.
    """
    source = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    fills = Window.orderBy(F.col("cap") / F.col("weight"), F.col("place"))
    before = fills.rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    return (
        sizes.groupBy("source").agg(F.sum("words").alias("source_size"))
        .withColumn("place", F.row_number().over(source))
        .withColumn("weight", weight.cast("long"))
        .withColumn("cap", F.col("source_size") * most)
        .withColumn("rest", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("sharing", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", F.col("rest") / F.col("sharing"))
        .withColumn("level", F.max(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))).over(everything))
        .withColumn("cap", F.col("cap").cast("double"))
        .select("source", "source_size", F.coalesce(F.least("cap", F.col("level") * F.col("weight")), "cap").alias("target"))
    )


def allot(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, carry: list[str] | None = None, salts: int = 256
) -> DataFrame:
    """Every row of docs (doc_id, text, source, ...) with the number of copies the mix takes of it.

    Every document of a source expects target / source_size copies. In the order of (size band, salt, size, doc_id)
    expected copies are summed up within the source from an offset that hangs on the source's name, and a document
    is taken once for each whole number its share of the sum crosses. The order by size keeps the words taken near
    the target: they differ by about one large document. A source is never one group: rows are ranked within
    (source, band, one of `salts` parts by doc_id), and counts of these cells, summed before the shuffle, give the
    cell's first position.

    Returns (row: the carried columns, doc_id, source, size, source_size, target, copies). Null text: size 0. Null
    source: a source of its own, last in order. Rows of size 0 take part; rows equal in size and id are alike, so
    their order has no effect on the result. No rows: no rows. Columns named like an output stay within `row`.
    """
    sized = (
        docs.select(F.struct(*(carry or docs.columns)).alias("row"), "doc_id", "source", words(F.col("text")).alias("size"))
        .withColumn("band", size_band(F.col("size")))
        .withColumn("salt", hex_number(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 6) % salts)
    )
    cell = ["source", "band", "salt"]
    cells = sized.groupBy(*cell).agg(F.count("*").alias("rows"), F.sum("size").alias("words"))

    def rows_before(*parts: str, by: str) -> Column:
        earlier = Window.partitionBy(*parts).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("rows").over(earlier), F.lit(0))

    bands = (
        cells.groupBy("source", "band").agg(F.sum("rows").alias("rows"))
        .select("source", "band", rows_before("source", by="band").alias("band_first"))
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = source_targets(cells, weights, most).select(
        F.col("source").alias("of"), "source_size", "target",
        F.floor(rate * (1 << UNIT) + 0.5).alias("step"),
        (hex_number(F.concat(F.lit("mix:"), F.coalesce("source", F.lit("null:"))), 6) * (1 << UNIT - 24)).alias("start"),
    )
    places = (
        cells.select(*cell, rows_before("source", "band", by="salt").alias("cell_first")).alias("c")
        .join(bands.alias("b"), F.expr("c.source <=> b.source AND c.band = b.band"))
        .join(targets.alias("t"), F.expr("c.source <=> t.of"))
        .select("c.*", "source_size", "target", "step", (F.col("band_first") + F.col("cell_first")).alias("first"), "start")
    )
    ranked = sized.withColumn("rank", F.row_number().over(Window.partitionBy(*cell).orderBy("size", "doc_id")) - 1)
    at = "start + step * (first + rank{})"
    copies = F.expr(f"shiftright({at.format(' + 1')}, {UNIT}) - shiftright({at.format('')}, {UNIT})")
    return (
        ranked.alias("r")
        .join(places.alias("p"), F.expr("r.source <=> p.source AND r.band = p.band AND r.salt = p.salt"))
        .select("r.row", "r.doc_id", "r.source", "r.size", "source_size", "target", copies.cast("int").alias("copies"))
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns of docs. Cases as in `allot`."""
    taken = allot(docs, weights, most).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
