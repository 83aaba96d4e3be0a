"""How far a source's terms lie from its language's and from every other source's, counted by term digests."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tweetflow.llm.common import cut
from tweetflow.session import shared_dir

# Bytes outside terms to spaces, A-Z to a-z. All bytes of a character beyond ASCII belong to terms.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))
# Bytes of a text split at once and counts held before they are handed on: they bound memory, not results.
BLOCK, HELD = 1 << 20, 1 << 19
# Terms and sources of one tile of a language's table of shares.
TILE_TERMS, TILE_SOURCES = 4096, 256
SCALE = 1_000_000_000
# As many groups (rows of a few numbers and two names) are sent to every task; more are joined.
BROADCAST_GROUPS = 10_000


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a block at a time; blocks end between terms."""
    text, at = text.translate(_TERM_BYTES), 0
    while at < len(text):
        end = text.find(b" ", at + BLOCK) if at + BLOCK < len(text) else len(text)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def term_counts(docs: DataFrame) -> DataFrame:
    """(gid, lang, term, n, d, told) from (gid, lang, text): occurrences in and number of documents of a group.

    There are as many rows per term as blocks of documents held it; of the rows of one block that share language and term
    one is told.
    """

    def rows(gid: int, lang: str, words: Counter, docs: Counter, told: set[bytes]) -> pa.RecordBatch:
        new = [term not in told for term in words]
        told.update(words)
        columns = [
            pa.array(np.full(len(words), gid)), pa.array([lang], pa.string()).take(pa.array(np.zeros(len(words), np.int64))),
            pa.array(words, pa.binary(), size=len(words)), pa.array(words.values(), pa.int64(), size=len(words)),
            pa.array(map(docs.__getitem__, words), pa.int64(), size=len(words)), pa.array(new, pa.bool_()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["gid", "lang", "term", "n", "d", "told"])

    def told(counts: dict) -> Iterator[pa.RecordBatch]:
        known: dict[str, set[bytes]] = {}
        for (gid, lang), (words, docs) in counts.items():
            if words:
                yield rows(gid, lang, words, docs, known.setdefault(lang, set()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict = {}
        held = 0
        for batch in batches:
            for gid, lang, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words, docs = counts.setdefault((gid, lang), (Counter(), Counter()))
                held -= len(words)
                seen: set[bytes] = set()
                for piece in _pieces(text):
                    words.update(piece)
                    seen.update(piece)
                docs.update(seen)
                held += len(words)
                if held > HELD:
                    yield from told(counts)
                    counts, held = {}, 0
        yield from told(counts)

    found = docs.mapInArrow(count, "gid long, lang string, term binary, n long, d long, told boolean")
    return found.withColumn("term", F.col("term").cast("string"))


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 terms)), exact for any long."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (n + 2).cast("decimal(19,0)")
    return F.call_function("div", above, (total + 2 * terms).cast("decimal(19,0)")) + 1


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def numbered_groups(docs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """docs as (gid, lang, text), their groups (gid, lang, source), and how many there are.

    ``gid`` is a digest of language and source, seeded so that no two groups share one.
    """
    none = F.lit("")
    plain = docs.select(*[F.coalesce(c, none).alias(c) for c in ("lang", "source", "text")])
    groups = cut(plain.select("lang", "source").distinct())
    many, seed = groups.count(), 0
    while groups.select(F.xxhash64(F.lit(seed), "lang", "source")).distinct().count() < many:
        seed += 1
    gid = F.xxhash64(F.lit(seed), "lang", "source").alias("gid")
    return plain.select(gid, "lang", F.col("text").cast("binary").alias("text")), groups.select(gid, "lang", "source"), many


def _kept(counts: DataFrame, key: list[str], least: int) -> DataFrame:
    """Counts per group of the terms (by key) in at least so many documents of their language, with the language's count."""
    of_group = counts.groupBy("gid", *key).agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    term = Window.partitionBy(*key)
    summed = of_group.withColumns({"lang_n": F.sum("n").over(term), "docs": F.sum("d").over(term)})
    return summed.where(F.col("docs") >= least).select("gid", *key, "n", "lang_n")


def kept_terms(docs: DataFrame, least: int = 10, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """Counts (gid, digest, nth, n, lang_n) of the kept terms of docs (gid, lang, text), and their texts (digest, nth, term).

    Terms are counted by a digest, of ``bits`` bits, of language and term, so that counting shuffles no text. A digest that is
    kept has its least and greatest text looked up; where these differ, terms collide, and those are counted again by their
    text and told apart by ``nth``. Terms that collide are in as many documents together as any of them alone at least, so
    none is lost before.
    """
    spark = docs.sparkSession
    path = shared_dir(spark, "terms")
    term_counts(docs).write.parquet(path)
    digest = F.xxhash64("lang", "term")
    counts = spark.read.parquet(path).withColumn("digest", digest if bits == 64 else F.shiftrightunsigned(digest, 64 - bits))
    kept = cut(_kept(counts, ["digest"], least))

    text = F.struct("lang", "term")
    spelled = counts.where("told").select("digest", "lang", "term").distinct()
    spelled = spelled.join(kept.select("digest").distinct(), "digest", "left_semi")
    ends = cut(spelled.groupBy("digest").agg(F.min(text).alias("text"), F.max(text).alias("last")))
    collided = ends.where("text <> last").select("digest")
    zero = F.lit(0).alias("nth")
    if collided.isEmpty():
        return kept.select("gid", "digest", zero, "n", "lang_n"), ends.select("digest", zero, "text.term")

    again = _kept(counts.join(collided, "digest", "left_semi"), ["digest", "lang", "term"], least)
    split = cut(again.withColumn("nth", F.dense_rank().over(Window.partitionBy("digest").orderBy("lang", "term"))))
    alone = kept.join(collided, "digest", "left_anti").withColumn("nth", zero)
    columns = ["gid", "digest", "nth", "n", "lang_n"]
    texts = ends.where("text = last").select("digest", zero, "text.term")
    return (
        cut(alone.select(*columns).unionByName(split.select(*columns))),
        texts.unionByName(split.select("digest", "nth", "term").distinct()),
    )


def group_sizes(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """Every group with its place in the language and the language's number of sources, and totals of kept terms."""
    totals = kept.groupBy("gid").agg(F.sum("n").alias("total"))
    terms = kept.groupBy("digest", "nth").agg(F.max("lang_n").alias("lang_n"), F.min("gid").alias("gid"))
    by_group = terms.groupBy("gid").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    langs = groups.join(by_group, "gid").groupBy("lang").agg(F.sum("terms").alias("terms"), F.sum("lang_total").alias("lang_total"))
    zero = F.lit(0).cast("long")
    in_lang = Window.partitionBy("lang").orderBy("source")
    return groups.join(totals, "gid", "left").join(langs, "lang", "left").select(
        "gid", "lang", "source", (F.row_number().over(in_lang) - 1).alias("place"),
        F.count("*").over(Window.partitionBy("lang")).alias("sources"),
        *[F.coalesce(c, zero).alias(c) for c in ("total", "terms", "lang_total")],
    )


def _tile(rows: pd.DataFrame) -> pd.DataFrame:
    """Summed distances of the pairs of sources of one tile, over those of its terms that a source of the tile has.

    A row without a digest names a source, with the share of a term it lacks; its ``rest`` is the number of terms
    whose distance is that of two lacking shares, or is put right by the terms of other tiles.
    """
    lang, low, high = rows["lang"].iat[0], rows["low"].iat[0], rows["high"].iat[0]
    heads = rows[rows["head"]].sort_values("place")
    places, lacking = heads["place"].to_numpy(np.int64), heads["p"].to_numpy(np.int64)
    rest = np.int64(heads["rest"].iat[0])
    cells = rows[~rows["head"]]
    term = cells.groupby(["digest", "nth"], sort=False).ngroup().to_numpy()
    table = np.tile(lacking, (term.max() + 1 if len(term) else 0, 1))
    table[term, np.searchsorted(places, cells["place"].to_numpy(np.int64))] = cells["p"].to_numpy(np.int64)
    block = heads["own"].to_numpy()
    right = np.flatnonzero(block == high)
    found = []
    for i in np.flatnonzero(block == low):
        others = right[right > i]
        p, q = table[:, i, None], table[:, others]
        empty = (lacking[i] - lacking[others]) ** 2 // (lacking[i] + lacking[others])
        value = ((p - q) ** 2 // (p + q)).sum(axis=0) + (rest - len(table)) * empty
        found.append(pd.DataFrame({"a": places[i], "b": places[others], "value": value}))
    empty = pd.DataFrame({"a": [], "b": [], "value": []}, dtype="int64")
    return pd.concat([empty, *found], ignore_index=True).assign(lang=lang)


def pair_distances(cells: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, a, b, value) for every two sources of a language, by place, a < b; cells are kept terms with their group's sizes.

    A language's table of shares is cut into tiles of terms and sources. A tile holds the shares its sources have and
    sums all its pairs, so tasks hold a bounded table however common a term or large a source is.
    """
    parts = F.greatest(F.ceil(F.col("terms") / TILE_TERMS), F.lit(1)).cast("int")
    own, blocks = F.floor(F.col("place") / TILE_SOURCES), F.ceil(F.col("sources") / TILE_SOURCES)

    def dealt(rows: DataFrame) -> DataFrame:
        met = rows.withColumn("met", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        return met.withColumns({"own": own, "low": F.least(own, "met"), "high": F.greatest(own, "met")})

    cells = cells.select(
        "lang", "place", "sources", "digest", "nth", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
        F.pmod(F.hash("digest", "nth"), parts).alias("part"), F.lit(0).cast("long").alias("rest"), F.lit(False).alias("head"),
    )
    lacking = F.when(F.col("terms") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("terms"))).otherwise(1)
    heads = sizes.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).select(
        "lang", "place", "sources", F.lit(0).cast("long").alias("digest"), F.lit(0).alias("nth"), lacking.alias("p"), "part",
        F.when(F.col("part") == 0, F.col("terms")).otherwise(0).alias("rest"), F.lit(True).alias("head"),
    )
    tiles = dealt(cells).unionByName(dealt(heads)).drop("sources", "met").groupBy("lang", "part", "low", "high")
    return tiles.applyInPandas(_tile, "lang string, a long, b long, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least: int = 10, top: int = 10, bits: int = 64) -> DataFrame:
    """(lang, source, part, item, value, rank): each source's distance to every other of its language, and its own terms.

    Null text, lang and source are empty texts. A term is kept in a language if at least ``least`` of its documents (rows,
    equal ones included) have it; values rest on kept terms alone. Part ``pair`` has every other source, 0 apart where
    the language keeps no term; part ``term`` the ``top`` terms whose share in the source is above the language's, none for
    a source without such. Equal values are ranked by text. No rows: no rows. Texts of any length are counted block by
    block; only lang, source and text are read, so other columns may have any name.
    """
    docs, groups, many = numbered_groups(docs)
    kept, texts = kept_terms(docs, least, bits)
    sizes = cut(group_sizes(groups, kept))
    cells = kept.join(F.broadcast(sizes) if many <= BROADCAST_GROUPS else sizes, "gid")

    def ranked(rows: DataFrame) -> DataFrame:
        best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
        return rows.select("lang", "source", "part", "item", "value", F.row_number().over(best).alias("rank"))

    of_source = share(F.col("n"), F.col("total"), F.col("terms"))
    of_lang = share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    shares = cells.select("lang", "source", "digest", "nth", of_source.alias("p"), of_lang.alias("q"))
    valued = shares.where("p > q").select("lang", "source", "digest", "nth", distance(F.col("p"), F.col("q")).alias("value"))
    # Ties at the last rank stay until the texts, which order them, are there.
    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc())
    first = valued.withColumn("place", F.rank().over(by_value)).where(F.col("place") <= top)
    named = first.join(texts.withColumnRenamed("term", "item"), ["digest", "nth"])
    terms = ranked(named.withColumn("part", F.lit("term"))).where(F.col("rank") <= top)

    pairs = pair_distances(cells, sizes)
    both = pairs.unionByName(pairs.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    one = sizes.select("lang", F.col("place").alias("a"), "source")
    other = sizes.select("lang", F.col("place").alias("b"), F.col("source").alias("item"))
    apart = ranked(both.join(one, ["lang", "a"]).join(other, ["lang", "b"]).withColumn("part", F.lit("pair")))
    return apart.unionByName(terms)
