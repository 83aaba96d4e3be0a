"""Toxic passages as maximum-scoring segments of token log-odds."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"[^\W\d_]+")
# A word is known by itself and by its beginnings of so many letters, which its inflections share; "" is any word.
BEGINNINGS = range(4, 8)
#: A token needs this count to have odds. Log-odds with these z, the latter for beginnings of words, are halved; those of
#: smaller z shrink further, and of larger ones less.
LEAST_COUNT, HALF_Z, BEGINNING_Z = 3, 4.0, 6.0
# The prior gives every token half a count, and so many more in all in proportion to its counts; then what
# every token takes from a segment, as the only weight of one of no known odds, the largest log-odds, and those of the
# weakest word that makes a segment.
PRIOR, DRIFT, STRONGEST, WEAKEST = 20.0, 0.15, 12.0, 3.0
# A word that comes again within so many words of where it was counted does not count: odds are of the different words of documents.
AGAIN = 50
# Distinct tokens a task counts before it passes them on, and words whose weights a task remembers.
HELD = 1 << 16
EULER = 0.5772156649015329


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def forms(word: str) -> list[str]:
    """The word, and those of its beginnings that are shorter with an asterisk."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if n < len(word))]


def hashed(names: list[str]) -> np.ndarray:
    """64-bit hashes, the same in every process."""
    return pd.util.hash_array(np.array(names, dtype=object), categorize=False)


class Weights:
    """Weights of words from (sure, weight) by form: the weight of the surest form, and drift without any.

    Forms are held as sorted hashes with two numbers each, so all that have odds fit.
    """

    def __init__(self, strong: dict[str, tuple[float, float]] | tuple[np.ndarray, np.ndarray, np.ndarray]):
        if isinstance(strong, dict):
            values = np.array(list(strong.values()), np.float64).reshape(-1, 2)
            strong = (hashed(list(strong)), values[:, 0], values[:, 1])
        order = np.argsort(strong[0], kind="stable")
        self.keys, self.sure, self.weights = (column[order] for column in strong)
        self.words = {}

    def __reduce__(self):
        return Weights, ((self.keys, self.sure, self.weights),)

    def look_up(self, words: list[str]) -> dict[str, float]:
        if not words or not len(self.keys):
            return dict.fromkeys(words, -DRIFT)
        names, owner = [], []
        for i, word in enumerate(words):
            own = forms(word)
            names += own
            owner += [i] * len(own)
        keys = hashed(names)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = np.flatnonzero(self.keys[at] == keys)
        at, owner = at[known], np.array(owner)[known]
        # The surest form of a word comes last.
        order = np.lexsort((self.weights[at], self.sure[at], owner))
        found = np.full(len(words), -DRIFT)
        found[owner[order]] = self.weights[at[order]]
        return dict(zip(words, found.tolist()))

    def all_of(self, words: list[str]) -> np.ndarray:
        new = [word for word in set(words) if word not in self.words]
        known = self.words
        if new:
            # Of words that do not fit, only those of this text are held.
            if len(known) + len(new) > HELD:
                new, known = list(set(words)), {}
            known.update(self.look_up(new))
            self.words = known if len(known) <= HELD else {}
        return np.fromiter(map(known.__getitem__, words), np.float64, len(words))

    def of(self, word: str) -> float:
        return float(self.all_of([word])[0])


@dataclass(frozen=True)
class Extremes:
    """How best segments are spread in one kind of document: some have one (hit); the logarithm of 1 and its score then
    follows an extreme-value distribution."""

    hit: float
    place: float
    scale: float

    @classmethod
    def fitted(cls, rows: int, hits: int, mean: float | None, deviation: float | None, least_scale: float = 0.25) -> Extremes:
        """From the rows and the mean and deviation of the hits. One more hit by the weakest word is taken as seen, and one
        more row without, so that nothing is impossible."""
        weakest, mean = math.log1p(WEAKEST), mean or 0.0
        middle = (hits * mean + weakest) / (hits + 1)
        square = hits * ((deviation or 0.0) ** 2 + (mean - middle) ** 2) + (weakest - middle) ** 2
        scale = max(least_scale, math.sqrt(6 * square / (hits + 1)) / math.pi)
        return cls((hits + 1) / (rows + 2), middle - EULER * scale, scale)

    def mean(self) -> float:
        return self.place + EULER * self.scale

    def log_density(self, x: float) -> float:
        z = (x - self.place) / self.scale
        return math.log(self.hit) - z - math.exp(min(-z, 700.0)) - math.log(self.scale)

    def above(self, x: float) -> float:
        """The chance of a document with a segment at or above x."""
        return -self.hit * math.expm1(-math.exp(min(-(x - self.place) / self.scale, 700.0)))


@dataclass(frozen=True)
class Model:
    """Weights of words, the best segments of clean and of toxic documents, and the share of toxic ones."""

    weights: Weights
    clean: Extremes
    toxic: Extremes
    share: float

    def score(self, best: float) -> float:
        """The chance that a document with this best segment is toxic, at least that of one without a segment."""
        odds = math.log((1 - self.toxic.hit) / (1 - self.clean.hit))
        if best > 0:
            x = max(math.log1p(best), self.clean.mean())
            odds = max(odds, self.toxic.log_density(x) - self.clean.log_density(x))
        odds += math.log(self.share / (1 - self.share))
        return 1 / (1 + math.exp(-max(min(odds, 700.0), -700.0)))


def segments(weights: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) in linear time (Ruzzo and Tompa 1999).

    Runs of one sign are summed first, so the scan meets as many steps as there are runs of positive weights.
    """
    positive = weights > 0
    if not positive.any():
        return []
    starts = np.flatnonzero(positive & ~np.r_[False, positive[:-1]])
    ends = np.flatnonzero(positive & ~np.r_[positive[1:], False]) + 1
    total = np.r_[0.0, np.cumsum(weights)]
    # (start, end, sum before start, sum at end) of segments that may still grow
    found: list[tuple[int, int, float, float]] = []
    before: list[int] = []
    for start, end in zip(starts.tolist(), ends.tolist()):
        left, right = float(total[start]), float(total[end])
        while True:
            # The last segment that begins at a lower sum; pointers skip those that don't.
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j = before[j]
            if j < 0 or found[j][3] >= right:
                found.append((start, end, left, right))
                before.append(j)
                break
            start, left = found[j][0], found[j][2]
            del found[j:], before[j:]
    return [(start, end, right - left) for start, end, left, right in found]


def weigh(words: list[str], weights: Weights) -> np.ndarray:
    found = weights.all_of(words)
    last: dict[str, int] = {}
    for at, word in enumerate(words):
        if at - last.get(word, -AGAIN) < AGAIN:
            found[at] = -DRIFT
        else:
            last[word] = at
    return found


def token_counts(rows: DataFrame) -> DataFrame:
    """(token, toxic, clean): how many different words of documents (text, toxic) have this form; counted in the tasks
    first. The token "" has the number of all of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            names = list(held[0] | held[1])
            columns = [pa.array(names, pa.string()), *(pa.array([c[x] for x in names], pa.int64()) for c in (held[1], held[0]))]
            for counter in held:
                counter.clear()
            return pa.RecordBatch.from_arrays(columns, names=["token", "toxic", "clean"])

        for batch in batches:
            for text, toxic in zip(batch.column("text"), batch.column("toxic")):
                words, counter = set(tokens(text.as_py())), held[toxic.as_py() == 1]
                counter[""] += len(words)
                for word in words:
                    counter.update(forms(word))
                if len(held[0]) + len(held[1]) > HELD:
                    yield flush()
        yield flush()

    counted = rows.select("text", "toxic").mapInArrow(count, "token string, toxic long, clean long")
    return counted.groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def log_odds(counts: DataFrame) -> DataFrame:
    """(token, weight, z): log-odds of toxic against clean documents under a Dirichlet prior in proportion to the
    token's count in both (Monroe et al. 2008)."""
    every = counts.where("token = ''").first()
    all_toxic, all_clean = (every["toxic"], every["clean"]) if every else (0, 0)
    prior = 0.5 + F.lit(PRIOR / max(all_toxic + all_clean, 1)) * (F.col("toxic") + F.col("clean"))

    def odds(own: str, every: int) -> Column:
        have = F.col(own) + F.col("prior")
        return F.log(have / F.greatest(F.lit(every + 2 * PRIOR) - have, F.lit(0.5)))

    spread = F.sqrt(1 / (F.col("toxic") + F.col("prior")) + 1 / (F.col("clean") + F.col("prior")))
    return (
        counts.where("token <> ''").withColumn("prior", prior)
        .withColumn("weight", odds("toxic", all_toxic) - odds("clean", all_clean))
        .withColumn("z", F.col("weight") / spread)
    )


def shrunk(odds: DataFrame) -> DataFrame:
    """(key, sure, weight) of all tokens of (token, weight, z): log-odds, of either sign, shrunk by their z without a limit
    below which they are none, less the drift. Sure is how many deviations they are from none."""

    def keys(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(hashed(batch.tolist()).view(np.int64) if len(batch) else [], dtype="int64")

    half = F.when(F.col("token").endswith("*"), BEGINNING_Z).otherwise(HALF_Z)
    size = F.abs("z")
    weight = F.col("weight") * F.pow(size, 4) / (F.pow(size, 4) + F.pow(half, 4))
    return odds.select(
        F.pandas_udf(keys, "long")("token").alias("key"),
        size.cast("float").alias("sure"),
        (F.least(F.lit(STRONGEST), F.greatest(F.lit(-STRONGEST), weight)) - DRIFT).cast("float").alias("weight"),
    )


def best_segment(text: Column, weights) -> Column:
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(
                [max((s for _, _, s in segments(weigh(tokens(text), weights.value))), default=0.0) for text in batch],
                dtype="float64",
            )

    return F.pandas_udf(of, "double")(text)


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model from rows of docs (doc_id, text) that have labels (doc_id, toxic); None without rows of both kinds.

    Odds are learned from three quarters of the rows, by a hash of the id; on the others, whose words the odds have
    not seen, the best segments of clean and of toxic documents each give an extreme-value distribution; where these lack
    a kind, all rows do. All rows are counted. Odds are of words and of their beginnings, which stand for words too rare to have odds. The model keeps
    all of them, 16 bytes each: that is its broadcast.
    A document labelled twice is toxic if one label says so. Null texts are empty; null ids and labels teach nothing.
    """
    spark = docs.sparkSession
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # Labels grow with the documents, so the two are always shuffled; labels are the side that is held in memory.
    known = known.hint("shuffle_hash")
    held_back = F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(4)) == 0

    def labelled(which: Column) -> DataFrame:
        return docs.select("doc_id", "text").where(which).join(known.where(which), "doc_id").select("text", "toxic")

    # One row a token; the counts are kept, for they are read twice.
    counts = token_counts(labelled(~held_back)).where(F.col("toxic") + F.col("clean") >= LEAST_COUNT).persist()
    every = shrunk(log_odds(counts)).toArrow()
    counts.unpersist()
    columns = [every.column(name).to_numpy() for name in ("key", "sure", "weight")]
    weights = spark.sparkContext.broadcast(Weights((columns[0].view(np.uint64), *columns[1:])))
    best = F.when(F.col("best") > 0, F.log1p("best"))

    def spread_of(which: Column) -> dict:
        found = (
            labelled(which).select(F.col("toxic").cast("int").alias("toxic"), best_segment(F.col("text"), weights).alias("best"))
            .groupBy("toxic")
            .agg(F.count("*").alias("rows"), F.count(best).alias("hits"), F.avg(best).alias("mean"), F.stddev_pop(best).alias("deviation"))
        )
        return {row["toxic"]: row for row in found.collect()}

    spread = spread_of(held_back)
    if not {0, 1} <= spread.keys():
        # Few labels: words the odds have seen tell less, but more than none.
        spread = spread_of(F.lit(True))
    if not {0, 1} <= spread.keys():
        return None
    fields = ("rows", "hits", "mean", "deviation")
    clean = Extremes.fitted(*(spread[0][field] for field in fields))
    # No narrower than the clean one, or the strongest segments of all would count as clean.
    toxic = Extremes.fitted(*(spread[1][field] for field in fields), clean.scale)
    return Model(weights.value, clean, toxic, spread[1]["rows"] / (spread[0]["rows"] + spread[1]["rows"]))


def scored(text: Column, model: Model | None, spark, significance: float = 1e-3) -> Column:
    """struct(score, passages) of a text: the chance that it is toxic, and its significant passages.

    Words with a form of known odds have them, shrunk by how sure they are and less a small drift, as weight; all others the negative drift alone. One linear scan finds all maximal
    scoring segments; a passage is a segment such as a clean document reaches with a chance of `significance` at
    most, as (start, end, score) in characters. Whether there is a segment, and the best one's place in the two
    extreme-value distributions, give the score. Null, empty and wordless texts have no segment and the lowest score; without a model the score is 0. Whole
    texts are scanned. Equal texts have equal scores.
    """
    shared = spark.sparkContext.broadcast(model)

    def passages(text: str, found: list[tuple[int, int, float]], model: Model) -> list[dict]:
        strong = [segment for segment in found if model.clean.above(math.log1p(segment[2])) <= significance]
        if not strong:
            return []
        places = [match.span() for match in TOKEN.finditer(text.lower())]
        return [{"start": places[a][0], "end": places[b - 1][1], "score": s} for a, b, s in strong]

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in batches:
            scores, spans = [], []
            for text in batch:
                found = segments(weigh(tokens(text), model.weights)) if model else []
                scores.append(model.score(max((s for _, _, s in found), default=0.0)) if model else 0.0)
                spans.append(passages(text, found, model) if found else [])
            yield pd.DataFrame({"score": scores, "passages": spans})

    return F.pandas_udf(of, "score double, passages array<struct<start:int,end:int,score:double>>")(text)


def training_rows(docs: DataFrame, part: int = 1, of: int = 3) -> DataFrame:
    """Rows that may teach: crc32 of the id as text is not `part` modulo `of`."""
    return docs.where(~held_out(F.col("doc_id"), part, of))


def held_out(doc_id: Column, part: int = 1, of: int = 3) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % of == part, F.lit(False))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The documents scored below the threshold, with the columns of docs."""
    model = fit(training_rows(docs), labels)
    rows = docs.select(F.struct(*docs.columns).alias("row"), scored(F.col("text"), model, docs.sparkSession)["score"].alias("score"))
    return rows.where(F.col("score") < threshold).select("row.*")
