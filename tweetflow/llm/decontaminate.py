"""Benchmark decontamination: benchmark suffixes searched in suffix arrays of the training text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: More benchmark text is refused: every task holds it.
MOST_BENCHMARK_BYTES = 1 << 28
# Words of a shard, that is of one suffix array, and places looked at together: they bound memory.
SHARD_WORDS, PLACES = 1 << 19, 1 << 18
# ASCII letters in lower case, digits, and every byte above ASCII; all others part words.
LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(LETTERS).split()


@dataclass
class Tests:
    """The benchmark: item names in order, the words' numbers from 1, and all items' words with 0 after each item."""

    names: list[str]
    vocabulary: dict[bytes, int]
    words: np.ndarray
    item: np.ndarray
    start: np.ndarray
    width: np.ndarray

    def numbers(self, text: bytes | None) -> np.ndarray:
        """The text's words as numbers, 0 for those no item has."""
        words = words_of(text)
        return np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int32, len(words))

    @classmethod
    def of(cls, items: list[tuple[str, bytes]], window: int) -> Tests:
        names = sorted({name for name, _ in items}, key=lambda name: name.encode())
        number = {name: i for i, name in enumerate(names)}
        vocabulary: dict[bytes, int] = {}
        words: list[int] = []
        item, start, width = [], [], []
        for name, text in items:
            own = [vocabulary.setdefault(word, len(vocabulary) + 1) for word in words_of(text)]
            if own:
                wide = min(window, len(own))
                many = len(own) - wide + 1
                item += [number[name]] * many
                start += range(len(words), len(words) + many)
                width += [wide] * many
                words += [*own, 0]
        return cls(names, vocabulary, *(np.array(x, np.int64) for x in (words, item, start, width)))


def suffix_array(words: np.ndarray, starts: np.ndarray, longest: int) -> np.ndarray:
    """The starts in the order of the words that follow, up to `longest` or the next 0, by prefix doubling."""
    rank = words
    order = starts[np.argsort(rank[starts], kind="stable")]
    done = 1
    while done < longest:
        # Ranks of all places, so that rank[i + done] is known; behind the end, and behind a 0, nothing follows.
        after = np.r_[rank[done:], np.zeros(min(done, len(rank)), rank.dtype)]
        both = np.where(rank == 0, 0, rank * (rank.max(initial=0) + 1) + after)
        _, rank = np.unique(both, return_inverse=True)
        if both.min(initial=1) > 0:
            rank = rank + 1
        order = starts[np.argsort(rank[starts], kind="stable")]
        done *= 2
    return order


def search(words: np.ndarray, array: np.ndarray, tests: Tests) -> tuple[np.ndarray, np.ndarray]:
    """For each window of the tests the run [low, high) of the suffix array that begins with it.

    Binary search, for all windows together, one word further at a time; a window's run narrows until it is empty.
    """
    low, high = np.zeros(len(tests.start), np.int64), np.full(len(tests.start), len(array), np.int64)
    padded = np.r_[words, np.zeros(int(tests.width.max(initial=0)) + 1, words.dtype)]
    for step in range(int(tests.width.max(initial=0))):
        live = np.flatnonzero((high > low) & (tests.width > step))
        if not len(live):
            break
        wanted = tests.words[tests.start[live] + step]
        bounds = []
        for above in (0, 1):
            left, right = low[live].copy(), high[live].copy()
            while (open_ := left < right).any():
                middle = (left + right) // 2
                found = padded[array[np.minimum(middle, len(array) - 1)] + step]
                smaller = found < wanted + above
                left, right = np.where(open_ & smaller, middle + 1, left), np.where(open_ & ~smaller, middle, right)
            bounds.append(left)
        low[live], high[live] = bounds
    return low, high


def examine_shard(texts: list[np.ndarray], tests: Tests) -> list[tuple[int, list[str], list[dict]]]:
    """For each document, as word numbers, (hit words, names of the items that occur, longest verbatim matches)."""
    lengths = np.array([len(text) for text in texts], np.int64)
    first = np.cumsum(lengths + 1) - lengths - 1
    words = np.zeros(int(lengths.sum()) + len(texts), np.int64)
    for at, text in zip(first, texts):
        words[at : at + len(text)] = text
    # A match lies within a run of words the benchmark knows: shorter runs hold none and are left out of the array.
    nothing = np.flatnonzero(words == 0)
    places = np.arange(len(words))
    run = np.r_[nothing, len(words)][np.searchsorted(nothing, places)] - places
    starts = np.flatnonzero(run >= tests.width.min(initial=1)) if len(tests.width) else places[:0]
    out = [(0, [], []) for _ in texts]
    if not len(starts):
        return out
    array = suffix_array(words, starts, int(tests.width.max()))
    low, high = search(words, array, tests)
    edges, matched = np.zeros(len(words) + 1, np.int64), []
    windows = np.flatnonzero(high > low)
    if not len(windows):
        return out
    many = (high - low)[windows]
    for part in np.split(windows, np.flatnonzero(np.diff(np.cumsum(many) // PLACES)) + 1):
        each = (high - low)[part]
        within = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        at, window = array[np.repeat(low[part], each) + within], np.repeat(part, each)
        np.add.at(edges, at, 1)
        np.add.at(edges, at + tests.width[window], -1)
        matched.append((np.searchsorted(first, at, side="right") - 1, window, at))
    hit = np.r_[0, np.cumsum(np.cumsum(edges[:-1]) > 0)]
    doc, window, at = (np.concatenate(column) for column in zip(*matched))
    # Windows that follow each other in the item and in the document are one match.
    diagonal = at - tests.start[window]
    order = np.lexsort((at, diagonal, tests.item[window], doc))
    doc, window, at, diagonal = doc[order], window[order], at[order], diagonal[order]
    item = tests.item[window]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1]) | (at[1:] != at[:-1] + 1)]
    begin = np.flatnonzero(new)
    end = np.r_[begin[1:], len(at)] - 1
    bounds = np.searchsorted(doc[begin], np.arange(len(texts) + 1))
    for i in np.unique(doc):
        runs = range(bounds[i], bounds[i + 1])
        spans = [
            {"item_id": tests.names[item[begin[r]]], "start": int(at[begin[r]] - first[i]), "words": int(at[end[r]] - at[begin[r]] + tests.width[window[end[r]]])}
            for r in runs
        ]
        names = [tests.names[k] for k in np.unique(item[begin[bounds[i]] : end[bounds[i + 1] - 1] + 1])]
        out[i] = (int(hit[first[i] + lengths[i]] - hit[first[i]]), names, spans)
    return out


def read_tests(benchmark: DataFrame, window: int) -> Tests:
    """Benchmarks are small next to the corpus; this one's size is checked before it is fetched."""
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if size > MOST_BENCHMARK_BYTES:
        raise ValueError(f"a benchmark of {size} bytes; every task holds it, up to {MOST_BENCHMARK_BYTES}: pass it in parts")
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), F.col("text").cast("binary").alias("text"))
    return Tests.of([(row["name"], bytes(row["text"] or b"")) for row in rows.collect()], window)


def examine(docs: DataFrame, benchmark: DataFrame, carry: list[str], window: int = 10) -> DataFrame:
    """(row: the carried columns, n_words, n_hit, items, spans) for every row of docs (text, ...).

    A window is `window` consecutive words of an item, or a whole shorter item. Documents are dealt to shards as they
    are read; a shard has one suffix array, in which every suffix of the benchmark is searched. n_hit: words
    inside an occurrence of a window. items: names of the items (item_id, text) with occurring windows, in string
    order. spans: the longest verbatim matches that are at least a window long, as (item_id, start, words) in words
    of the document. A document is in one shard, so nothing is shuffled. Null and wordless texts have no words and no
    hits; items without words, an empty benchmark: no hits; items of one id count once; a null id counts as an empty
    name. Repeated documents are examined alike. No rows: no rows.
    """
    tests = docs.sparkSession.sparkContext.broadcast(read_tests(benchmark, window))
    taken = [*carry, *({"text"} - set(carry))]
    rows = docs.select(F.struct(*taken).alias("row"))
    kept = docs.select(F.struct(*carry).alias("row")).schema["row"].dataType.simpleString()
    schema = f"row {kept}, n_words long, n_hit long, items array<string>, spans array<struct<item_id:string,start:long,words:long>>"

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("item_id", pa.string()), ("start", pa.int64()), ("words", pa.int64())])
        for batch in batches:
            row = batch.column("row")
            texts = row.field("text").cast(pa.binary())
            found, counts, shard, held = [], [], [], 0
            for text in texts:
                shard.append(tests.value.numbers(text.as_py()))
                counts.append(len(shard[-1]))
                held += counts[-1]
                if held > SHARD_WORDS:
                    found += examine_shard(shard, tests.value)
                    shard, held = [], 0
            found += examine_shard(shard, tests.value) if shard else []
            hits, items, spans = zip(*found) if found else ((), (), ())
            part = pa.StructArray.from_arrays([row.field(name) for name in carry], fields=[row.type.field(name) for name in carry])
            yield pa.RecordBatch.from_arrays(
                [part, pa.array(counts, pa.int64()), pa.array(hits, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(spans, pa.list_(span))],
                names=["row", "n_words", "n_hit", "items", "spans"],
            )

    return rows.mapInArrow(shards, schema)


def without_hits(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents with no benchmark window in them, with the columns of docs."""
    return examine(docs, benchmark, docs.columns, window).where("n_hit = 0").select("row.*")
