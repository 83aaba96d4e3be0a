"""Spelling variants: words one letter apart, found by pairs of numbered trie nodes."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from os.path import commonprefix

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tweetflow.llm.common import cut

# In Latin-1: letters A-Z to a-z, a-z and U+00C0 to U+00FF as they are, all else (and all beyond, written as ?) to spaces.
_RUN_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
# Characters of a text taken at once and words held before they are handed on: they bound memory, not results.
BLOCK, HELD = 1 << 20, 1 << 18
# Words of one task of a trie.
SLICE = 1 << 17


def _runs(text: str) -> Iterator[list[bytes]]:
    """The lower-cased runs of letters, in Latin-1; blocks of text end between runs."""
    at = 0
    rest = b""
    while at < len(text):
        part = rest + text[at : at + BLOCK].encode("latin-1", "replace").translate(_RUN_BYTES)
        at += BLOCK
        end = len(part) if at >= len(text) else part.rfind(b" ") + 1
        rest = part[end:]
        yield part[:end].split()


def misspelled(run: bytes, prefix: int, every: int) -> bytes:
    """The run without one of its letters if its digest after ``prefix`` (a running crc32) is divisible by ``every``."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), prefix)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, shortest: int = 5, least: int = 3, every: int = 97) -> DataFrame:
    """(word, n) of the words of ``shortest`` letters or more that occur ``least`` times or more in all rows.

    One run in ``every``, chosen by doc_id (null: empty) and the run itself, loses a letter first.
    """

    def rows(counts: Counter) -> pa.RecordBatch:
        words = pa.array([word.decode("latin-1") for word in counts], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                prefix = zlib.crc32(f"{doc_id}:".encode())
                for piece in _runs(text):
                    for run, n in Counter(piece).items():
                        word = misspelled(run, prefix, every)
                        if len(word) >= shortest:
                            counts[word] += n
                if len(counts) > HELD:
                    yield rows(counts)
                    counts = Counter()
        yield rows(counts)

    plain = docs.where("text IS NOT NULL").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text")
    counted = plain.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least)


class _Path:
    """The nodes from a trie's root to the last word of sorted words, as words are added."""

    def __init__(self, word: str, nodes: list[int], free: int):
        """``nodes`` are those of the word's prefixes so far, the root included; ``free`` is the next number."""
        self.word, self.nodes, self.free = word, nodes, free

    def add(self, word: str) -> list[int]:
        known = len(commonprefix((self.word, word)))
        new = len(word) - known
        self.nodes = self.nodes[: known + 1] + list(range(self.free, self.free + new))
        self.word, self.free = word, self.free + new
        return self.nodes


def _sorted_slices(words: DataFrame, slices: int) -> DataFrame:
    """Words by range of their spelling, sorted, with the number of their slice; kept, so that slices stay as they are."""
    ranged = words.repartitionByRange(slices, "spelled").sortWithinPartitions("spelled")
    return cut(ranged.withColumn("slice", F.spark_partition_id()))


def trie_paths(words: DataFrame, slices: int) -> DataFrame:
    """(the other columns, nodes, rank): the trie nodes of every prefix of ``spelled``, from the empty one on.

    Words are sorted by range. A word makes the nodes beyond what it has in common with the word before, so a running
    number numbers the nodes of all words densely. Each slice first says how many nodes it makes and ends in which path;
    the driver adds these up, a path per slice, and tells each slice the number and the path it starts with. ``rank`` is
    the word's place among all.
    """
    ordered = _sorted_slices(words, slices)
    others = [c for c in words.columns if c != "spelled"]

    def summary(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, path, many, at = None, None, 0, 0
        for frame in frames:
            for at, word in zip(frame["slice"], frame["spelled"]):
                if first is None:
                    # Nodes of the first word have numbers below zero until it is known which the slice before made.
                    first, path = word, _Path(word, list(range(-len(word) - 1, 0)), 0)
                else:
                    path.add(word)
                many += 1
        if first is not None:
            yield pd.DataFrame({"slice": [at], "first": [first], "last": [path.word], "nodes": [path.nodes], "made": [path.free], "many": [many]})

    told = ordered.select("slice", "spelled").mapInPandas(
        summary, "slice int, first string, last string, nodes array<long>, made long, many long"
    )
    starts: dict[int, tuple[str, list[int], int, int]] = {}
    path, rank = _Path("", [0], 1), 0
    for row in sorted(told.collect(), key=lambda row: row["slice"]):
        known = len(commonprefix((path.word, row["first"])))
        starts[row["slice"]] = path.word[:known], path.nodes[: known + 1], path.free, rank
        own = path.add(row["first"])
        shift = path.free
        nodes = [own[node + len(row["first"]) + 1] if node < 0 else node + shift for node in row["nodes"]]
        path, rank = _Path(row["last"], nodes, shift + row["made"]), rank + row["many"]

    def number(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path, rank = None, 0
        for frame in frames:
            if path is None and len(frame):
                word, nodes, free, rank = starts[frame["slice"].iat[0]]
                path = _Path(word, nodes, free)
            found = [path.add(word) for word in frame["spelled"]]
            yield frame[others].assign(nodes=found, rank=range(rank, rank + len(found)))
            rank += len(found)

    kinds = ", ".join(f"`{c}` {kind}" for c, kind in ordered.select(*others).dtypes)
    return ordered.mapInPandas(number, f"{kinds}, nodes array<long>, rank long")


def numbered(words: DataFrame) -> DataFrame:
    """(id, word, n, ahead, behind): words by their place in code-point order, with the nodes of prefixes and suffixes."""
    words = cut(words)
    slices = -(-words.count() // SLICE) or 1
    forward = trie_paths(words.withColumn("spelled", F.col("word")), slices)
    forward = cut(forward.select(F.col("rank").alias("id"), "word", "n", F.col("nodes").alias("ahead")))
    behind = trie_paths(forward.select("id", F.reverse("word").alias("spelled")), slices)
    return forward.join(behind.select("id", F.col("nodes").alias("behind")), "id")


def node_pairs(words: DataFrame) -> DataFrame:
    """(ahead, behind, id, n, skips, fresh): all ways to leave out one letter of a word (skips), or none.

    A pair of nodes says the letters before and after a place, so a pair names one word at most that skips nothing, and
    as many that skip a letter as there are letters. ``fresh`` marks a skipped letter that differs from the one before
    it: of a run of equal letters only the first counts as the inserted one.
    """
    size = F.length("word")
    place = F.struct(
        F.col("ahead")[F.col("at")].alias("ahead"), F.col("behind")[size - F.col("at") - F.col("skipped")].alias("behind"),
        (F.col("skipped") == 1).alias("skips"),
        ((F.col("skipped") == 1) & ((F.col("at") == 0) | (F.expr("substr(word, at + 1, 1) <> substr(word, at, 1)")))).alias("fresh"),
    )
    at = words.withColumn("skipped", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("at", F.explode(F.sequence(F.lit(0), size - F.col("skipped"))))
    return at.select("id", "n", place.alias("place")).select("place.*", "id", "n")


def near_words(words: DataFrame) -> DataFrame:
    """(id, n_near, near): how many words differ by one letter, and the one of largest n, of equal ones the first.

    Words meet under the pair of nodes around the place where they differ, once per pair of words. No pair of words is made:
    a word has the count of those it meets and the greatest among them, before and after itself.
    """
    best = F.struct("n", (-F.col("id")).alias("order"))
    meet = Window.partitionBy("ahead", "behind").orderBy("id", "skips")
    before, after, all_rows = (meet.rowsBetween(a, b) for a, b in (
        (Window.unboundedPreceding, -1), (1, Window.unboundedFollowing), (Window.unboundedPreceding, Window.unboundedFollowing)
    ))
    skipping, plain, inserting = F.when(F.col("skips"), best), F.when(~F.col("skips"), best), F.when(F.col("fresh"), best)
    met = node_pairs(words).select(
        "id", "skips", "fresh",
        F.count(skipping).over(all_rows).alias("replaced"), F.greatest(F.max(skipping).over(before), F.max(skipping).over(after)).alias("by_replacing"),
        F.count(plain).over(all_rows).alias("shorter"), F.max(plain).over(all_rows).alias("by_deleting"),
        F.count(inserting).over(all_rows).alias("longer"), F.max(inserting).over(all_rows).alias("by_inserting"),
    )
    none = F.lit(0).cast("long")
    found = met.select(
        "id",
        F.when(F.col("skips"), F.col("replaced") - 1 + F.when(F.col("fresh"), F.col("shorter")).otherwise(none)).otherwise(F.col("longer")).alias("many"),
        F.when(F.col("skips"), F.greatest("by_replacing", F.when(F.col("fresh"), F.col("by_deleting")))).otherwise(F.col("by_inserting")).alias("best"),
    )
    near = found.where("many > 0").groupBy("id").agg(F.sum("many").alias("n_near"), F.max("best").alias("best"))
    return near.select("id", "n_near", (-F.col("best.order")).alias("near"), F.col("best.n").alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(id, root): the end of each word's chain of forms (id, form). A step at least doubles n, so chains are short."""
    links = cut(forms.select("id", F.col("form").alias("root")))
    while True:
        further = links.select(F.col("id").alias("root"), F.col("root").alias("next"))
        links = cut(links.join(further, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if links.where("moved").isEmpty():
            return links.select("id", "root")
        links = links.select("id", "root")


def variants(docs: DataFrame, shortest: int = 5, least: int = 3, every: int = 97, times: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every distinct word of docs (doc_id, text, ...).

    Words are runs of Latin letters, A-Z lower-cased. Two words are near if one letter inserted, deleted or replaced makes one
    the other. A word's form is its near word of largest n (ties: first in code-point order) if that n is at least
    ``times`` (two or more) its own; its root is the end of its forms. Rows count as often as they occur; a null text has no words,
    a null doc_id counts as empty. No words: no rows. Texts and words of any length are taken whole; only doc_id and
    text are read, so other columns may have any name.
    """
    words = cut(numbered(word_counts(docs, shortest, least, every)))
    near = near_words(words)
    known = cut(words.select("id", "word", "n").join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        *[F.when(F.col("near_n") >= times * F.col("n"), F.col(c)).alias(name) for c, name in (("near", "form"), ("near_n", "form_n"))],
    ))
    ends = roots(known.where("form IS NOT NULL").select("id", "form"))
    spelled = known.select(F.col("id").alias("form"), F.col("word").alias("form_word"))
    root = known.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    # Words without a form stay out of the joins on it: they would all meet under one null.
    formed = known.where("form IS NOT NULL").join(spelled, "form").join(ends, "id").join(root, "root")
    own = known.where("form IS NULL").select("word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", "form_n")
    return own.unionByName(formed.select("word", F.col("form_word").alias("form"), F.col("root_word").alias("root"), "n", "n_near", "form_n"))
