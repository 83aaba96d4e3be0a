"""Language by cross-parsing: how few phrases of a language's sample a text breaks into."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The sample a language is learned from: so many labelled rows, so many characters of each.
SAMPLE_ROWS, SAMPLE_CHARS = 32, 1024
# Symbol 0 is anything but letters; the commonest letters have symbols of their own, others share the last ones.
SYMBOLS, SHARED = 64, 8
# Texts are parsed in blocks of so many symbols, so many blocks side by side. No phrase crosses a block's end.
BLOCK, LANES = 1024, 8192
UNDETERMINED = "und"


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Which code points are letters, and each one's lower case where that is one letter."""
    is_letter, lower = np.zeros(0x110000, bool), np.arange(0x110000, dtype=np.uint32)
    for point in range(0x110000):
        if (char := chr(point)).isalpha():
            is_letter[point] = True
            if len(small := char.lower()) == 1:
                lower[point] = ord(small)
    return is_letter, lower


class Automaton:
    """Suffix automata of one sample per language, their transitions in one table. State 0: no such substring."""

    def __init__(self, samples: tuple[tuple[str, tuple[str, ...]], ...]):
        self.langs = [lang for lang, _ in samples]
        is_letter, lower = _letters()
        seen = Counter()
        for _, texts in samples:
            points = lower[code_points("".join(texts))]
            seen.update(points[is_letter[points]].tolist())
        own = [point for point, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[: SYMBOLS - 1 - SHARED]]
        symbol = np.where(is_letter, SYMBOLS - SHARED + np.arange(0x110000) % SHARED, 0).astype(np.uint8)
        symbol[own] = np.arange(1, len(own) + 1)
        self.symbol = symbol[lower]
        tables, self.roots, self.bits, offset = [np.zeros((1, SYMBOLS), np.int32)], [], [], 1
        for _, texts in samples:
            symbols = self.symbols(code_points(" ".join(texts)))
            table = self.build(symbols.tolist())
            tables.append(np.where(table >= 0, table + offset, 0).astype(np.int32))
            self.roots.append(offset)
            self.bits.append(np.log2(len(symbols) + 2))
            offset += len(table)
        self.table = np.concatenate(tables)
        # A symbol that is not in a sample is a phrase of its own: from state 0 every symbol starts another.
        self.restart = np.ascontiguousarray(self.table[self.roots].T)
        self.flat = self.table.ravel()

    def symbols(self, points: np.ndarray) -> np.ndarray:
        """A run of anything but letters is one symbol."""
        symbols = self.symbol[points]
        return symbols[(symbols > 0) | np.r_[True, symbols[:-1] > 0]] if len(symbols) else symbols

    @staticmethod
    def build(symbols: list[int]) -> np.ndarray:
        """The suffix automaton's transitions, -1 where there is none (Blumer et al. 1985)."""
        go, link, length, last = [{}], [-1], [0], 0
        for symbol in symbols:
            new = len(go)
            go.append({})
            link.append(0)
            length.append(length[last] + 1)
            at = last
            while at >= 0 and symbol not in go[at]:
                go[at][symbol] = new
                at = link[at]
            if at >= 0:
                into = go[at][symbol]
                if length[into] != length[at] + 1:
                    # The longer strings of `into` part from those that also end here.
                    go.append(dict(go[into]))
                    link.append(link[into])
                    length.append(length[at] + 1)
                    copy = len(go) - 1
                    while at >= 0 and go[at].get(symbol) == into:
                        go[at][symbol] = copy
                        at = link[at]
                    link[into] = copy
                    into = copy
                link[new] = into
            last = new
        table = np.full((len(go), SYMBOLS), -1, np.int32)
        for state, moves in enumerate(go):
            for symbol, into in moves.items():
                table[state, symbol] = into
        return table

    def phrases(self, blocks: list[np.ndarray]) -> np.ndarray:
        """For each block and language the number of longest matches the block breaks into."""
        counts = np.zeros((len(blocks), len(self.langs)), np.int64)
        order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
        for at in range(0, len(order), LANES):
            part = order[at : at + LANES]
            longest, many = len(blocks[part[0]]), len(part)
            matrix = np.zeros((longest, many), np.uint8)
            lengths = np.array([len(blocks[i]) for i in part])
            for lane, i in enumerate(part):
                matrix[: lengths[lane], lane] = blocks[i]
            active = np.searchsorted(-lengths, -np.arange(longest), side="left")
            state = np.zeros((many, len(self.langs)), np.int32)
            found = np.zeros_like(state)
            for step in range(longest):
                n = active[step]
                symbols = matrix[step, :n].astype(np.int32)
                into = self.flat[state[:n] * SYMBOLS + symbols[:, None]]
                ended = into == 0
                found[:n] += ended
                state[:n] = np.where(ended, self.restart[symbols], into)
            counts[part] = found
        return counts

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        blocks, owner, lettered = [], [], np.zeros(len(texts), bool)
        for i, text in enumerate(texts):
            symbols = self.symbols(code_points(text)) if text else np.zeros(0, np.uint8)
            lettered[i] = bool((symbols > 0).any())
            if lettered[i]:
                blocks += [symbols[at : at + BLOCK] for at in range(0, len(symbols), BLOCK)]
                owner += [i] * -(-len(symbols) // BLOCK)
        cost = np.zeros((len(texts), len(self.langs)))
        if blocks and self.langs:
            np.add.at(cost, owner, self.phrases(blocks) * np.array(self.bits))
        langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        for i in np.flatnonzero(lettered) if self.langs else ():
            best = int(cost[i].argmin())
            other = np.delete(cost[i], best)
            langs[i] = self.langs[best]
            scores[i] = float(other.min() / (other.min() + cost[i, best])) if len(other) else 1.0
        return langs, scores


@lru_cache(maxsize=2)
def _automaton(samples: tuple) -> Automaton:
    return Automaton(samples)


def learn(rows: DataFrame, sample_rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> tuple:
    """((language, texts), ...) from labelled rows (doc_id, text, lang); others are left out by the caller.

    A language's sample is `sample_rows` rows in the order of a hash of the id, longer ones first in line, and
    `chars` characters of each. Ranks are cut to that many rows before the shuffle. The bound on the model is these
    two times the number of languages; it does not follow the input.
    """
    first = Window.partitionBy("lang").orderBy(F.length("text") < 200, F.xxhash64("doc_id"), "text")
    sample = (
        rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
        .select("lang", F.substring("text", 1, chars).alias("text"), "doc_id")
        .withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= sample_rows)
    )
    found: dict[str, list[str]] = {}
    for row in sample.select("lang", "rank", "text").orderBy("lang", "rank").collect():
        found.setdefault(row["lang"], []).append(row["text"])
    return tuple((lang, tuple(texts)) for lang, texts in found.items())


def detect(text: Column, samples: tuple) -> Column:
    """struct(lang_pred, score) of a text.

    Each language has a suffix automaton of its sample. The text is read from the left, each time as far as it
    occurs in the sample; the number of such phrases, each at the cost of a position in the sample in bits, is the
    cross-parsing entropy, and the language of least cost is returned. score: the next best cost as a share of both, 0.5 to
    1. Null texts and texts without a letter, or no learned language: "und" with score 0. Ties go to the first
    language by name. The whole text is parsed; memory is bounded by the Arrow batch.
    """

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = _automaton(samples)
        for batch in batches:
            langs, scores = automaton.predict(list(batch))
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    return F.pandas_udf(of, "lang_pred string, score double")(text)
