"""Near-duplicate vectors by passes over sorted random projections."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tweetflow.llm.common import cut
from tweetflow.llm.components import connected
from tweetflow.llm.simhash import unite

SEED = 13
# Passes, random hashes of a pass' key, and neighbours after each vector that it is compared with.
PASSES, HASHES, WINDOW = 8, 4, 256
# Vectors of one task of a pass, and vectors compared at once.
SLICE, BLOCK = 1 << 17, 256


@lru_cache(maxsize=64)
def _rotation(dim: int, at: int, turn: int) -> np.ndarray:
    """A random rotation, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([SEED, dim, at, turn]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def projections(unit: np.ndarray, passes: int, hashes: int) -> list[list[bytes]]:
    """Per vector and pass a key: the concatenated hashes, each the axis (and its sign) that a random rotation brings the vector nearest to."""
    keys = np.empty((len(unit), passes, hashes), ">u4")
    for at in range(passes):
        for turn in range(hashes):
            turned = unit @ _rotation(unit.shape[1], at, turn)
            axis = np.abs(turned).argmax(axis=1)
            keys[:, at, turn] = 2 * axis + (turned[np.arange(len(unit)), axis] < 0)
    return [[key.tobytes() for key in row] for row in keys]


def _units(packed: pd.Series, kind: str) -> np.ndarray:
    """Vectors of one length, scaled to length 1 in double precision; by the largest component first, so that no square overflows."""
    rows = np.frombuffer(b"".join(packed), kind).reshape(len(packed), -1).astype("f8")
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def packing(vectors: DataFrame) -> str:
    """How components are packed: as they come if they are floats, else in double precision."""
    kind = vectors.schema["embedding"].dataType
    return "<f4" if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else "<f8"


def packed(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec): components as bytes; null for a vector that links with nothing.

    That is a null, empty or zero one, or one with a null or non-finite component.
    """
    kind = packing(vectors)

    def pack(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(vector) -> bytes | None:
            if vector is None or not len(vector):
                return None
            # Adding zero makes a negative zero one like any other.
            values = np.array([np.nan if x is None else x for x in vector], kind) + np.array(0, kind)
            return values.tobytes() if np.isfinite(values).all() and values.any() else None

        for batch in batches:
            yield batch.map(one).astype(object)

    udf = F.pandas_udf(pack, T.BinaryType())
    return vectors.select("vec_id", udf(F.col("embedding") if kind == "<f4" else F.col("embedding").cast("array<double>")).alias("vec"))


class _Window:
    """The last vectors of a sorted pass, which the next ones are compared with."""

    def __init__(self, window: int, least: float):
        self.window, self.least, self.of = window, least, None

    def start(self, of: tuple, dim: int) -> None:
        if self.of != of:
            self.of, self.ids, self.units = of, np.empty(0, np.int64), np.empty((0, dim))

    def links(self, ids: np.ndarray, units: np.ndarray) -> pd.DataFrame:
        """Links that join what the pairs at or above the least cosine join, one per vector at most.

        The pairs are those of each given vector with the ones before it in the window.
        """
        all_ids, all_units, known = np.r_[self.ids, ids], np.r_[self.units, units], len(self.ids)
        left, right = [], []
        for at in range(known, len(all_ids), BLOCK):
            end, first = min(at + BLOCK, len(all_ids)), max(0, at - self.window)
            i, j = np.nonzero(all_units[at:end] @ all_units[first:end].T >= self.least)
            i, j = i + at, j + first
            near = (j < i) & (i - j <= self.window)
            left.append(i[near])
            right.append(j[near])
        label = np.arange(len(all_ids))
        if left:
            label = unite(label, np.concatenate(left), np.concatenate(right))
        joined = np.flatnonzero(label != np.arange(len(label)))
        self.ids, self.units = all_ids[-self.window :], all_units[-self.window :]
        return pd.DataFrame({"u": all_ids[joined], "v": all_ids[label[joined]]})


def _parts(rows: pd.DataFrame) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """Runs of rows of one pass and length of vector."""
    edge = (rows[["dim", "pass"]].diff() != 0).any(axis=1).to_numpy().nonzero()[0]
    for at, end in zip(edge, [*edge[1:], len(rows)]):
        part = rows.iloc[at:end]
        yield (int(part["dim"].iat[0]), int(part["pass"].iat[0])), part


def near_links(
    classes: DataFrame, kind: str, least: float = 0.95, passes: int = PASSES, window: int = WINDOW, hashes: int = HASHES
) -> DataFrame:
    """Links (u, v) that join classes (id, vec) as all pairs found with a cosine of ``least`` or more do.

    Every pass orders the vectors by a key of its own and compares each with the ``window`` ones after it. All
    passes are one range sort of (length, pass, key, id); a task walks its range with the last vectors in hand. Where a range
    ends the walk is taken up by comparing its last vectors with the first of the next range.
    """
    width = np.dtype(kind).itemsize

    def keyed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dim, rows in frame.groupby(frame["vec"].map(len) // width):
                for at in range(0, len(rows), 1024):
                    part = rows.iloc[at : at + 1024]
                    keys = projections(_units(part["vec"], kind), passes, hashes)
                    for turn in range(passes):
                        yield pd.DataFrame({"dim": dim, "pass": turn, "key": [key[turn] for key in keys], "id": part["id"], "vec": part["vec"]})

    slices = -(-classes.count() * passes // SLICE) or 1
    sorting = classes.mapInPandas(keyed, "dim int, pass int, key binary, id long, vec binary")
    ranged = sorting.repartitionByRange(slices, "dim", "pass", "key", "id").sortWithinPartitions("dim", "pass", "key", "id")
    ranged = ranged.withColumn("slice", F.spark_partition_id())
    columns = ["u", "v", "border", "dim", "pass", "key", "id", "vec"]

    def found(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.reindex(columns=columns).astype({c: "Int64" for c in columns if c not in ("key", "vec")})

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, head, tail, missing, at = _Window(window, least), [], None, window, 0
        for frame in frames:
            if not len(frame):
                continue
            at = int(frame["slice"].iat[0])
            for of, part in _parts(frame):
                held.start(of, of[0])
                for first in range(0, len(part), 4 * BLOCK):
                    rows = part.iloc[first : first + 4 * BLOCK]
                    yield found(held.links(rows["id"].to_numpy(), _units(rows["vec"], kind)))
            if missing > 0:
                head.append(frame.iloc[:missing])
                missing -= len(frame)
            tail = (frame if tail is None else pd.concat([tail, frame])).iloc[-window:]
        # Both ends of the range, for the walk from each range into the next one.
        if tail is not None:
            yield found(pd.concat(head).assign(border=at - 1))
            yield found(tail.assign(border=at))

    walked = cut(ranged.mapInPandas(walk, "u long, v long, border int, dim int, pass int, key binary, id long, vec binary"))

    def cross(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["dim", "pass", "key", "id"], ignore_index=True)
        held, joined = _Window(window, least), []
        for of, part in _parts(rows):
            held.start(of, of[0])
            joined.append(held.links(part["id"].to_numpy(), _units(part["vec"], kind)))
        return pd.concat(joined)

    inside = walked.where("border IS NULL").select("u", "v")
    edges = walked.where("border IS NOT NULL").select("border", "dim", "pass", "key", "id", "vec")
    return inside.unionByName(edges.groupBy("border").applyInPandas(cross, "u long, v long"))


def links_within(members: DataFrame, kind: str, least: float = 0.95) -> DataFrame:
    """(id, others): the rows of other classes of its component that a class (id, root, vec, many) is linked with.

    Windows are bounded, so a class in the midst of more near copies than a window holds has met some only. Components are
    compared whole here: cut into parts by id, each pair of parts in a task of its own, of which counts come back and
    no pairs. Small components share tasks.
    """
    sizes = members.groupBy("root").agg(F.count("*").alias("size"))
    tasks = F.lit(max(1, members.count() // (4 * BLOCK)))
    parts = F.ceil(F.col("size") / F.lit(2 * BLOCK)).cast("int")
    sized = members.join(sizes, "root").withColumn("parts", parts).withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    met = sized.withColumn("met", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        F.when(F.col("parts") > 1, F.col("root")).otherwise(-1 - F.pmod(F.xxhash64("root"), tasks)).alias("task"),
        F.least("own", "met").alias("low"), F.greatest("own", "met").alias("high"), "own", "root", "id", "many", "vec",
    )

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        ids, others = [], []
        low, high = rows["low"].iat[0], rows["high"].iat[0]
        for _, part in rows.groupby(["root", rows["vec"].map(len)], sort=False):
            unit, many, own = _units(part["vec"], kind), part["many"].to_numpy(), part["own"].to_numpy()
            left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
            near = unit[left] @ unit[right].T >= least
            if low == high:
                np.fill_diagonal(near, False)
            else:
                ids.append(part["id"].to_numpy()[right])
                others.append(many[left] @ near)
            ids.append(part["id"].to_numpy()[left])
            others.append(near @ many[right])
        return pd.DataFrame({"id": np.concatenate(ids), "others": np.concatenate(others)})

    counted = met.groupBy("task", "low", "high").applyInPandas(compare, "id long, others long")
    return counted.groupBy("id").agg(F.sum("others").alias("others"))


def near_duplicates(
    vectors: DataFrame, least: float = 0.95, passes: int = PASSES, window: int = WINDOW, hashes: int = HASHES
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of vectors (vec_id, embedding, ...).

    Rows link if their cosine is ``least`` or more and links that the passes find join them; ``n_links`` counts the other rows
    linked directly, ``component_id`` is the least vec_id that links reach. Equal vectors are one class, compared once: all
    its rows link with each other and share their links. Vectors of different lengths do not link. A null, empty or zero
    vector, or one with a null or non-finite component, links with nothing and is its own component. A null vec_id names a
    component only where all its ids are null; rows that share a vec_id are rows of their own. No rows: no rows. Only vec_id
    and embedding are read, so other columns may have any name.
    """
    kind = packing(vectors)
    rows = cut(packed(vectors).withColumn("digest", F.unhex(F.sha2("vec", 256))))
    classes = rows.where("vec IS NOT NULL").groupBy("digest").agg(
        F.first("vec").alias("vec"), F.count("*").alias("many"), F.min("vec_id").alias("least_id")
    )
    classes = cut(classes.withColumn("id", F.monotonically_increasing_id()))
    root = connected(near_links(classes.select("id", "vec"), kind, least, passes, window, hashes))
    root = root.select(F.col("u").alias("id"), F.col("v").alias("root"))
    joined = cut(root.unionByName(root.select(F.col("root").alias("id"), "root").distinct()))
    linked = links_within(joined.join(classes.select("id", "vec", "many"), "id"), kind, least)

    rooted = classes.select("id", "digest", "many", "least_id").join(linked, "id", "left").join(joined, "id", "left")
    rooted = cut(rooted.withColumn("root", F.coalesce("root", "id")))
    named = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    told = rooted.join(named, "root").select(
        "digest", "component_id", (F.col("many") - 1 + F.coalesce("others", F.lit(0).cast("long"))).alias("n_links")
    )
    alone = rows.where("vec IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    together = rows.where("vec IS NOT NULL").join(told, "digest").select("vec_id", "n_links", "component_id")
    return alone.unionByName(together).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
