"""Helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space, as Java, RE2 and bytes.split() read it.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut(frame: DataFrame) -> DataFrame:
    """The rows kept in the folder of spark.checkpoint.dir, without their lineage.

    Where the session names no folder, one beside the warehouse's tables is set.
    """
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        named = frame.sparkSession.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(named or frame.sparkSession.conf.get("spark.sql.warehouse.dir") + "/_checkpoints")
    return frame.checkpoint()


def beside(carry: list[str], own: str) -> list[Column]:
    """The fields of a struct `_kept` of carried columns; one named like one of an operator's own gets `_given` added."""
    return [F.col(f"_kept.`{name}`").alias(f"{name}_given" if name in own.split() else name) for name in carry]


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_digest(doc_id: Column, text: Column) -> Column:
    """Names a row by its id and its text; rows equal in both have the same name."""
    return F.unhex(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))))


def kept_rows(docs: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows of docs that `keep` retains of (row, ...), with the columns of docs."""
    return keep(docs.select(F.struct(*docs.columns).alias("row"))).select("row.*")
