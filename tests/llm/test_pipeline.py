"""The pipeline's stages against brute force, and the registration."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import duckdb
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check import TABLES, rows_of
from llm import brute
from llm.conftest import CLASHES, SF_DIR, table
from tweetflow.llm import queries, toxicity
from tweetflow.llm.common import read

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_agree_with_their_sql(spark, name):
    db = duckdb.connect()
    for one in TABLES.split():
        db.execute(f"CREATE VIEW {one} AS SELECT * FROM '{SF_DIR}/{one}.parquet'")
    got = queries.queries()[name](spark, SF_DIR).toArrow()
    assert rows_of(got) == rows_of(db.execute(queries.oracle_sql()[name]).to_arrow_table())


def test_every_stage_against_brute_force(spark):
    docs = read(spark, SF_DIR, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [row.asDict() for row in docs.collect()]
        docs = spark.createDataFrame(stage(spark, docs, SF_DIR).collect() or [], schema=stage(spark, docs, SF_DIR).schema)
        after = [row.asDict() for row in docs.collect()]
        kept[name] = (before, after)
        assert docs.columns[: len(COLUMNS)] == COLUMNS and (name == "shard" or docs.columns == COLUMNS)

    def ids(rows):
        return sorted(row["doc_id"] for row in rows)

    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{SF_DIR}/labels.parquet").to_pylist()}
    before, after = kept["toxicity"]
    gone = set(ids(before)) - set(ids(after))
    assert gone and not any(labels.get(i) == 0 for i in gone)

    before, after = kept["simhash"]
    before.sort(key=lambda row: row["doc_id"])
    root = brute.components([brute.simhash(row["text"]) for row in before], lambda a, b: (a ^ b).bit_count() <= 3)
    assert ids(after) == [before[i]["doc_id"] for i in sorted(set(root))]

    before, after = kept["decontaminate"]
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF_DIR}/benchmark.parquet").to_pylist()]
    hits = brute.contamination([row["text"] for row in before], items)
    assert ids(after) == sorted(row["doc_id"] for row, (_, hit, _) in zip(before, hits) if not hit) and len(after) < len(before)

    before, after = kept["mix"]
    whole = {row["doc_id"]: row for row in before}
    assert all(whole[row["doc_id"]] == row for row in after) and max(map(ids(after).count, set(ids(after)))) <= 3

    before, after = kept["shard"]
    assert ids(before) == ids(after) and len({(row["shard"], row["slot"]) for row in after}) == len(after)
    assert {row["shard"] for row in after} == set(range(corpus_pipeline.SHARDS))


def test_run_gives_the_rows_of_the_stages(spark, tmp_path, docs):
    folder = str(tmp_path)
    read(spark, SF_DIR, "documents").where("doc_id < 150").write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        read(spark, SF_DIR, name).write.parquet(f"{folder}/{name}.parquet")
    found = corpus_pipeline.run(spark, folder)
    by_hand = read(spark, folder, "documents")
    for _, stage in corpus_pipeline.STAGES:
        by_hand = stage(spark, by_hand, folder)
    assert table(found) == table(by_hand) and found.count() > 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_cases(spark, docs, clashing, name, stage):
    """No rows, and null, empty, repeated rows with columns of clashing names."""
    assert stage(spark, docs(), SF_DIR).count() == 0
    given = clashing((1, "Some words"), (1, "Some words"), (2, None), (3, ""), (None, "A text", None, None), (4, "other " * 9000))
    found = stage(spark, given.drop("shard", "slot") if name == "shard" else given, SF_DIR)
    kept = found.select("doc_id").distinct().count()
    assert kept >= (1 if name == "mix" else 3) and set(CLASHES) - {"shard", "slot"} < set(found.columns)


def test_scores_do_not_see_ids(spark, docs):
    clean, toxic = toxicity.Extremes(0.1, 0.0, 0.25), toxicity.Extremes(0.9, 2.0, 0.5)
    model = toxicity.Model(toxicity.Weights({"vile": (5.0, 9.0)}), clean, toxic, 0.1)
    scores = docs((1, "so vile"), (999, "so vile"), (None, "so vile")).select(toxicity.scored(F.col("text"), model, spark)["score"].alias("s"))
    assert scores.distinct().count() == 1


def test_the_library_works_without_this_package(tmp_path):
    """As the driver does it: the rest copied elsewhere imports and registers its own queries."""
    root = Path(__file__).resolve().parents[2]
    for part in ("tweetflow", "__spark_entry__.py", "check.py"):
        subprocess.run(["cp", "-r", str(root / part), str(tmp_path)], check=True)
    import shutil

    shutil.rmtree(tmp_path / "tweetflow" / "llm")
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), len(e.oracle_sql()), any(k.startswith('op1_') or k == 'pipeline' for k in q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"})
    assert done.returncode == 0 and done.stdout.split()[2] == "False", done.stderr
