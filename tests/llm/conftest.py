from __future__ import annotations

import pytest

SF_DIR = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source)."""

    def make(*rows):
        full = [(i, t, *(rest or ("en", "a")), None if t is None else len(t)) for i, t, *rest in rows]
        return spark.createDataFrame(full, DOCS)

    return make


# Names that operators use for columns of their own.
CLASHES = (
    "row rank size band salt copies target fp mask own other component component_id uid sigs piece next_id edited range part "
    "key tie shard slot score n_words n_hit items spans content pick host path rule verdict digest label toxic u v"
).split()


@pytest.fixture
def clashing(docs):
    """The given documents with a column for every name an operator uses itself."""
    from pyspark.sql import functions as F

    def make(*rows):
        return docs(*rows).withColumns({name: F.lit("mine") for name in CLASHES})

    return make


def table(frame, *columns):
    return sorted((tuple(row) for row in (frame.select(*columns) if columns else frame).collect()), key=repr)
