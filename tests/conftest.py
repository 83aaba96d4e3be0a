from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tweetflow.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = local_session(
        4, "6g", spark__sql__shuffle__partitions="4", spark__checkpoint__dir=str(folder),
        spark__sql__warehouse__dir=str(folder / "warehouse"),
    )
    yield session
    session.stop()


@pytest.fixture
def records(spark):
    """(key, value) records from Python objects or ready texts."""

    def make(*values, key=None):
        rows = [(key, value if isinstance(value, str) else json.dumps(value)) for value in values]
        return spark.createDataFrame(rows, "key string, value string")

    return make


def tweet(id, user="1", name="A", mentions=(), tags=(), fav=0, **more):
    """A raw tweet; fields given as None are left out."""
    fields = {
        "id": id,
        "id_str": str(id),
        "timestamp_ms": str(1_700_000_000_000 + id),
        "text": "text",
        "lang": "fr",
        "favorite_count": fav,
        "user": {"id": int(user), "id_str": user, "name": name, "screen_name": "s" + user},
        "entities": {"hashtags": [{"text": t} for t in tags], "user_mentions": [{"id_str": m} for m in mentions]},
    }
    if "media" in more:
        fields["entities"]["media"] = more.pop("media")
    fields.update(more)
    return {name: value for name, value in fields.items() if value is not None}


def rows(frame, *columns):
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(row) for row in picked.collect()), key=repr)
