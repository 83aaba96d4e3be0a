"""Declared schemas. Nothing is inferred from data."""

from __future__ import annotations

import json

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_LONG, _INT, _DOUBLE, _TEXT = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()

TWEET = _struct(
    id=_LONG,
    id_str=_TEXT,
    timestamp_ms=_TEXT,  # epoch millis as quoted text
    text=_TEXT,
    lang=_TEXT,
    favorite_count=_LONG,
    user=_struct(id=_LONG, id_str=_TEXT, name=_TEXT, screen_name=_TEXT),
    entities=_struct(
        hashtags=T.ArrayType(_struct(text=_TEXT)),
        user_mentions=T.ArrayType(_struct(id_str=_TEXT)),
        media=T.ArrayType(_struct(id_str=_TEXT, media_url=_TEXT)),
    ),
)

# The SQL feed declares nested objects as text and opens them by path later. timestamp_ms is quoted in
# the records, so it is read as text and cast.
SQL_TWEET = _struct(
    timestamp_ms=_TEXT,
    id=_LONG,
    text=_TEXT,
    favorite_count=_INT,
    user=_TEXT,
    entities=_TEXT,
    lang=_TEXT,
)

BID = _struct(timestamp=_LONG, id=_TEXT, advertiserId=_TEXT, clickProbability=_DOUBLE)
WIN = _struct(timestamp=_LONG, auctid=_TEXT, advertiserId=_TEXT, winPrice=_DOUBLE)

# Three fields beyond the declared bid columns, which order the bids that share an id and an instant.
BID_ORDER = ["timestamp", "seq_a", "seq_b", "seq_c"]
SEQUENCED_BID = T.StructType(BID.fields + [T.StructField(name, _LONG) for name in BID_ORDER[1:]])

USER_TOTALS = _struct(userID=_TEXT, count=_LONG, fav=_LONG, hashtags=_LONG, name=_TEXT, mentioned=_LONG)

# The typed user record: the counters are 32-bit.
USER_RECORD = _struct(userID=_TEXT, count=_INT, fav=_INT, hashtags=_INT, name=_TEXT, mentioned=_INT)

# The same record as an Avro schema; a user's first tweet may have no name.
USER_RECORD_AVRO = json.dumps(
    {
        "type": "record",
        "name": "user",
        "fields": [
            {"name": field.name, "type": "int" if field.dataType == _INT else "string"}
            if field.name != "name"
            else {"name": "name", "type": ["null", "string"], "default": None}
            for field in USER_RECORD.fields
        ],
    }
)


def subset(schema: T.StructType, names: list[str]) -> T.StructType:
    """The named top-level fields of a schema, in schema order."""
    return T.StructType([field for field in schema.fields if field.name in names])


def with_batch(schema: T.StructType) -> T.StructType:
    """A schema with the micro-batch that wrote each row."""
    return T.StructType([*schema.fields, T.StructField("batch_id", _LONG)])
