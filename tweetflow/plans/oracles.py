"""DuckDB statements for the registered queries, written from the given tables without the JSON step."""

from __future__ import annotations

# Tweets as FIXTURES.md derives them.
_TWEETS = """
WITH docs AS (SELECT count(*) AS n FROM documents),
users AS (SELECT (max(user_id) + 1) * 4 // 3 AS mentionable FROM events),
base AS (
  SELECT e.*, d.text AS doc_text, d.lang AS doc_lang, users.mentionable,
         CAST(json_extract(e.props, '$.k') AS BIGINT) AS k
  FROM events e CROSS JOIN docs CROSS JOIN users JOIN documents d ON d.doc_id = e.event_id % docs.n
),
tweets AS (
  SELECT event_id, CAST(event_id AS VARCHAR) AS id_str, epoch_us(ts) // 1000 AS ms, event_type,
         CASE event_id % 7 WHEN 0 THEN 'Mario ' WHEN 1 THEN 'mario ' WHEN 2 THEN 'MARIO ' ELSE '' END || doc_text AS text,
         CASE WHEN event_id % 5 = 0 THEN upper(doc_lang) ELSE doc_lang END AS lang,
         CAST(floor(value) AS BIGINT) AS fav,
         CAST(user_id AS VARCHAR) AS uid, user_id,
         'User ' || user_id || ' v' || (event_id % 3) AS name,
         'u' || user_id || '_' || (event_id % 4) AS screen_name,
         [ 'tag' || ((k + i) % 10) for i in range(0, k % 4) ] AS tags,
         [ CAST(m AS VARCHAR) for m in [ (user_id * 7 + i * 13 + event_id) % mentionable for i in range(0, k % 3) ] if m % 10 <> 0 ] AS mentioned_ids,
         k % 2 + 1 AS n_media,
         strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%Y-%m-%d') AS day
  FROM base
),
mentions AS (SELECT event_id, day, unnest(mentioned_ids) AS uid FROM tweets),
user_table AS (
  SELECT uid, count(*) AS n, CAST(sum(fav) AS BIGINT) AS fav, CAST(sum(len(tags)) AS BIGINT) AS hashtags,
         arg_min(name, event_id) AS name
  FROM tweets GROUP BY uid
),
mentions_table AS (SELECT uid, count(*) AS mentioned FROM mentions GROUP BY uid),
totals AS (
  SELECT u.uid AS "userID", u.n AS "count", u.fav, u.hashtags, u.name, coalesce(m.mentioned, 0) AS mentioned
  FROM user_table u LEFT JOIN mentions_table m USING (uid)
),
transformed AS (
  SELECT uid AS "userID", CAST(1 AS BIGINT) AS "count", fav, CAST(len(tags) AS BIGINT) AS hashtags, name FROM tweets
),
mario AS (
  SELECT id_str AS id, uid AS user_id, name AS screen_name, day AS created_at, text,
         CASE WHEN event_type <> 'view' OR event_id % 11 = 0 THEN ''
              ELSE array_to_string([ '(' || (event_id * 10 + i) || ',http://media.example/' || event_id || '/' || i || '.jpg)' for i in range(0, n_media) ], ',')
         END AS medias,
         array_to_string(tags, ',') AS hashtags
  FROM tweets WHERE lower(lang) = 'fr' AND contains(upper(text), 'MARIO')
),
sql_json AS (
  SELECT *,
    '{"id":' || user_id || ',"id_str":"' || uid || '","name":"' || name || '","screen_name":"' || screen_name || '"}' AS user_json,
    '[' || array_to_string([ '{"text":"' || t || '"}' for t in tags ], ',') || ']' AS tags_json,
    '[' || array_to_string([ '{"id_str":"' || m || '"}' for m in mentioned_ids ], ',') || ']' AS mentions_json,
    '[' || array_to_string([ '{"id_str":"' || (event_id * 10 + i) || '"' ||
        CASE WHEN event_id % 11 = 0 THEN '' ELSE ',"media_url":"http://media.example/' || event_id || '/' || i || '.jpg"' END || '}'
        for i in range(0, n_media) ], ',') || ']' AS media_json
  FROM tweets
)
"""

_BIDS = """
WITH bids AS (
  SELECT epoch_us(l_shipdate) // 1000 AS "timestamp", CAST(l_orderkey AS VARCHAR) AS id, CAST(l_suppkey AS VARCHAR) AS "advertiserId",
         (CAST(round(l_discount * 100) AS INTEGER) - 3) / 100.0 AS cP, l_shipdate, l_linenumber, l_partkey, l_suppkey
  FROM lineitem
),
wins AS (
  SELECT epoch_us(o_orderdate) // 1000 AS "timestamp", CAST(o_orderkey AS VARCHAR) AS auctid,
         CAST(o_custkey AS VARCHAR) AS "advertiserId", o_totalprice AS "winPrice"
  FROM orders
),
last_bid AS (
  SELECT id, arg_max(cP, (l_shipdate, l_linenumber, l_partkey, l_suppkey)) AS cP FROM bids GROUP BY id
),
reco AS (SELECT w.auctid, w."winPrice", b.cP FROM wins w LEFT JOIN last_bid b ON w.auctid = b.id),
instants AS (
  SELECT id, "timestamp", arg_max(cP, (l_linenumber, l_partkey, l_suppkey)) AS cP FROM bids GROUP BY id, "timestamp"
),
reco_asof AS (
  SELECT w.auctid, w."winPrice", b.cP
  FROM wins w ASOF LEFT JOIN instants b ON w.auctid = b.id AND w."timestamp" >= b."timestamp"
)
"""

_TOTALS = _TWEETS + "SELECT * FROM totals"
_ASOF = _BIDS + "SELECT * FROM reco_asof"

_CHANGELOG = _TWEETS + """,
deltas AS (
  SELECT uid, day, 1 AS n, fav, len(tags) AS hashtags, 0 AS mentioned, event_id AS ord, name FROM tweets
  UNION ALL SELECT uid, day, 0, 0, 0, 1, NULL, NULL FROM mentions
),
per_day AS (
  SELECT uid, day, sum(n) AS n, sum(fav) AS fav, sum(hashtags) AS hashtags, sum(mentioned) AS mentioned FROM deltas GROUP BY uid, day
),
running AS (
  SELECT uid, day, CAST(sum(n) OVER w AS BIGINT) AS n, CAST(sum(fav) OVER w AS BIGINT) AS fav,
         CAST(sum(hashtags) OVER w AS BIGINT) AS hashtags, CAST(sum(mentioned) OVER w AS BIGINT) AS mentioned
  FROM per_day WINDOW w AS (PARTITION BY uid ORDER BY day)
),
named AS (
  SELECT r.uid, r.day, arg_min(t.name, t.event_id) AS name
  FROM running r JOIN tweets t ON t.uid = r.uid AND t.day <= r.day GROUP BY r.uid, r.day
)
SELECT r.day AS bucket, r.uid AS "userID", r.n AS "count", r.fav, r.hashtags, n.name, r.mentioned
FROM running r JOIN named n ON n.uid = r.uid AND n.day = r.day WHERE r.n > 0
"""


def _json_object(columns: dict[str, str]) -> str:
    return "to_json({" + ", ".join(f"'{name}': {column}" for name, column in columns.items()) + "})"


def _keyed(source: str, key: str, columns: list[str]) -> str:
    value = _json_object({c: f'"{c}"' for c in columns})
    return _TWEETS + f"SELECT {key} AS key, CAST({value} AS VARCHAR) AS value FROM {source}"


_TOTAL_COLUMNS = ["userID", "count", "fav", "hashtags", "name", "mentioned"]
_MARIO_COLUMNS = ["id", "user_id", "screen_name", "created_at", "text", "medias", "hashtags"]


def oracle_sql() -> dict[str, str]:
    entities = """'{"hashtags":' || tags_json || ',"user_mentions":' || mentions_json ||
        CASE WHEN event_type = 'view' THEN ',"media":' || media_json ELSE '' END || '}'"""
    count = _TWEETS + 'SELECT uid AS userid, count(*) AS "count" FROM tweets GROUP BY uid'
    names = "SELECT uid, screen_name, row_number() OVER (PARTITION BY uid ORDER BY screen_name DESC) AS r FROM tweets"
    int_max = 2147483647
    typed = (
        _TWEETS
        + 'SELECT "userID", '
        + ", ".join(f'CAST(least("{c}", {int_max}) AS INTEGER) AS "{c}"' for c in ("count", "fav", "hashtags", "mentioned"))
        + ", name FROM totals"
    )
    batch = {
        "tweet_transformed": _TWEETS + "SELECT * FROM transformed",
        "user_mentions": _TWEETS + 'SELECT uid AS "userID", CAST(1 AS BIGINT) AS mentioned FROM mentions',
        "user_table": _TWEETS + 'SELECT uid AS "userID", n AS "count", fav, hashtags, name FROM user_table',
        "mentions_table": _TWEETS + 'SELECT uid AS "userID", mentioned FROM mentions_table',
        "reconciliation": _TOTALS,
        "reconciliation_union": _TOTALS,
        "mario_fr": _TWEETS + "SELECT * FROM mario",
        "avro_user_records": typed,
        "keyed_json_transformed": _keyed("transformed", '"userID"', _TOTAL_COLUMNS[:-1]),
        "keyed_json_reconciliation": _keyed("totals", '"userID"', _TOTAL_COLUMNS),
        "keyed_json_mario": _keyed("mario", "CAST(NULL AS VARCHAR)", _MARIO_COLUMNS),
        "keyed_json_roundtrip": _TOTALS,
        "file_sink_roundtrip": typed,
        "user_lookup": _TOTALS + " WHERE \"userID\" = '7'",
        "changelog_by_interval": _CHANGELOG,
        "changelog_to_table": _TOTALS,
        "ksql_tweets_raw": _TWEETS
        + f"""SELECT ms AS timestamp_ms, event_id AS id, text, CAST(fav AS INTEGER) AS favorite_count,
              user_json AS "user", {entities} AS entities, lang FROM sql_json""",
        "ksql_tweets_transformed": _TWEETS
        + """SELECT day AS created_at, event_id AS id, text, CAST(fav AS INTEGER) AS fav, uid AS user_id, name AS user_name,
             screen_name AS user_screen_name, tags_json AS hashtags, mentions_json AS user_mentions, lang FROM sql_json""",
        "ksql_mario_fr": _TWEETS
        + """SELECT event_id AS id, uid AS user_id, screen_name, day AS created_at, tags_json AS hashtags, text
             FROM sql_json WHERE text LIKE '%mario%' AND lang = 'fr'""",
        "userid_count": count,
        "userid_fav": _TWEETS + "SELECT uid AS userid, CAST(sum(fav) AS BIGINT) AS fav FROM tweets GROUP BY uid",
        "userid_name_top1": _TWEETS + "SELECT uid AS userid, max(screen_name) AS name FROM tweets GROUP BY uid",
        "userid_name_top3": _TWEETS
        + f"SELECT uid AS userid, string_agg(screen_name, ',' ORDER BY r) AS name FROM ({names}) WHERE r <= 3 GROUP BY uid",
        "ctas_overwrite": count,
        "bid_raw": _BIDS + 'SELECT "timestamp", id, "advertiserId", cP AS "clickProbability" FROM bids',
        "win_raw": _BIDS + "SELECT * FROM wins",
        "bid_proper_key": _BIDS + "SELECT id, cP FROM bids",
        "win_proper_key": _BIDS + 'SELECT auctid, "winPrice" FROM wins',
        "tbid_latest_by_key": _BIDS + "SELECT * FROM last_bid",
        "reco": _BIDS + "SELECT * FROM reco",
        "reco_copartitioned": _BIDS + "SELECT * FROM reco",
        "reco_valid": _BIDS + "SELECT * FROM reco WHERE cP >= 0",
        "reco_asof": _ASOF,
        "stream_replay_rows": _TWEETS + "SELECT id_str FROM tweets",
        "stream_replay_twice": f"""
            SELECT "userID", 2 * count AS count, 2 * fav AS fav, 2 * hashtags AS hashtags, name, 2 * mentioned AS mentioned
            FROM ({_TOTALS}) AS once""",
        "stream_reconciliation": _TOTALS,
        "upsert_snapshot": _TOTALS,
        "stream_fanout_counts": _TWEETS
        + """SELECT 'transformed' AS branch, count(*) AS n FROM transformed UNION ALL
             SELECT 'mario', count(*) FROM mario UNION ALL SELECT 'reconciliation', count(*) FROM totals""",
        "stream_reco": _ASOF,
        "stream_state_bids": _BIDS + "SELECT * FROM last_bid",
        "stream_transformed": _keyed("transformed", '"userID"', _TOTAL_COLUMNS[:-1]),
        "stream_mario": _keyed("mario", "CAST(NULL AS VARCHAR)", _MARIO_COLUMNS),
        "stream_typed": typed,
        "rejected_by_reason": """
            SELECT CASE WHEN event_id % 97 <> 0 THEN CAST(event_id AS VARCHAR) END AS id_str,
              CASE WHEN event_id % 97 = 0 THEN 'malformed' ELSE 'incomplete' END AS reason
            FROM events WHERE event_id % 97 = 0 OR event_id % 89 = 0""",
    }
    # Streams that end at the rows of a batch query.
    same = {
        "stream_ksql_mario_fr": "ksql_mario_fr", "stream_userid_count": "userid_count", "stream_userid_fav": "userid_fav",
        "stream_userid_name_top1": "userid_name_top1", "stream_userid_name_top3": "userid_name_top3",
        "stream_state_totals": "reconciliation", "stream_compacted": "reconciliation",
        "stream_export": "tweet_transformed", "stream_rejected": "rejected_by_reason",
    }
    return batch | {stream: batch[name] for stream, name in same.items()}
