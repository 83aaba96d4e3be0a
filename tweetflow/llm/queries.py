"""One query per operator over the whole given tables, and the SQL that checks those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tweetflow.llm import (
    decontaminate, divergence, embeddings, language, licenses, mixing, sharding, simhash, spelling, spotsigs, token_counts,
    toxicity, url_filter,
)
from tweetflow.llm.common import read
from tweetflow.session import shared_dir

RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
TOXIC_FROM = 0.7


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    allotted = mixing.allot(docs, carry=["doc_id"])
    return allotted.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"), RULES, ["page_id"])


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run starts with an empty cache of its own, so each distinct text is encoded in it."""
    model, cache = public_tokenizers.path("piece_bpe_32k.model"), shared_dir(spark, "token-counts")
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), model, cache, ["doc_id"])


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held = toxicity.held_out(F.col("doc_id"), 2, 4)
    samples = language.learn(docs.where(~held))
    return docs.select("doc_id", held.alias("held_out"), language.detect(F.col("text"), samples).alias("found")).select(
        "doc_id", "held_out", "found.lang_pred", "found.score"
    )


def op7_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compare_all(read(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.examine(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit(""))))
    return sharding.assign(docs, carry=["text_crc32"]).select(
        "doc_id", "size", "row.text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = toxicity.fit(toxicity.training_rows(docs), labels)
    found = docs.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"),
        toxicity.scored(F.col("text"), model, spark).alias("found"),
    )
    score = F.col("found.score")
    return found.select("doc_id", "held_out", score.alias("score"), (score >= TOXIC_FROM).cast("int").alias("predicted"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents"))


def op13_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(read(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        op1_mix_sources, op2_simhash, op3_url_filter, op4_token_counts, op5_license_scan, op6_language, op7_spotsigs,
        op8_decontaminate, op9_shards, op10_toxicity, op11_divergence, op12_spelling,
        op13_embeddings,
    )
    return {query.__name__: query for query in named}


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 6))::BIGINT % 256 AS salt
  FROM documents
), banded AS (
  SELECT *, CASE WHEN size < 64 THEN size ELSE length(bin(size)) * 64 + (size >> (length(bin(size)) - 6)) END AS band FROM sized
), placed AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM sized GROUP BY source
), capped AS (
  SELECT *, (place - 1) % 3 + 1 AS weight, source_size * 3 AS cap FROM placed
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER w, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0))::DOUBLE AS level
  FROM capped
  WINDOW w AS (ORDER BY cap::DOUBLE / weight::DOUBLE, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), shared AS (
  SELECT *, max(CASE WHEN level <= cap::DOUBLE / weight::DOUBLE THEN level END) OVER () AS common FROM levels
), targets AS (
  SELECT source, source_size, coalesce(least(cap::DOUBLE, common * weight), cap::DOUBLE) AS target,
    ('0x' || substr(md5('mix:' || coalesce(source, 'null:')), 1, 6))::BIGINT * 4 AS start
  FROM shared
), ranked AS (
  SELECT doc_id, size, source_size, target, start,
    CASE WHEN source_size > 0 THEN floor(target / source_size * 67108864 + 0.5)::BIGINT ELSE 0 END AS step,
    row_number() OVER (PARTITION BY b.source ORDER BY band, salt, size, doc_id NULLS FIRST) - 1 AS rank
  FROM banded b JOIN targets t ON b.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  (((start + step * (rank + 1)) >> 26) - ((start + step * rank) >> 26)) * size AS taken
FROM ranked
"""

URL_SQL = r"""
WITH parts AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*(/[^?#]*)', 1, 's'), '') AS path
  FROM pages
), rules(rule, rule_host, rule_path, verdict) AS (
  VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
    ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
), fitting AS (
  SELECT page_id, host, path, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
  FROM parts LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY ALL
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fitting
"""

_BLANK_LINES = r"regexp_replace(lower({0}), '(?m)^[^\n\p{{L}}(©]*(copyright|\(c\)|©)[^\n]*$', ' ', 'g')"


def _canonical_sql(text: str) -> str:
    canonical = "trim(regexp_replace(" + _BLANK_LINES.format(text) + r", '[^\p{L}\p{N}]+', ' ', 'g'))"
    for other, spelling in licenses.SPELLINGS.items():
        # Twice, as RE2 has no look-ahead and a space between two spellings serves one only.
        for _ in range(2):
            canonical = rf"regexp_replace({canonical}, '(^| ){other}( |$)', '\1{spelling}\2', 'g')"
    return canonical


LICENSE_SQL = f"""
WITH known(license_id, digest) AS (
  SELECT license_id, md5({_canonical_sql("notice")}) FROM (VALUES
    {", ".join(f"('{name}', '{text}')" for name, texts in licenses.NOTICES.items() for text in texts)}) v(license_id, notice)
), docs AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS row FROM documents
), lines AS (
  SELECT row, md5({_canonical_sql("line")}) AS digest FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM docs)
), found AS (
  SELECT row, count(*) AS n, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS names FROM lines JOIN known USING (digest) GROUP BY row
), whole AS (SELECT doc_id, row, md5({_canonical_sql("text")}) AS digest FROM docs)
SELECT doc_id, digest, license_id, coalesce(n, 0)::BIGINT AS n_license_lines, coalesce(names, '') AS line_licenses
FROM whole LEFT JOIN known USING (digest) LEFT JOIN found USING (row)
"""


DIVERGENCE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), in_docs AS (
  SELECT row, lang, source, term, count(*) AS n FROM (SELECT row, lang, source, unnest(terms) AS term FROM docs) GROUP BY ALL
), kept AS (
  SELECT lang, term, sum(n)::HUGEINT AS lang_n FROM in_docs GROUP BY ALL HAVING count(*) >= 10
), langs AS (
  SELECT lang, count(*)::HUGEINT AS terms, sum(lang_n)::HUGEINT AS lang_total FROM kept GROUP BY lang
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), cells AS (
  SELECT g.lang, g.source, term, lang_n, coalesce(c.n, 0)::HUGEINT AS n
  FROM groups g JOIN kept USING (lang)
  LEFT JOIN (SELECT lang, source, term, sum(n) AS n FROM in_docs GROUP BY ALL) c USING (lang, source, term)
), shares AS (
  SELECT lang, source, term, n,
    1 + 1000000000::HUGEINT * (n + 2) // (sum(n) OVER (PARTITION BY lang, source)::HUGEINT + 2 * terms) AS p,
    1 + 1000000000::HUGEINT * (lang_n + 2) // (lang_total + 2 * terms) AS q
  FROM cells JOIN langs USING (lang)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))::BIGINT AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), parts AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN pairs p ON p.lang = g.lang AND p.source = g.source AND p.item = h.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op11_divergence": DIVERGENCE_SQL, "op1_mix_sources": MIX_SQL, "op3_url_filter": URL_SQL, "op5_license_scan": LICENSE_SQL}
