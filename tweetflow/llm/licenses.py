"""Licence texts found by digests of their canonical form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tweetflow.llm.common import row_digest

# Licence notices as they are commonly given, and spellings that mean the same.
NOTICES = {
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0."],
    "CC0-1.0": ["Released under CC0 1.0 Universal."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3."],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0."],
    "MIT": ["Released under the MIT License."],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License."],
    "MPL-2.0": ["Licensed under the Mozilla Public License, Version 2.0."],
}
SPELLINGS = {
    "licence": "license", "licenced": "licensed", "sublicence": "sublicense", "noncommercial": "non commercial",
    "merchantibility": "merchantability", "organisation": "organization", "recognised": "recognized", "v2": "version 2",
    "v3": "version 3", "gnu gpl": "gnu general public license", "gnu lgpl": "gnu lesser general public license",
}


def canonical(text: Column) -> Column:
    """Lower case, without copyright lines and punctuation, one spelling, single spaces."""
    text = F.lower(F.coalesce(text, F.lit("")))
    text = F.regexp_replace(text, r"(?m)^[^\n\p{L}(©]*(copyright|\(c\)|©)[^\n]*$", " ")
    text = F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " "))
    any_other = rf"(^| )({'|'.join(SPELLINGS)})( |$)"

    def respelled(text: Column) -> Column:
        for other, spelling in SPELLINGS.items():
            text = F.regexp_replace(text, rf"(^| ){other}(?= |$)", f"$1{spelling}")
        return text

    # Few texts have another spelling. As a lambda's argument the text is computed once.
    return F.get(F.transform(F.array(text), lambda t: F.when(t.rlike(any_other), respelled(t)).otherwise(t)), F.lit(0))


def known_digests(spark, notices: dict[str, list[str]] = NOTICES) -> DataFrame:
    """(digest, license_id) of the known texts; empty canonical texts are no licence."""
    rows = [(name, text) for name, texts in notices.items() for text in texts]
    known = spark.createDataFrame(rows, "license_id string, text string").select("license_id", canonical(F.col("text")).alias("text"))
    return known.where("text <> ''").groupBy(F.md5("text").alias("digest")).agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, notices: dict[str, list[str]] = NOTICES) -> DataFrame:
    """Which known licence each document (doc_id, text, ...) is, and which its lines are.

    The whole text and each of its lines are texts of their own; each is put into canonical form, and its digest looked
    up among those of the known licences by a hash join whose small side is the given list. Lines that are no licence
    are gone before the shuffle. Returns doc_id, digest (of the whole text), license_id (null: the text is no known
    licence), n_license_lines and line_licenses (distinct names, sorted, comma-joined). Null text: as an empty one,
    which is no licence. Rows equal in id and text are returned as often as given. No rows: no rows.
    """
    units = docs.select(
        "doc_id", row_digest(F.col("doc_id"), F.col("text")).alias("row"),
        F.posexplode(F.concat(F.array(F.coalesce("text", F.lit(""))), F.split(F.coalesce("text", F.lit("")), "\n"))),
    )
    known = known_digests(docs.sparkSession, notices)
    found = units.withColumn("digest", F.md5(canonical(F.col("col")))).join(F.broadcast(known), "digest", "left")
    whole, line = F.col("pos") == 0, F.col("pos") > 0
    per_row = (
        found.where(whole | F.col("license_id").isNotNull())
        .groupBy("doc_id", "row")
        .agg(
            F.count(F.when(whole, 1)).alias("copies"),
            F.max(F.when(whole, F.col("digest"))).alias("digest"),
            F.max(F.when(whole, F.col("license_id"))).alias("license_id"),
            F.count(F.when(line, 1)).alias("lines"),
            F.collect_set(F.when(line, F.col("license_id"))).alias("names"),
        )
    )
    return per_row.select(
        "doc_id", "digest", "license_id", F.expr("lines div copies").alias("n_license_lines"),
        F.array_join(F.array_sort("names"), ",").alias("line_licenses"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))),
    ).drop("col")
