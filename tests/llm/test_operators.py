"""Operators against brute force, and their cases: nulls, empty and long texts, ties, repeats, no rows, clashing names."""

from __future__ import annotations

import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import public_tokenizers
from llm import brute
from llm.conftest import CLASHES, SF_DIR, table
from tweetflow.llm import (
    components, decontaminate, language, licenses, mixing, queries, sharding, simhash, spotsigs, token_counts, toxicity,
    url_filter,
)

CASES = [(1, "A few words here"), (1, "A few words here"), (2, None), (3, ""), (None, "No id"), (4, "word " * 30_000), (5, "\t\n"), (6, "!?")]


@pytest.fixture(scope="module")
def documents():
    return {row["doc_id"]: row["text"] for row in pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist()}


# Mixing


def test_mix_takes_words_near_the_targets(spark):
    found = queries.op1_mix_sources(spark, SF_DIR).toPandas()
    for _, rows in found.groupby(["source_size", "target"]):
        assert abs(rows["taken"].sum() - rows["target"].iloc[0]) <= rows["size"].max()
    assert (found["taken"] <= 3 * found["size"]).all() and (found["taken"] % found["size"].clip(1) == 0).all()


def test_full_sources_pass_their_excess_on(docs):
    # Sizes 1, 10, 100 with weights 1, 2, 3: shares 18.5, 37, 55.5; the first two are full at 3 and 30.
    rows = [(1, "w", "en", "a"), (2, "w " * 10, "en", "b"), (3, "w " * 100, "en", None)]
    found = mixing.allot(docs(*rows)).select("doc_id", "target")
    assert table(found) == [(1, 3.0), (2, 30.0), (3, 78.0)]


def test_mix_cases(docs, clashing):
    assert mixing.allot(docs()).count() == 0 and mixing.mix(docs()).count() == 0
    found = mixing.mix(clashing(*CASES))
    assert set(CLASHES) < set(found.columns) and found.where("size <> 'mine'").count() == 0
    assert table(mixing.allot(docs(*CASES)), "doc_id", "size")[0][1] is not None
    assert table(mixing.allot(docs((1, None), (2, "")))) and mixing.mix(docs((1, None))).count() == 0


def test_a_mix_is_the_same_whatever_the_partitions(docs):
    rows = [(i, "w " * (i % 17 + 1), "en", f"s{i % 3}") for i in range(300)]
    columns = ("doc_id", "size", "copies")
    assert table(mixing.allot(docs(*rows)), *columns) == table(mixing.allot(docs(*reversed(rows)).repartition(7)), *columns)


# SimHash


def test_simhash_of_contract():
    texts = ["", "one", "one two", "A b C d e", "x\u00a0y z q", "ÄÖ ß\x0bé", "a b " * 400]
    for text in texts:
        assert simhash.simhash(text.encode(), 3) & (1 << 64) - 1 == brute.simhash(text)
    assert simhash.simhash(None, 3) == 0


def test_simhash_components_of_the_table(spark, documents):
    ids = sorted(documents)
    prints = [brute.simhash(documents[i]) for i in ids]
    root = brute.components(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    want = {i: (f"{p:016x}", ids[r]) for i, p, r in zip(ids, prints, root)}
    got = {row["doc_id"]: (row["fingerprint"], row["component_id"]) for row in queries.op2_simhash(spark, SF_DIR).collect()}
    assert got == want


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 250), st.integers(0, 5))
def test_trie_joins_all_pairs_within_the_budget(seed, many, budget):
    draw = random.Random(seed)
    centres = [draw.getrandbits(64) for _ in range(5)]
    fps = {c ^ sum(1 << draw.randrange(64) for _ in range(draw.randrange(5))) & (1 << 64) - 1 for c in draw.choices(centres, k=many)}
    array = np.array(sorted(fps), np.uint64)
    label = simhash.trie_links(array, [(0, 0, 0)], 0, budget)
    assert label.tolist() == brute.components(array.tolist(), lambda a, b: (a ^ b).bit_count() <= budget)


def test_trie_in_small_steps(monkeypatch):
    draw = random.Random(5)
    array = np.array(sorted({sum(1 << b for b in draw.sample(range(20), 3)) for _ in range(400)}), np.uint64)
    whole = simhash.trie_links(array, [(0, 0, 0)], 0, 3)
    monkeypatch.setattr(simhash, "PAIRS", 8)
    monkeypatch.setattr(simhash, "LEAF", 1)
    assert simhash.trie_links(array, [(0, 0, 0)], 0, 3).tolist() == whole.tolist()


def test_a_fingerprint_is_sent_as_often_at_every_size(spark):
    for many in (300, 30_000):
        sent = simhash.turned(spark.range(many).select(F.xxhash64("id").alias("fp")), 3)
        assert sent.count() == 4 * many
    depths = simhash.split_depths(sent, 3)
    assert depths == [simhash.LEAST_DEPTH] * 4


@pytest.mark.parametrize("budget", [0, 1, 2, 5])
def test_links_of_any_budget(spark, budget, monkeypatch):
    """Subtrees of a few fingerprints, so that pairs meet in different blocks only."""
    monkeypatch.setattr(simhash, "SUBTREE", 8)
    draw = random.Random(budget)
    fps = [draw.getrandbits(63) for _ in range(40)]
    fps = sorted({f ^ sum({1 << draw.randrange(63) for _ in range(n)}) for f in fps for n in range(7)})
    frame = spark.createDataFrame([(x,) for x in fps], "fp long")
    roots = {r["u"]: r["v"] for r in components.connected(simhash.fingerprint_links(frame, budget)).collect()}
    label = brute.components(fps, lambda a, b: (a ^ b).bit_count() <= budget)
    assert [roots.get(f, f) for f in fps] == [fps[i] for i in label]


def test_links_across_subtrees(spark):
    draw = random.Random(1)
    fps = [draw.getrandbits(63) for _ in range(50)]
    # In the last bits, in the first bits, and over a chain of both.
    fps += [fps[0] ^ 0b111, fps[0] ^ 0b111000, fps[1] ^ 1 << 62, fps[1] ^ 0b11 << 61, fps[2] ^ 1 << 62 ^ 1 << 61 ^ 1]
    frame = spark.createDataFrame([(x,) for x in fps], "fp long")
    roots = {r["u"]: r["v"] for r in components.connected(simhash.fingerprint_links(frame)).collect()}
    label = brute.components(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    for i in range(len(fps)):
        for j in range(i):
            assert (roots.get(fps[i], fps[i]) == roots.get(fps[j], fps[j])) == (label[i] == label[j])


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(30)] + [(99, 29)]])
def test_connected(spark, edges):
    found = components.connected(spark.createDataFrame(edges, "u long, v long"))
    assert table(found) == sorted(((u, 0) for u in {x for e in edges for x in e} if u > 0 and edges != [(1, 1)]), key=repr)


def test_simhash_cases(docs, clashing):
    assert simhash.near_duplicates(docs(), ["doc_id"]).count() == 0
    found = simhash.near_duplicates(clashing(*CASES), ["doc_id"])
    by_id = {row["doc_id"]: row for row in found.collect()}
    assert found.count() == len(CASES)
    # Null, empty and blank texts are one group; "!?" is a word.
    assert by_id[2]["component_id"] == by_id[3]["component_id"] == by_id[5]["component_id"] == 2
    assert by_id[1]["component_id"] == 1 and by_id[None]["component_id"] is None
    own = simhash.near_duplicates(clashing((3, "one two")), ["doc_id", "fp", "mask", "component_id"]).first()
    assert (own["fp_given"], own["mask"], own["component_id_given"], own["component_id"]) == ("mine", "mine", "mine", 3)
    kept = simhash.one_per_group(clashing(*CASES))
    assert set(CLASHES) < set(kept.columns) and table(kept, "doc_id") == [(1,), (2,), (4,), (6,), (None,)]


# URLs


def rule_of(url, rules):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host, path = brute.lower_ascii(rest[:cut]), rest[cut:]
    path = path[: min((path.index(c) for c in "?#" if c in path), default=len(path))]
    fits = []
    for rule in rules:
        of, slash, rest = rule.partition("/")
        if (host == of or host.endswith("." + of)) and path.startswith(slash + rest):
            fits.append(rule)
    return host, path, max(fits, key=len, default=None)


URLS = [
    None, "", "no scheme", "http://", "http://net", "http://net/", "http://NET/x", "https://a.net/", "http://xnet/", "http://a.net?x/",
    "http://example.net/en/1", "http://a.example.net/en", "http://b.example.net/en/?q", "http://example.com/de/#x", "http://w.example.com/DE/",
    "x://y.org/fr/", "x://org/fr/a", "x://y.org/f", "http://..net/", "http://é.org/fr/", "a://b://net/", "http://h.net\n/a",
]


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, url, "mine") for i, url in enumerate(URLS)], "page_id int, url string, host string")
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(pages, queries.RULES, ["page_id"]).collect()}
    for i, url in enumerate(URLS):
        host, path, rule = rule_of(url, queries.RULES)
        assert found[i] == (host, path, rule, queries.RULES[rule] if rule else "allow"), url


def test_carried_columns_of_the_results_names(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x", "mine", "mine")], "page_id int, url string, host string, rule string")
    found = url_filter.judge(pages, queries.RULES, ["page_id", "host", "rule"])
    assert found.columns == ["page_id", "host_given", "rule_given", "host", "path", "rule", "verdict"]
    assert tuple(found.first()) == (1, "mine", "mine", "a.net", "/x", "net/", "block")


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id int, url string")
    assert table(url_filter.judge(pages, {}, ["page_id"]), "rule", "verdict") == [(None, "allow")]
    assert url_filter.judge(pages.where("false"), queries.RULES, ["page_id"]).count() == 0


def test_first_filter_errs_on_few_keys_of_a_large_universe(spark):
    """Two listed keys among 400 000: the keys of level 1 follow the list, not the universe."""
    listed = spark.createDataFrame([("net/",), ("example.com/de/",)], "key string")
    universe = spark.range(400_000).select(F.concat(F.lit("host"), "id", F.lit("/")).alias("key")).unionByName(listed)
    first = url_filter.bloom(listed, 2, 2 / 400_002, 0)
    held = table(universe.where(url_filter.maybe_in(F.col("key"), first, 0)))
    assert {("net/",), ("example.com/de/",)} <= set(held) and len(held) <= 20
    assert [url_filter.filter_shape(2, 2 / 10**k)[0] for k in (6, 12)] == [1 << 11, 1 << 21]
    assert url_filter.filter_shape(1_000_000, 1e-6) == (1 << 25, 16)


def test_cascade_is_exact_on_its_universe(spark):
    """Levels are needed: the first filter errs, and the cascade doesn't."""
    universe = spark.range(3000).select(F.concat(F.lit("h"), "id", F.lit(".net/")).alias("key"))
    listed = universe.where("xxhash64(key) % 10 = 0")
    n = listed.count()
    levels = url_filter.cascade(listed, universe, n, 10 * n)
    members = table(universe.where(url_filter.listed_in(F.col("key"), levels)))
    assert members == table(listed) and len(levels) > 1
    assert universe.where(url_filter.maybe_in(F.col("key"), levels[0], 0)).count() > n
    assert sum(len(level.words) for level in levels) * 64 < 40 * n


# Token counts


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_token_counts_and_their_cache(spark, docs, tmp_path, monkeypatch, name):
    model, cache = public_tokenizers.path(name), str(tmp_path / "cache")
    given_ = docs(*CASES, (7, "<s> </s> <|endoftext|> élan"))
    count = token_counts._counter(model)
    want = sorted(((i, len((t or "").encode()), count([t or ""])[0]) for i, t, *_ in [*CASES, (7, "<s> </s> <|endoftext|> élan")]), key=repr)
    first = token_counts.count_tokens(given_, model, cache, ["doc_id"])
    assert table(first, "doc_id", "n_bytes", "n_tokens") == want
    assert table(first.where("over_limit"), "doc_id") == [(i,) for i, _, n in want if n > 4096]
    # Null and empty texts are one content, as are the two copies.
    assert spark.read.parquet(cache).select("content").distinct().count() == 7
    stored = spark.read.parquet(cache).count()
    again = token_counts.count_tokens(given_, model, cache, ["doc_id"])
    assert table(again, "doc_id", "n_bytes", "n_tokens") == want and spark.read.parquet(cache).count() == stored
    token_counts.count_tokens(docs((9, "a new text")), model, cache, ["doc_id"])
    assert spark.read.parquet(cache).count() == stored + 1


def test_copies_are_encoded_once(spark, docs, tmp_path):
    """Copies without an id, of one id and of several."""
    model, cache = public_tokenizers.path("piece_bpe_32k.model"), str(tmp_path / "cache")
    copies = docs(*[(None if i % 6 == 5 else i % 6, "one text in many rows") for i in range(300)], (7, "another")).repartition(5)
    found = token_counts.count_tokens(copies.withColumn("n_tokens", F.lit(-1)), model, cache, ["doc_id", "n_tokens"])
    assert found.count() == 301 and table(found.select("n_tokens_given").distinct()) == [(-1,)]
    assert spark.read.parquet(cache).count() == 2


def test_token_counts_of_no_rows(docs, clashing, tmp_path):
    model = public_tokenizers.path("piece_bpe_32k.model")
    assert token_counts.count_tokens(docs(), model, str(tmp_path / "a"), ["doc_id"]).count() == 0
    assert token_counts.count_tokens(clashing(*CASES), model, str(tmp_path / "b"), ["doc_id"]).count() == len(CASES)


# Licences


def test_licences_in_any_spelling(docs, clashing):
    texts = {
        1: ("MIT", 1), 2: ("MIT", 1), 3: (None, 2), 4: (None, 0), 5: (None, 0), 6: ("Apache-2.0", 1), 7: ("MIT", 1),
    }
    given_ = [
        (1, "Released under the MIT License."), (2, "RELEASED, under the -- MIT licence"),
        (3, "text\nReleased under the MIT License.\nLicensed under CC BY-NC 4.0.\n"), (4, None), (5, "released under the MIT license of"),
        (6, "licenced under the apache licence, v2.0"), (7, "Copyright (c) 2020 Some One\nReleased under the MIT License."),
    ]
    found = {r["doc_id"]: (r["license_id"], r["n_license_lines"]) for r in licenses.scan(clashing(*given_)).collect()}
    assert found[6][0] in ("Apache-2.0", None)
    assert {i: found[i] for i in (1, 2, 3, 4, 5, 7)} == {i: texts[i] for i in (1, 2, 3, 4, 5, 7)}
    assert table(licenses.scan(docs(*given_[2:3])), "line_licenses") == [("CC-BY-NC-4.0,MIT",)]


def test_licence_cases(docs):
    assert licenses.scan(docs()).count() == 0
    assert table(licenses.scan(docs(*CASES)), "license_id", "n_license_lines") == [(None, 0)] * len(CASES)
    twice = licenses.scan(docs((1, "Released under the MIT License."), (1, "Released under the MIT License.")))
    assert table(twice, "license_id", "n_license_lines") == [("MIT", 1)] * 2


# Languages


def test_phrases_are_longest_matches(monkeypatch):
    samples = (("a", ("abab cab abba", "bcab")), ("b", ("xyx yzx", "zyzz xy")))
    automaton = language.Automaton(samples)
    draw = random.Random(3)
    texts = ["".join(draw.choices("abcxyz q1", k=draw.randrange(1, 60))) for _ in range(50)]
    blocks = [automaton.symbols(language.code_points(t)) for t in texts]
    monkeypatch.setattr(language, "LANES", 7)
    found = automaton.phrases(blocks)
    for k, (_, own) in enumerate(samples):
        sample = automaton.symbols(language.code_points(" ".join(own))).tobytes()
        assert [brute.phrases(b.tobytes(), sample) for b in blocks] == found[:, k].tolist()


def test_languages_of_held_out_documents(spark):
    langs = pq.read_table(f"{SF_DIR}/documents.parquet").to_pandas().set_index("doc_id")["lang"]
    found = queries.op6_language(spark, SF_DIR).toPandas()
    held = found[found["held_out"]]
    assert (langs[held["doc_id"]].to_numpy() == held["lang_pred"].to_numpy()).mean() > 0.97
    assert found["score"].between(0, 1).all() and len(found) == len(langs)


def test_language_cases(docs, clashing):
    learned = language.learn(docs((1, "the cat and the dog", "en", "a"), (2, "le chat et le chien", "fr", "a"), (3, None, "de", "a"), (4, "x", None, "a")))
    assert [lang for lang, _ in learned] == ["en", "fr"]
    rows = [(i, t) for i, t, *_ in CASES] + [(8, "chat, chien!"), (9, "1234 5"), (10, "漢字 ℵ")]
    found = {r["doc_id"]: (r["f"]["lang_pred"], r["f"]["score"]) for r in clashing(*rows).select("doc_id", language.detect(F.col("text"), learned).alias("f")).collect()}
    assert found[8][0] == "fr" and {found[i] for i in (2, 3, 5, 6, 9)} == {("und", 0.0)} and found[10][0] in ("en", "fr")
    assert docs().select(language.detect(F.col("text"), learned)).count() == 0
    assert table(docs((1, "words")).select(language.detect(F.col("text"), ()).alias("f")), "f.lang_pred", "f.score") == [("und", 0.0)]


# SpotSigs


def test_neighbours_and_edits_of_the_table(spark, documents):
    ids = sorted(documents, reverse=True)
    following = dict(zip(ids, ids[1:] + ids[:1]))
    found = queries.op7_spotsigs(spark, SF_DIR).collect()
    prints, own = {}, {}
    for row in found:
        text, after = documents[row["doc_id"]], documents[following[row["doc_id"]]]
        assert (row["n_chars"], row["edited_sha256"]) == (len(text), brute.sha256(brute.edited(text, after)))
        assert prints.setdefault(text, row["fingerprint"]) == row["fingerprint"]
        own[row["doc_id"]] = set(row["fingerprint"].split())

    def jaccard(a, b):
        return len(a & b) / len(a | b) if a | b else 1.0

    for row in found:
        assert row["near_next"] == pytest.approx(jaccard(own[row["doc_id"]], own[following[row["doc_id"]]]))
        assert row["near_edited"] == pytest.approx(jaccard(own[row["doc_id"]], set(row["edited_fingerprint"].split())))
    assert len(found) == len(documents)


def test_spots(spark):
    def spots(text):
        return set(spark.createDataFrame([(text,)], "t string").select(spotsigs.signatures(F.col("t"))).first()[0])

    one = spots("The house, of GREEN stone")
    # the: house green; of: green stone
    assert len(one) == 2 and one == spots("the house of green stone.") and spots("the house the green") < spots("the house the green stone")
    assert len(spots("nothing common here")) == 1 and spots("") == set() and len(spots("?")) == 1


def test_texts_without_a_spot_have_near_copies(spark):
    words = [f"слово{i}" for i in range(60)]
    texts = [(" ".join(words),), (" ".join(words[:30] + ["другое"] + words[31:]),), ("два слова",), ("два, слова!",), ("the a of",)]
    one, other, short, marked, anchors = (set(r[0]) for r in spark.createDataFrame(texts, "t string").select(spotsigs.signatures(F.col("t"))).collect())
    assert len(one) == len(other) == 58 and len(one & other) == 55
    assert len(short) == len(marked) == len(anchors) == 1 and short != marked


def test_spot_order_cases(docs, clashing):
    assert spotsigs.compare_next(docs()).count() == 0
    alone = spotsigs.compare_next(docs((7, "abcdef"))).first()
    assert alone["next_id"] == 7 and alone["edited_sha256"] == brute.sha256("abcdab") and alone["near_next"] == 1.0
    found = {r["doc_id"]: r for r in spotsigs.compare_next(clashing(*CASES)).collect()}
    assert spotsigs.compare_next(docs(*CASES)).count() == len(CASES)
    # 6, 5, 4, 3, 2, 1, null, and back to 6; two rows of 1 are one place.
    assert [found[i]["next_id"] for i in (6, 5, 4, 3, 2, 1, None)] == [5, 4, 3, 2, 1, None, 6]
    assert found[2]["fingerprint"] == found[3]["fingerprint"] == "" and found[3]["near_next"] == 1.0 and found[4]["near_next"] == 0.0
    assert found[None]["edited_sha256"] == brute.sha256("No i!") or found[None]["edited_sha256"] == brute.sha256(brute.edited("No id", "!?"))


def test_order_of_text_ids(docs):
    found = spotsigs.compare_next(docs((1, "a"), (2, "b"), (3, "c")).withColumn("doc_id", F.concat(F.lit("d"), "doc_id")))
    assert table(found, "doc_id", "next_id") == [("d1", "d3"), ("d2", "d1"), ("d3", "d2")]


def test_order_over_many_ranges(spark, docs):
    rows = [(i * 7919 % 1009, f"text number {i}") for i in range(1009)]
    found = spotsigs.compare_next(docs(*rows).repartition(5)).select("doc_id", "next_id").collect()
    assert {r["doc_id"]: r["next_id"] for r in found} == {i: (i - 1) % 1009 for i in range(1009)}


def test_near_copies_anywhere_in_the_table(spark):
    """The registered query searches the whole table, and counts copies and near copies of every document."""
    found = queries.op7_spotsigs(spark, "/root/testdata/sf0.001").collect()
    sets = [frozenset(row["fingerprint"].split()) for row in found]

    def alike(a, b):
        return a == b or len(a & b) >= 0.8 * len(a | b)

    assert [row["n_links"] for row in found] == [sum(alike(a, b) for b in sets) - 1 for a in sets]
    assert len({(row["class_id"], row["fingerprint"]) for row in found}) == len(set(sets)) == len({row["class_id"] for row in found})


def test_links_of_copies_and_near_copies(docs):
    base = [f"the w{i} v{i}" for i in range(20)]
    one, near, far = " ".join(base), " ".join(base[:-1]), " ".join(base[:8])
    rows = [(9, one), (1, one), (5, near), (3, far), (7, None), (2, ""), (4, "the same"), (5, near)]
    frame = docs(*rows)
    found = spotsigs.with_links(spotsigs.compare_next(frame), frame).collect()
    assert len(found) == len(rows) and spotsigs.with_links(spotsigs.compare_next(docs()), docs()).count() == 0
    assert {r["doc_id"]: r["n_links"] for r in found} == {9: 3, 1: 3, 5: 3, 3: 0, 7: 1, 2: 1, 4: 0}


def test_whole_texts_are_shuffled_once(docs):
    plan = spotsigs.compare_next(docs((1, "a"), (2, "b")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning") == 1


def test_links_with_signatures_taken_once(docs):
    base = [f"the w{i} v{i}" for i in range(20)]
    one, near = " ".join(base), " ".join(base[:-1])
    # Rows that come twice, other texts of one id, null ids and texts, copies under other ids.
    frame = docs((1, one), (1, one), (1, near), (2, None), (2, ""), (None, near), (None, "alone here"), (3, one), (4, ""), (5, "no spot, but words enough"))
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "next_id", "class_id", "n_links"]
    want = spotsigs.with_links(spotsigs.compare_next(frame), frame)
    assert table(spotsigs.compare_all(frame), *columns) == table(want, *columns)
    assert spotsigs.compare_all(frame).count() == 10 and spotsigs.compare_all(docs()).count() == 0
    links = {(r["doc_id"], r["n_chars"]): r["n_links"] for r in spotsigs.compare_all(frame).collect()}
    assert links[(1, len(one))] == links[(1, len(near))] == links[(None, len(near))] == links[(3, len(one))] == 4
    assert links[(2, 0)] == links[(4, 0)] == 2 and links[(None, 10)] == 0


def test_similar_sets(spark):
    draw = random.Random(2)
    base = [draw.sample(range(5000), draw.randrange(3, 60)) for _ in range(25)]
    sets = [set(b) for b in base]
    for b in base:
        for _ in range(3):
            sets.append((set(b) - set(draw.sample(b, draw.randrange(3)))) | set(draw.sample(range(5000), draw.randrange(4))))
    sets = [s for s in {frozenset(s) for s in sets} if s]
    frame = spark.createDataFrame([(i, sorted(s)) for i, s in enumerate(sets)], "id long, sigs array<long>")
    want = {(i, j) for j in range(len(sets)) for i in range(j) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    assert {(r["id_a"], r["id_b"]) for r in spotsigs.similar_sets(frame).collect()} == want and want


# Decontamination


def test_contamination_of_the_table(spark, documents):
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF_DIR}/benchmark.parquet").to_pylist()]
    want = dict(zip(documents, brute.contamination(documents.values(), items)))
    found = queries.op8_decontaminate(spark, SF_DIR).collect()
    assert len(found) == len(documents) and any(row["contaminated"] for row in found)
    for row in found:
        words, hit, names = want[row["doc_id"]]
        assert (row["n_words"], row["n_hit"], row["n_items"], row["items_sha256"]) == (words, hit, len(names), brute.sha256(",".join(names)))


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.integers(2, 5), st.integers(1, 6))
def test_suffix_search_against_brute_force(seed, letters, window):
    draw = random.Random(seed)

    def text(most):
        return " ".join(draw.choices("abcde"[:letters] + "xyz", k=draw.randrange(most)))

    items = [(i % 7, text(14)) for i in range(draw.randrange(9))]
    texts = [text(40) for _ in range(draw.randrange(1, 9))]
    tests = decontaminate.Tests.of([(str(name), t.encode()) for name, t in items], window)
    found = decontaminate.examine_shard([tests.numbers(t.encode()) for t in texts], tests)
    want = brute.contamination(texts, items, window)
    assert [(hit, names) for hit, names, _ in found] == [(hit, names) for _, hit, names in want]
    for t, (_, _, spans) in zip(texts, found):
        for span in spans:
            match = " ".join(t.split()[span["start"] : span["start"] + span["words"]])
            assert any(f" {match} " in f" {own} " for name, own in items if str(name) == span["item_id"])


def test_contamination_cases(spark, docs, clashing):
    bench = spark.createDataFrame([(1, "few words"), (2, None), (None, "!?"), (1, "no id")], "item_id long, text string")
    found = {r["row"]["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in decontaminate.examine(docs(*CASES), bench, ["doc_id"]).collect()}
    assert found[1] == (4, 2, ["1"]) and found[None] == (2, 2, ["1"]) and found[2] == found[3] == found[6] == (0, 0, []) and found[4][0] == 30_000
    kept = decontaminate.without_hits(clashing(*CASES), bench)
    assert set(CLASHES) < set(kept.columns) and table(kept, "doc_id") == [(2,), (3,), (4,), (5,), (6,)]
    assert decontaminate.examine(docs(), bench, ["doc_id"]).count() == 0
    assert decontaminate.without_hits(docs(*CASES), bench.where("false")).count() == len(CASES)


# Sharding


def checked_shards(found, many=16):
    """Slots of every shard are 0, 1, 2 and so on; returns bytes by shard."""
    for _, rows in found.groupby("shard"):
        assert sorted(rows["slot"]) == list(range(len(rows)))
    assert found["shard"].between(0, many - 1).all()
    return found.groupby("shard")["size"].sum().reindex(range(many), fill_value=0)


def test_shards_of_the_table(spark, documents):
    found = queries.op9_shards(spark, SF_DIR).toPandas()
    sizes = checked_shards(found)
    assert len(found) == len(documents) and sizes.max() - sizes.min() <= 2 * found["size"].max()
    assert dict(zip(found["doc_id"], found["size"])) == {i: len(t.encode()) + 1 for i, t in documents.items()}
    assert found.assign(text=found["doc_id"].map(documents)).groupby("text")["shard"].nunique().max() == 1


def test_copies_of_a_larger_table_stay_together(spark):
    """Ranges just over their share are subdivided by text; only a text that fills a part by itself is spread."""
    sf_dir = "/root/testdata/sf0.1"
    found = queries.op9_shards(spark, sf_dir)
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.sha2("text", 256).alias("digest"))
    groups = found.join(texts, "doc_id").groupBy("digest").agg(F.sum("size").alias("bytes"), F.count_distinct("shard").alias("shards")).toPandas()
    split = groups[groups["shards"] > 1]
    assert len(groups) > 9000 and (split["bytes"] > groups["bytes"].sum() / 2048).all()
    sizes = checked_shards(found.toPandas())
    assert sizes.max() < 1.05 * sizes.mean()


def test_a_group_of_copies_is_spread(docs):
    rows = [(i, "the same text" if i % 3 == 0 else f"text {i} " * 3) for i in range(6000)]
    found = sharding.assign(docs(*rows)).toPandas()
    sizes = checked_shards(found)
    assert sizes.max() < 1.1 * sizes.mean() and found["shard"].nunique() == 16


def test_shard_cases(docs, clashing):
    assert sharding.assign(docs()).count() == 0
    found = sharding.assign(clashing(*CASES))
    checked_shards(found.toPandas())
    assert found.count() == len(CASES) and set(CLASHES) < set(found.select("row.*").columns)
    rows = [(i, "" if i % 2 else None) for i in range(2000)]
    assert checked_shards(sharding.assign(docs(*rows)).toPandas()).max() < 200


# Toxicity


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(-6, 6), max_size=30))
def test_segments_are_the_maximal_ones(weights):
    found = toxicity.segments(np.array(weights, float))
    want = brute.maximal_segments([float(w) for w in weights])
    assert sorted(round(s, 6) for _, _, s in found) == sorted(round(s, 6) for _, _, s in want)


def test_held_out_documents_with_insults(spark):
    labels = pq.read_table(f"{SF_DIR}/labels.parquet").to_pandas().set_index("doc_id")["toxic"]
    found = queries.op10_toxicity(spark, SF_DIR).toPandas()
    known = found[found["held_out"] & found["doc_id"].isin(labels.index)]
    toxic = labels[known["doc_id"]].to_numpy() == 1
    predicted = known["predicted"].to_numpy() == 1
    assert (toxic & predicted).sum() >= 0.6 * toxic.sum() and not (predicted & ~toxic).any()
    assert found["score"].between(0, 1).all() and found["held_out"].sum() > 250


def labelled(spark, docs):
    plain = [(i, f"some plain words w{i % 11} and others v{i % 13}") for i in range(300)]
    bad = [(1000 + i, f"some plain words w{i % 11} and vile trash v{i % 13}") for i in range(100)]
    labels = spark.createDataFrame([(i, 0) for i, _ in plain] + [(i, 1) for i, _ in bad], "doc_id long, toxic int")
    return docs(*plain, *bad), labels


def test_words_are_known_by_their_surest_form(monkeypatch):
    weights = toxicity.Weights({"scum": (4.0, 9.0), "scum*": (2.0, 3.0), "scumbag*": (3.0, 5.0)})
    monkeypatch.setattr(toxicity, "HELD", 2)
    for _ in range(2):
        of = [weights.of(word) for word in ("scum", "scums", "scumbag", "scumbags", "scu", "")]
        assert of == [9.0, 3.0, 3.0, 5.0, -toxicity.DRIFT, -toxicity.DRIFT]
    assert toxicity.forms("abc") == ["abc"] and toxicity.forms("abcdef") == ["abcdef", "abcd*", "abcde*"]
    # A word that comes again nearby counts once, its other forms count too.
    assert list(toxicity.weigh(["scum", "scum", "scums"], weights)) == [9.0, -toxicity.DRIFT, 3.0]


def test_all_log_odds_are_in_the_scan(spark):
    """Also small ones and those of clean words; a passage of moderately toxic words is a segment."""
    counts = [("", 20_000, 180_000), ("vile", 90, 3), ("rude", 60, 180), ("nice", 3, 900), ("once", 1, 2)]
    rows = toxicity.log_odds(spark.createDataFrame(counts, "token string, toxic long, clean long"))
    found = toxicity.shrunk(rows).toPandas()
    weights = toxicity.Weights((found["key"].to_numpy().view("uint64"), found["sure"].to_numpy(), found["weight"].to_numpy()))
    vile, rude, nice, once, unknown = weights.all_of(["vile", "rude", "nice", "once", "never"])
    assert vile > 3 > rude > 0.8 and nice < -0.5 and unknown == -toxicity.DRIFT and 0 < abs(once + toxicity.DRIFT) < 0.2
    words = "so rude and rude".split()
    assert [segment[:2] for segment in toxicity.segments(toxicity.weigh(words, weights))] == [(1, 2)]
    assert len(found) == 4


def test_a_word_counts_again_after_fifty_words():
    weights = toxicity.Weights({"scum": (4.0, 9.0)})
    for gap in (1, 20, 30, 49, 50, 70):
        words = (["scum"] + ["so"] * (gap - 1)) * 12
        counted, want = -toxicity.AGAIN, []
        for at in range(0, len(words), gap):
            if at - counted >= toxicity.AGAIN:
                want.append(at)
                counted = at
        assert np.flatnonzero(toxicity.weigh(words, weights) > 0).tolist() == want
    assert len(toxicity.segments(toxicity.weigh((["scum"] + ["so"] * 29) * 200, weights))) == 1
    apart = (["scum"] + ["so"] * 200 + ["scum"] + ["so"] * 29) * 3
    assert len(toxicity.segments(toxicity.weigh(apart, weights))) > 1


def test_scores_rise_with_the_best_segment():
    """Also where few or no clean documents have a segment, or none has."""
    for hits in (0, 1, 40):
        clean = toxicity.Extremes.fitted(300, hits, 1.5 if hits else None, 0.2 if hits else None)
        toxic = toxicity.Extremes.fitted(40, 36, 2.5, 0.4, clean.scale)
        model = toxicity.Model(toxicity.Weights({}), clean, toxic, 0.1)
        scores = [model.score(best) for best in (0.0, 3.0, 6.0, 12.0, 24.0, 1e6)]
        assert scores == sorted(scores) and scores[0] < 0.1 and scores[-1] > 0.9 and 0 <= scores[0] and scores[-1] <= 1
        assert toxicity.Extremes.fitted(0, 0, None, None).above(0.0) <= 1


def test_toxic_passages(spark, docs, clashing):
    given_, labels = labelled(spark, docs)
    model = toxicity.fit(given_, labels)
    long = "good day " * 200
    rows = clashing((1, long + "you vile trash now " + long), (2, long), (3, None), (4, ""), (None, "vile TRASH"), (6, "123 !"))
    found = {r["doc_id"]: r["found"] for r in rows.select("doc_id", toxicity.scored(F.col("text"), model, spark).alias("found")).collect()}
    passages = found[1]["passages"]
    assert [(long + "you vile trash now ")[p["start"] : p["end"]] for p in passages] == ["vile trash"]
    assert found[None]["score"] == found[1]["score"] >= 0.7 > found[2]["score"] == found[3]["score"] == found[4]["score"] == found[6]["score"]


def test_a_calibration_part_without_toxic_rows(spark, docs):
    given_, labels = labelled(spark, docs)
    held_back = F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(4)) == 0
    fewer = labels.where((F.col("toxic") == 0) | ~held_back)
    model = toxicity.fit(given_, fewer)
    assert model is not None and model.score(12.0) > 0.7 > model.score(0.0)


def test_toxicity_cases(spark, docs, clashing):
    given_, labels = labelled(spark, docs)
    assert toxicity.fit(given_, labels.where("false")) is None and toxicity.fit(docs(), labels) is None
    nothing = docs(*CASES).select(toxicity.scored(F.col("text"), None, spark)["score"].alias("s"))
    assert table(nothing) == [(0.0,)] * len(CASES) and docs().select(toxicity.scored(F.col("text"), None, spark)).count() == 0
    more = labels.unionByName(spark.createDataFrame([(None, 1), (5, None), (3, 0), (3, 0)], "doc_id long, toxic int"))
    kept = toxicity.without_toxic(given_.withColumns({name: F.lit("mine") for name in CLASHES}), more)
    assert set(CLASHES) < set(kept.columns) and kept.where("doc_id < 1000").count() == 300 and kept.where("doc_id >= 1000").count() == 0
