"""Source divergence, spelling variants and near-duplicate vectors, each against a plain version of its contract."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tweetflow.llm import divergence, embeddings, queries, spelling
from tweetflow.llm.common import read

from .brute import components, lower_ascii
from .conftest import CLASHES, table

SMALL = "/root/testdata/sf0.001"


# Source divergence


def audited(rows, least=10, top=10):
    """(lang, source, part, item, value, rank) from (text, lang, source)."""
    rows = [tuple(x or "" for x in row) for row in rows]
    found = [(lang, source, Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower_ascii(text)))) for text, lang, source in rows]
    out = []
    for lang in {lang for lang, _, _ in found}:
        docs = Counter(term for l, _, counts in found if l == lang for term in counts)
        kept = [term for term, n in docs.items() if n >= least]

        def shares(of):
            counts = Counter()
            for l, source, words in found:
                if l == lang and of in (None, source):
                    counts += words
            total = sum(counts[t] for t in kept)
            return {t: (1 + 10**9 * (counts[t] + 2) // (total + 2 * len(kept)), counts[t]) for t in kept}

        whole = shares(None)
        by_source = {source: shares(source) for l, source, _ in found if l == lang}
        for source, own in by_source.items():
            f = lambda p, q: (p - q) ** 2 // (p + q)
            pairs = [(o, sum(f(own[t][0], other[t][0]) for t in kept)) for o, other in by_source.items() if o != source]
            terms = [(t, f(p, whole[t][0])) for t, (p, n) in own.items() if n and p > whole[t][0]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, source, part, *item, rank) for rank, item in enumerate(items, 1) if part == "pair" or rank <= top]
    return sorted(out)


def from_rows(docs, rows):
    return docs(*[(i, text, lang, source) for i, (text, lang, source) in enumerate(rows)])


def made_rows(seed, many=120):
    rng = random.Random(seed)
    words = "alpha Beta beta GAMMA delta épsilon Épsilon 漢字 zeta eta theta iota kappa".split()
    return [
        (" ".join(rng.choices(words, range(1, len(words) + 1), k=rng.randrange(12))), rng.choice(["en", "fr", None]), rng.choice("abcdefg"))
        for _ in range(many)
    ]


def test_audit_of_the_table(spark):
    rows = read(spark, SMALL, "documents").select("text", "lang", "source").collect()
    assert table(queries.op11_divergence(spark, SMALL)) == sorted(audited(map(tuple, rows)), key=repr)


@pytest.mark.parametrize("bits", [64, 3])
def test_terms_that_share_a_digest_are_told_apart(docs, bits):
    rows = made_rows(bits)
    assert table(divergence.audit(from_rows(docs, rows), bits=bits)) == sorted(audited(rows), key=repr)


def test_tiles_of_few_terms_and_sources(docs, monkeypatch):
    monkeypatch.setattr(divergence, "TILE_TERMS", 3)
    monkeypatch.setattr(divergence, "TILE_SOURCES", 2)
    monkeypatch.setattr(divergence, "BROADCAST_GROUPS", 0)
    rows = made_rows(5)
    assert table(divergence.audit(from_rows(docs, rows))) == sorted(audited(rows), key=repr)


def test_audit_cases(docs):
    assert divergence.audit(docs()).collect() == []
    long = "term " * 300_000
    # A source without terms, nulls, equal rows, ties that texts order, a language that keeps nothing.
    rows = [("b a B", "en", "s")] * 10 + [(None, "en", "t"), ("", "en", None), (long, "en", "u"), ("x", None, None), ("y", "", "v")]
    made = from_rows(docs, rows).withColumns({name: F.lit("mine") for name in CLASHES + ["gid", "digest", "nth", "n", "term", "told"]})
    assert table(divergence.audit(made)) == sorted(audited(rows), key=repr)


def test_shares_beyond_longs(spark):
    row = spark.range(1).select(divergence.share(F.lit(10**13), F.lit(3 * 10**13), F.lit(7)).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (10**13 + 2) // (3 * 10**13 + 14)


def test_long_texts_are_split_between_terms(monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 7)
    text = "Aa bb1cc dd-éé  ff" * 9
    assert [w for piece in divergence._pieces(text.encode()) for w in piece] == re.findall(
        rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower_ascii(text).encode()
    )


# Spelling variants


def counted(rows, every=97):
    words = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower_ascii(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    return {word: n for word, n in words.items() if len(word) >= 5 and n >= 3}


def one_letter_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spelled(rows):
    """(word, form, root, n, n_near, form_n), all pairs compared."""
    n = counted(rows)
    near = {w: [v for v in n if one_letter_apart(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out)


VARIANT = ("word", "form", "root", "n", "n_near", "form_n")


def test_variants_of_the_table(spark):
    rows = read(spark, SMALL, "documents").select("doc_id", "text").collect()
    assert sorted(map(tuple, queries.op12_spelling(spark, SMALL).select(*VARIANT).collect())) == spelled(map(tuple, rows))


@pytest.mark.parametrize("seed", range(3))
def test_variants_of_few_letters(docs, monkeypatch, seed):
    """Words that are near in many ways: runs of equal letters, letters beyond ASCII, tries cut into many slices."""
    monkeypatch.setattr(spelling, "SLICE", 20)
    rng = random.Random(seed)
    words = ["".join(rng.choices("aaébÿ×", k=rng.randrange(4, 8))) for _ in range(150)]
    rows = [(i, " ".join(rng.choices(words, range(1, 151), k=60))) for i in range(40)]
    assert sorted(map(tuple, spelling.variants(docs(*rows)).select(*VARIANT).collect())) == spelled(rows)


def test_roots_follow_forms_to_the_last(docs):
    chain = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb", "aabbbb", "abbbbb"]
    rows = [(-1, " ".join(word for i, word in enumerate(chain) for _ in range(3 * 2**i)))]
    found = {r["word"]: r["root"] for r in spelling.variants(docs(*rows)).collect()}
    assert found == {word: "abbbbb" for word in chain}


def test_variant_cases(docs):
    assert spelling.variants(docs()).collect() == []
    assert spelling.variants(docs((1, None), (2, ""), (3, "123 -- 漢字"))).collect() == []
    long, longer = "ab" * 3000, "ab" * 3000 + "c"
    # Null and repeated ids, equal rows, ties of n, very long words and texts.
    rows = [(None, "colour color")] * 4 + [(7, "Colour colon COLON"), (7, "Colour colon COLON"), (8, f"{long} {longer} " * 3), (9, "word x " * 200_000)]
    made = docs(*rows).withColumns({name: F.lit("mine") for name in CLASHES + ["id", "word", "n", "ahead", "behind", "form", "spelled", "slice"]})
    assert sorted(map(tuple, spelling.variants(made).select(*VARIANT).collect())) == spelled(rows)


def test_runs_in_small_blocks(monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 5)
    text = "Abcdefg hij÷klm, nöpĀqrst ÀÿZ " * 7
    assert [w.decode("latin-1") for piece in spelling._runs(text) for w in piece] == [
        lower_ascii(run) for run in re.findall("[A-Za-zÀ-ÿ]+", text)
    ]


# Near-duplicate vectors


def linked(vectors, least=0.95):
    """{index: (n_links, index of the component)} of vectors, all pairs compared."""
    def usable(v):
        return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)

    units = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if usable(v) else None for v in vectors]

    def near(a, b):
        return a is not None and b is not None and len(a) == len(b) and a @ b >= least

    links = [sum(i != j and near(a, b) for j, b in enumerate(units)) for i, a in enumerate(units)]
    return list(zip(links, components(units, near)))


@pytest.fixture
def vectors(spark):
    def make(*rows, kind="float"):
        return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")

    return make


def planted(seed, groups, copies, dim=16, noise=0.03):
    rng = np.random.default_rng(seed)
    rows = [centre + noise * rng.standard_normal(dim) for centre in rng.standard_normal((groups, dim)) for _ in range(copies)]
    rows = [row.astype("f4").astype(float).tolist() for row in rows]
    return rows + rows[:5] + [[2 * x for x in rows[0]]] + rng.standard_normal((100, dim)).astype("f4").astype(float).tolist()


@pytest.mark.parametrize("kind", ["float", "double"])
def test_near_vectors(vectors, monkeypatch, kind):
    """Groups wider than the window, passes cut into many ranges."""
    monkeypatch.setattr(embeddings, "SLICE", 100)
    monkeypatch.setattr(embeddings, "BLOCK", 8)
    made = planted(1, 12, 25)
    got = embeddings.near_duplicates(vectors(*[(i, v, 0) for i, v in enumerate(made)], kind=kind), window=8)
    assert table(got) == sorted(((i, n, c, c == i) for i, (n, c) in enumerate(linked(made))), key=repr)


def test_vector_cases(vectors):
    nan, inf = float("nan"), float("inf")
    assert embeddings.near_duplicates(vectors()).collect() == []
    made = [None, [], [0.0, 0.0], [nan, 1.0], [inf, 1.0], [None, 1.0], [1.0, 0.0], [1.0, 0.0], [1.0, -0.0], [3.0, 0.0], [1.0, 0.0, 0.0], [-1.0, 0.0], [1e-30, 0.0]]
    rows = [(i, v, None) for i, v in enumerate(made)]
    for kind in ("float", "double"):
        frame = vectors(*rows, kind=kind).withColumns({name: F.lit("mine") for name in CLASHES + ["vec", "id", "many", "root", "least_id"]})
        assert table(embeddings.near_duplicates(frame)) == sorted(((i, n, c, c == i) for i, (n, c) in enumerate(linked(made))), key=repr)


def test_vectors_without_ids_or_with_one_id(vectors):
    rows = [(None, [1.0, 0.0], 0), (None, [1.0, 0.0], 0), (4, [0.0, 1.0], 0), (4, [0.0, 1.0], 1), (None, [0.0, 1.0], 0)]
    assert table(embeddings.near_duplicates(vectors(*rows))) == sorted(
        [(None, 1, None, True)] * 2 + [(4, 2, 4, True)] * 2 + [(None, 2, 4, False)], key=repr
    )


def test_vectors_of_the_table(spark):
    """All links of the given vectors and of noisy copies of some of them."""
    frame = read(spark, SMALL, "embeddings").select("vec_id", "embedding", "label")
    noisy = frame.where("vec_id < 60").withColumns(
        {"vec_id": F.col("vec_id") + 10_000, "embedding": F.transform("embedding", lambda x: (x + 0.03 * F.sin(x * 1000)).cast("float"))}
    )
    both = frame.unionByName(noisy).orderBy("vec_id")
    made = both.collect()
    want = linked([row["embedding"] for row in made])
    got = embeddings.near_duplicates(both)
    assert table(got) == sorted(((made[i]["vec_id"], n, made[c]["vec_id"], c == i) for i, (n, c) in enumerate(want)), key=repr)
    assert sum(n for n, _ in want) >= 100
