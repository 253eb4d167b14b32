"""Ranked search, nearest neighbours and the audit of sources, against plain versions."""

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from airshed.llm import divergence, neighbours, ranking

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text, pattern):
    return re.findall(pattern, (text or "").translate(LOWER))


def some_text(draw, n, size=40):
    """Words of uneven frequency, with capitals, digits, signs and other letters."""
    out = []
    for _ in range(n):
        w = f"w{int(draw.paretovariate(0.7)) % size}"
        out.append(draw.choice([w, w, w.upper(), w + ",", f"({w})", w + "é", "ÀB" + w, "7", f"{w}-{w}"]))
    return " ".join(out)


def corpus(n=400, seed=4):
    draw = random.Random(seed)
    rows = [(i, some_text(draw, draw.choice([1, 5, 40, 120])), draw.choice(["en", "en", "en", "de", None, "fr"]),
             draw.choice(["a", "b", "c", "Ü", None])) for i in range(n)]
    rows += [(n, None, "en", "only null"), (n + 1, "", "es", "x"), (n + 2, "-- 12 --", "es", "y"),
             (n + 3, rows[0][1], "en", "a"), (n + 4, "w1 " * 30_000, "en", "b"), (n + 5, "q" * 3_000_000 + " w1", "de", "a")]
    return [(i, t, lang, source, 0) for i, t, lang, source in rows]


# --- ranked search ------------------------------------------------------------------------

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def plain_ranking(rows, items, k=10):
    terms = [(i, collections.Counter(split(t, TERM))) for i, t, *_ in rows]
    terms = [(i, c) for i, c in terms if c]
    n, total = len(terms), sum(sum(c.values()) for _, c in terms)
    df = collections.Counter(w for _, c in terms for w in c)
    out = []
    for item in sorted({i for i, _ in items if i is not None}):
        asked = {w for i, t in items if i == item for w in split(t, TERM)}
        scored = []
        for i, c in terms:
            m = 10 + 90 * sum(c.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m))
                        for w in asked if w in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k])]
    return out


@pytest.mark.parametrize("postings,short,step", [(ranking.POSTINGS, ranking.SHORT, ranking.STEP), (400, 30, 16), (400, 0, 8)])
def test_ranking_is_that_of_all_documents(spark, monkeypatch, postings, short, step):
    monkeypatch.setattr(ranking, "STEP", step)
    rows = corpus()
    draw = random.Random(9)
    items = [(i, some_text(draw, draw.choice([1, 3, 20]))) for i in range(30)]
    items += [(50, None), (51, ""), (52, "absent words"), (None, "w1"), (53, "W1 w1"), (53, "w2"), (53, "w2")]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    index = ranking.build(docs, postings=postings)
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = [tuple(r) for r in ranking.search(index, asked, short=short).collect()]
    assert sorted(got) == plain_ranking(rows, items)


def test_best_documents_of_lists():
    draw = np.random.default_rng(3)
    for case in range(60):
        n = int(draw.integers(1, 6000))
        lists = [(np.sort(draw.choice(n, int(draw.integers(1, n + 1)), replace=False)), None) for _ in range(draw.integers(1, 9))]
        lists = [(d, draw.integers(0, 4 if case % 2 else 1000, len(d))) for d, _ in lists]
        total = np.zeros(n, dtype=np.int64)
        for d, s in lists:
            total[d] += s
        order = [d for d in np.lexsort((np.arange(n), -total)) if total[d] > 0][:10]
        docs, scores = ranking.best_of(lists, 10, n, short=int(draw.choice([0, 50, 3000])))
        assert docs.tolist() == order and scores.tolist() == total[order].tolist()


def test_ranking_of_odd_rows(spark):
    rows = [(3, "a b", "x"), (3, "a b", "x"), (None, "a b", None), (1, "a", None), (2, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, term string").select(
        "*", *[F.lit(1).alias(c) for c in ("block", "df", "docs", "counts", "ids", "sizes", "tokens", "key")])
    items = spark.createDataFrame([(7, "A", 1)], "item_id long, text string, weight int").select(
        "*", *[F.lit(1).alias(c) for c in ("item", "term", "items", "chunk")])
    got = [tuple(r) for r in ranking.search(ranking.build(docs), items).orderBy("rank").collect()]
    assert [(i, r, d) for i, r, d, _ in got] == [(7, 1, 1), (7, 2, 3), (7, 3, 3), (7, 4, None)]
    assert ranking.search(ranking.build(docs.limit(0)), items).count() == 0
    assert ranking.search(ranking.build(docs), items.limit(0)).count() == 0


# --- audit of sources ---------------------------------------------------------------------

LETTERS = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


def plain_audit(rows, least=10, top=10):
    docs = [(lang or "", source or "", split(t, LETTERS)) for _, t, lang, source, *_ in rows]
    df = collections.Counter((lang, w) for lang, _, ws in docs for w in set(ws))
    keep = collections.defaultdict(list)
    for (lang, w), n in df.items():
        if n >= least:
            keep[lang].append(w)
    count = collections.Counter((lang, s, w) for lang, s, ws in docs for w in ws)
    whole = collections.Counter((lang, w) for lang, _, ws in docs for w in ws)
    groups = sorted({(lang, s) for lang, s, _ in docs})

    def shares(of, words):
        n = sum(of(w) for w in words)
        return {w: 1 + 10**9 * (of(w) + 2) // (n + 2 * len(words)) for w in words}

    p = {(lang, s): shares(lambda w: count[lang, s, w], keep[lang]) for lang, s in groups}
    q = {lang: shares(lambda w: whole[lang, w], keep[lang]) for lang in {g[0] for g in groups}}
    out = []
    for lang, s in groups:
        pairs = [(sum((x - p[lang, o][w])**2 // (x + p[lang, o][w]) for w, x in p[lang, s].items()), o)
                 for two, o in groups if two == lang and o != s]
        terms = [((x - q[lang][w])**2 // (x + q[lang][w]), w) for w, x in p[lang, s].items()
                 if count[lang, s, w] and x > q[lang][w]]
        for part, found in (("pair", pairs), ("term", terms)):
            found.sort(key=lambda f: (-f[0], f[1].encode()))
            out += [(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(found[:None if part == "pair" else top])]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_audit_is_that_of_plain_counts(spark, monkeypatch, small):
    if small:
        for name, value in {"RUN": 7, "BROADCAST": 3000, "GATHERED": 50, "SPAN": 5, "SOURCES": 2}.items():
            monkeypatch.setattr(divergence, name, value)
    rows = corpus()
    got = divergence.audit(spark.createDataFrame(rows, DOCS).repartition(4))
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == plain_audit(rows)


def test_audit_of_odd_rows(spark):
    rows = [(i % 3 or None, "Alpha beta é", "en", "s" if i % 2 else None, 0) for i in range(24)]
    rows += [(1, None, None, None, 0), (1, "alone", "xx", "one", 0)]
    df = spark.createDataFrame(rows, DOCS).select("*", *[F.lit(3).alias(c) for c in (
        "term", "ordinal", "part", "item", "value", "rank", "kept", "total", "n", "block", "blocks", "span")])
    assert sorted(tuple(r) for r in divergence.audit(df).collect()) == plain_audit(rows)
    assert divergence.audit(df.limit(0)).count() == 0


def test_transducer_is_minimal_and_numbers_its_terms():
    draw = random.Random(1)
    for size in (0, 1, 2, 40, 3000):
        terms = sorted({("".join(draw.choice("abé") for _ in range(draw.randrange(0, 9))) + draw.choice(["ing", "s", ""])
                         ).encode() for _ in range(size)})
        t = divergence.build(terms, 100)
        assert t.ordinals(terms).tolist() == list(range(100, 100 + len(terms)))
        other = [w + b"x" for w in terms] + [w[:-1] for w in terms if w[:-1] not in set(terms)] + [b"\xff"]
        assert (t.ordinals(other) == -1).all()
        # States of the minimal automaton: distinct sets of endings.
        ends = collections.defaultdict(set)
        for w in terms:
            for i in range(len(w) + 1):
                ends[w[:i]].add(w[i:])
        assert len(t.final) == max(1, len({frozenset(e) for e in ends.values()}))


def test_shares_do_not_overflow(spark):
    cases = [(0, 7), (7, 7), (1, 3), (8 * 10**15 - 1, 8 * 10**15), (123456789012345, 9 * 10**15 // 2)]
    got = spark.createDataFrame(cases, "c long, t long").select(divergence.share("c", "t")).collect()
    want = [1 + 10**9 * c // t for c, t in cases]
    assert [r[0] for r in got] == want
    assert divergence._shares(*np.array(cases, dtype=np.int64).T).tolist() == want


# --- nearest neighbours -------------------------------------------------------------------


def plain_nearest(vectors, nearest=20):
    """{query: [(id, score)]} by all inner products."""
    ids = sorted(vectors)
    x = np.stack([vectors[i] for i in ids])
    out = {}
    for i in (i for i in ids if i % 20 == 0):
        score = x @ vectors[i]
        out[i] = [(ids[k], score[k]) for k in np.lexsort((ids, -score)) if ids[k] != i][:nearest]
    return out


def checked(rows, vectors):
    got = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
        assert abs(r["score"] - vectors[r["query_id"]] @ vectors[r["vec_id"]]) < 1e-12
    for q, found in got.items():
        assert len({i for i, _ in found}) == len(found) and q not in dict(found)
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
    want = plain_nearest(vectors)
    assert {q: len(f) for q, f in got.items()} == {q: len(f) for q, f in want.items() if f}
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in f}) for q, f in want.items())
    return hits / sum(map(len, want.values()))


@pytest.mark.parametrize("shard", [neighbours.SHARD, 300])
def test_recall_on_the_given_vectors(spark, shard):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    known = neighbours.members(df)
    got = neighbours.search(neighbours.build(known, shard=shard), known, F.col("id") % 20 == 0).collect()
    recall = checked(got, {r["vec_id"]: np.array(r["embedding"], dtype=np.float64) for r in df.collect()})
    print("recall", recall)
    assert recall >= 0.9


def test_recall_of_uneven_lengths_and_copies(spark):
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(12, 16)) * 3
    x = centres[draw.integers(0, 12, 1500)] + draw.normal(size=(1500, 16))
    x *= draw.uniform(0.2, 5, (1500, 1))
    x[500:900] = x[0]  # one vector with 400 copies
    x[900:905] = -x[0]
    vectors = dict(enumerate(x))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "vec_id long, embedding array<double>")
    assert checked(neighbours.nearest_neighbours(df, F.col("id") % 20 == 0).collect(), vectors) >= 0.9


def test_neighbours_of_odd_rows(spark):
    rows = [(0, [1.0, 0.0], 1), (20, [1.0, 0.0], 1), (1, [0.5, 0.5], None), (2, [0.5, 0.5], 1), (40, [0.0, 0.0], 1),
            (60, None, 1), (80, [float("nan"), 1.0], 1), (100, [float("inf"), 1.0], 1), (120, [None, 1.0], 1), (140, [], 1),
            (160, [3.0], 2), (None, [9.0, 9.0], 1), (20, [1.0, 0.0], 1), (180, [-1.0, -0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").select(
        "*", *[F.lit(2).alias(c) for c in ("id", "same", "copy", "size", "vector", "place", "shard", "rank", "score")])
    got = neighbours.nearest_neighbours(df, F.col("id") % 20 == 0).collect()
    found = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: r["rank"]):
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    assert found == {0: [(20, 1.0), (1, 0.5), (2, 0.5), (180, -1.0)], 20: [(0, 1.0), (1, 0.5), (2, 0.5), (180, -1.0)],
                     180: [(1, -0.5), (2, -0.5), (0, -1.0), (20, -1.0)]}
    assert neighbours.nearest_neighbours(df.limit(0), F.col("id") % 20 == 0).count() == 0
