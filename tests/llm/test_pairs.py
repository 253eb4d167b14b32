"""Operators on pairs of documents or vectors, against plain versions."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from airshed.llm import graphs, minhash, repeats, vectors

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed):
    draw = random.Random(seed)
    return [draw.choice("abcdefghijklmnop") + str(draw.randrange(400)) for _ in range(n)]


def corpus():
    """Near copies in chains and stars, exact copies, a passage in many texts, edge cases."""
    out, base = [], words(200, 1)
    for i in range(12):  # every step changes a few words, so the ends of the chain differ
        base = list(base)
        for k in random.Random(i).sample(range(200), 3):
            base[k] = f"new{i}x{k}"
        out.append(" ".join(base))
    passage = words(70, 2)
    out += [" ".join(words(60, 50 + i) + passage + words(40, 90 + i)) for i in range(25)]
    out += [" ".join(passage)] * 3
    out += ["", None, "   \n\t ", "One two", "one TWO", "one two three four five", "one two three four",
            "É a b c d", "é a b c d"]
    out += [" ".join(words(300, 7)).upper(), " ".join(words(300, 7))]
    out += [" ".join(words(8, 30) + [w]) for w in ("x", "y", "z")]
    draw = random.Random(3)
    near = words(120, 8)
    for i in range(40):
        out.append(" ".join(w if draw.random() > 0.03 else f"e{i}" for w in near))
    ids = list(range(len(out)))
    draw.shuffle(ids)
    return list(zip(ids, out))


@pytest.fixture(scope="module")
def rows():
    return corpus()


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)


def test_near_duplicates_are_those_of_all_pairs(spark, rows):
    got = {r["doc_id"]: r for r in minhash.link_documents(frame(spark, rows)).collect()}
    want = brute.near_duplicates(rows)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())


def test_blocks_find_what_stars_miss(spark, rows, monkeypatch):
    """Small blocks, so that clusters meet in pairs of blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    got = {r["doc_id"]: r["component_id"] for r in minhash.link_documents(frame(spark, rows)).collect()}
    assert got == {i: c for i, (_, c) in brute.near_duplicates(rows).items()}


@pytest.mark.parametrize("block", [minhash.BLOCK, 16])
def test_copies_of_a_passage_that_stands_in_longer_documents(spark, monkeypatch, block):
    """In every bucket of the two copies the smallest id is a longer document, unlike both."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    passage = words(300, 11)
    near = list(passage)
    for k in range(30, 300, 55):
        near[k] = f"other{k}"
    rows = [(i, " ".join(words(170, 1000 + i) + passage + words(180, 5000 + i))) for i in range(3000)]
    rows += [(9000, " ".join(passage)), (9001, " ".join(near))]
    got = {r["doc_id"]: r["component_id"] for r in minhash.link_documents(frame(spark, rows)).collect()}
    assert got == {i: min(i, 9000) for i, _ in rows}


def test_near_duplicates_of_odd_rows(spark):
    rows = [(5, "a b c d e f", "x", 1), (5, "a b c d e f", "x", 1), (2, "a b c d e f", "y", 2),
            (None, "a b c d e f", None, 3), (None, None, None, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component string, n int").select(
        "*", F.lit(1).alias("key"), F.lit(2).alias("rep"), F.lit(3).alias("doc"))
    got = sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in minhash.link_documents(df).collect())
    assert got == [(-1, -1, True), (-1, -1, True), (2, 2, True), (5, 2, False), (5, 2, False)]
    assert minhash.link_documents(df.limit(0)).count() == 0


def test_signature_borrows_for_empty_bins():
    one = minhash.signature(np.array([5], dtype=np.uint64))
    assert (one == 5).all()
    draw = np.random.default_rng(0)
    a = np.unique(draw.integers(0, 2**63, 4000).astype(np.uint64))
    same = [(minhash.signature(a[: 3000]) == minhash.signature(a[500:3500])).mean()]
    assert abs(same[0] - 2500 / 3500) < 0.15


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 50), (100, 60), (60, 60), (100, 50)]
    got = dict(graphs.components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, 50: 50, 60: 50, 100: 50}
    assert graphs.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_of_one_node_are_dealt_to_many_tasks(spark):
    links = spark.range(1, 20001).select(F.col("id").alias("a"), F.lit(0).cast("long").alias("b"))
    got = graphs.components(links.union(spark.createDataFrame([(30000, 20000)], "a long, b long")))
    assert got.filter("component = 0").count() == 20002 == got.count()
    for large in (True, False):
        plan = graphs._star(links, large)._jdf.queryExecution().executedPlan().toString()
        joins = [line for line in plan.splitlines() if "Join" in line]
        assert joins and all("part" in line for line in joins)


@pytest.mark.parametrize("chunk", [repeats.CHUNK_BYTES, 3000])
def test_repeats_are_those_of_all_windows(spark, rows, monkeypatch, chunk):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(repeats, "BUCKET_WORDS", 500)
    out = repeats.remove_repeats(frame(spark, rows).repartition(3), with_text=True).collect()
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out}
    assert got == brute.repeats(rows)
    texts = dict(rows)
    for r in out:
        assert sum(r["spans"][1::2]) == r["n_removed"]
        assert r["n_removed"] or r["text"] == (texts[r["doc_id"]] or "")


def test_repeats_of_odd_rows(spark):
    long = " ".join(words(60, 4))
    rows = [(3, long), (3, long), (1, "x " + long), (None, long), (7, None), (8, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", F.lit(1).alias("key"), F.lit(b"1").alias("data"), F.lit(2).alias("chunk"))
    got = sorted((r["doc_id"] or -1, r["n_words"], r["n_removed"]) for r in repeats.remove_repeats(df).collect())
    assert got == [(-1, 60, 0), (1, 61, 0), (3, 60, 60), (3, 60, 60), (7, 0, 0), (8, 0, 0)]
    assert repeats.remove_repeats(df.limit(0)).count() == 0


def points():
    draw = np.random.default_rng(5)
    out, i = [], 0
    for label in (0, 1, None):
        for _ in range(6):
            centre = draw.standard_normal(32)
            for _ in range(20):
                out.append((i, (centre + draw.standard_normal(32) * 0.13).tolist(), label))
                i += 1
    same = out[0][1]
    return out + [(i + k, same, 0) for k in range(4)] + [(i + 9, same, 1), (i + 10, [2 * x for x in same], 0)]


def plain_links(rows, least=0.98):
    unit = {}
    for i, v, label in rows:
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            unit[i] = (label, np.array(v) / np.linalg.norm(v))
    links = [(a, b) for a in unit for b in unit
             if a < b and unit[a][0] == unit[b][0] and len(unit[a][1]) == len(unit[b][1])
             and unit[a][1] @ unit[b][1] >= least]
    root = brute.roots([r[0] for r in rows], links)
    n = {i: 0 for i in root}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    return {i: (n[i], root[i]) for i in root}


@pytest.mark.parametrize("block", [512, 7])
def test_vectors_are_those_of_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    rows = points()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.link_vectors(df).collect()}
    want = plain_links(rows)
    assert sum(n for n, _ in want.values()) > 100
    assert got == want


def test_vectors_of_odd_rows(spark):
    rows = [(1, [1.0, 0.0], 0), (2, None, 0), (3, [0.0, 0.0], 0), (4, [float("nan"), 1.0], 0), (5, [1.0, None], 0),
            (6, [float("inf"), 1.0], 0), (7, [], 0), (8, [1.0, 0.0, 0.0], 0), (9, [2.0, 0.0], 0), (10, [2.0, 0.0], None),
            (None, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (11, [-1.0, 0.0], 0), (12, [-1.0, -0.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").select(
        "*", F.lit(1).alias("id"), F.lit("x").alias("rep"), F.lit("x").alias("kept"))
    got = sorted(((r["vec_id"] or -1), r["n_links"], r["component_id"] or -1, r["kept"])
                 for r in vectors.link_vectors(df).collect())
    alone = [(i, 0, i, True) for i in (2, 3, 4, 5, 6, 7, 8, 10)]
    assert got == sorted([(-1, 0, -1, True), (1, 1, 1, True), (1, 1, 1, True), (9, 1, 1, False), (11, 1, 11, True),
                          (12, 1, 11, False), *alone])
    assert vectors.link_vectors(df.limit(0)).count() == 0
