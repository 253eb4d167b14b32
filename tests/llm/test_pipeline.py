"""Every stage of the pipeline on what the one before has kept, against plain versions."""

import collections

import brute
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from airshed.llm import mixing, toxicity

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows before and after each stage."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, out[-1], FOLDER).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_columns_stay(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_toxic_documents_go_and_others_stay(spark, stages):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    scored = toxicity.classify(stages[0], toxicity.train(stages[0], labels))
    clean = {r["doc_id"] for r in scored.filter("predicted = 0").collect()}
    assert dict(texts(stages[1])) == {i: t for i, t in texts(stages[0]) if i in clean}
    assert 0 < len(clean) < stages[0].count()


def test_lines(stages):
    before = {r["doc_id"]: r for r in stages[1].collect()}
    sites, first = collections.defaultdict(set), {}
    for i, r in sorted(before.items()):
        for line in (r["text"] or "").split("\n"):
            if line.strip(" \t\r"):
                sites[line].add(r["source"])
                first.setdefault(line, i)
    want = {}
    for i, r in before.items():
        lines = r["text"].split("\n")
        left = [x for x in lines if len(sites[x]) < 10 or first[x] == i]
        if len(left) == len(lines) or any(x.strip(" \t\r") for x in left):
            want[i] = "\n".join(left)
    assert dict(texts(stages[2])) == want
    assert all(r["n_chars"] == len(r["text"]) or r["text"] == before[r["doc_id"]]["text"] for r in stages[2].collect())


def test_one_of_each_group_stays(stages):
    rows = texts(stages[2])
    want = {i for i, (_, root) in brute.near_duplicates(rows).items() if i == root}
    assert {i for i, _ in texts(stages[3])} == want and dict(texts(stages[3])).items() <= dict(rows).items()


def test_mix_takes_effect(stages):
    plan = {r["doc_id"]: r["taken"] for r in mixing.plan(stages[3]).collect()}
    got = collections.Counter()
    for i, t in texts(stages[4]):
        got[i] += len(brute.words(t))
    assert {i: n for i, n in plan.items() if n} == {i: n for i, n in got.items() if n}


def test_sequences_hold_all_ids(stages):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = collections.Counter()
    for i, t in texts(stages[4]):
        want[i] += len(tokenizer.encode(t, add_special_tokens=False).ids) + 1
    got, used = collections.Counter(), collections.Counter()
    for r in stages[5].select("doc_id", "length", "sequence_id", F.length("ids").alias("bytes")).collect():
        assert r["bytes"] == 4 * r["length"]
        got[r["doc_id"]] += r["length"]
        used[r["sequence_id"]] += r["length"]
    assert got == want and max(used.values()) <= 1024


def test_run_is_its_stages(spark, stages):
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.count() == stages[-1].count() and out.columns == stages[-1].columns


@pytest.mark.parametrize("number", range(4))
def test_stages_on_odd_rows(spark, number):
    rows = [(1, "a b c", "en", "s", 5), (1, "a b c", "en", "s", 5), (None, None, None, None, None), (2, "", "en", None, 0),
            (3, "x " * 2000, "en", "t", 4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").select(
        "*", F.lit(1).alias("key"), F.lit("y").alias("line"), F.lit(2).alias("size"))
    name, stage = corpus_pipeline.STAGES[number]
    out = stage(spark, df, FOLDER)
    assert out.columns == df.columns
    ids = collections.Counter(r["doc_id"] for r in out.collect())
    if name != "mixing":
        assert ids == {1: 2, None: 1, 2: 1, 3: 1}
    assert stage(spark, df.limit(0), FOLDER).count() == 0
