"""How the wording of sources differs within a language, counted through a transducer.

The kept terms of a language, in byte order, become minimal acyclic transducers: states
with equal futures are one state, and the outputs along a term's path add up to its
ordinal, its place among all kept terms of the language.  Terms are built in sorted runs of
at most ``RUN`` terms, one transducer each, whose ordinals continue those of the run before;
so no task holds a whole vocabulary.

The whole text then streams through the transducers for exact counts per source; with
larger vocabularies than ``BROADCAST`` bytes it streams once per part of that size.  From
then on a term is its ordinal: counts are short rows of numbers, ties fall in ordinal order,
and the comparison of all sources of a language works on dense pieces of ``SPAN`` ordinals.
"""

from __future__ import annotations

import pickle
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from airshed.llm.minhash import _grouped
from airshed.llm.terms import Numbers, pieces, splitter
from airshed.session import kept

TABLE = splitter()
LEAST_DOCUMENTS = 10
TOP = 10
SCALE = 1_000_000_000
RUN = 100_000
BROADCAST = 48_000_000
#: Entries a task gathers before it passes them on.
GATHERED = 1_000_000
SPAN = 4096
SOURCES = 64


class Transducer:
    """Terms to ordinals; transitions are sorted by (state, byte)."""

    def __init__(self, keys: np.ndarray, targets: np.ndarray, outputs: np.ndarray, final: np.ndarray,
                 start: int, first: int):
        self.keys, self.targets, self.outputs = keys, targets, outputs
        self.final, self.start, self.first = final, start, first

    @classmethod
    def load(cls, model: bytes) -> Transducer:
        return cls(**pickle.loads(model))

    def ordinals(self, terms: list[bytes]) -> np.ndarray:
        """The ordinal of each term, -1 for those that are not kept; all terms take a step
        at a time."""
        out = np.full(len(terms), -1, dtype=np.int64)
        if not len(self.keys) or not terms:
            return out
        size = np.fromiter(map(len, terms), np.int64, len(terms))
        data = np.frombuffer(b"".join(terms), dtype=np.uint8)
        begin = np.cumsum(size) - size
        live = np.arange(len(terms))
        state = np.full(len(terms), self.start, dtype=np.int64)
        total = np.full(len(terms), self.first, dtype=np.int64)
        step = 0
        while len(live):
            done = size[live] == step
            end = live[done]
            out[end] = np.where(self.final[state[done]], total[done], -1)
            live, state, total = live[~done], state[~done], total[~done]
            key = state * 256 + data[begin[live] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            live, at = live[hit], at[hit]
            state, total = self.targets[at].astype(np.int64), total[hit] + self.outputs[at]
            step += 1
        return out


def build(terms: list[bytes], first: int = 0) -> Transducer:
    """The minimal transducer of sorted distinct terms; ordinals start at ``first``.

    A state is closed as soon as no later term can reach it; a closed state that equals an
    earlier one is replaced by it.
    """
    known: dict[tuple, int] = {}
    words: list[int] = []  # number of terms that start in a closed state
    # The open path: per depth whether a term ends there, and the closed transitions.
    path: list[list] = [[False, []]]

    def close(node: list) -> int:
        signature = (node[0], tuple(node[1]))
        state = known.get(signature)
        if state is None:
            state = known[signature] = len(words)
            words.append(int(node[0]) + sum(words[t] for _, t in node[1]))
        return state

    before = b""
    for term in terms:
        same = 0
        while same < len(before) and same < len(term) and before[same] == term[same]:
            same += 1
        while len(path) > same + 1:
            node = path.pop()
            path[-1][1].append((before[len(path) - 1], close(node)))
        path.extend([False, []] for _ in range(len(term) - same))
        path[-1][0] = True
        before = term
    while len(path) > 1:
        node = path.pop()
        path[-1][1].append((before[len(path) - 1], close(node)))
    start = close(path[0])

    keys, targets, outputs = [], [], []
    final = np.zeros(len(words), dtype=bool)
    for (ends, moves), state in known.items():  # in order of their state
        final[state] = ends
        passed = int(ends)
        for byte, target in moves:
            keys.append(state * 256 + byte)
            targets.append(target)
            outputs.append(passed)
            passed += words[target]
    return Transducer(np.array(keys, dtype=np.int64), np.array(targets, dtype=np.int32),
                      np.array(outputs, dtype=np.int32), final, start, first)


def _plain(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    empty = F.lit("")
    return docs.select(F.coalesce(docs[lang].cast("string"), empty).alias("lang"),
                       F.coalesce(docs[source].cast("string"), empty).alias("source"),
                       docs[text].cast("binary").alias("text"))


def kept_terms(plain: DataFrame, least: int) -> DataFrame:
    """Rows (lang, term) of the terms in at least ``least`` documents of their language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[str, Counter] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, count in got.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(count), pa.string()), pa.array(list(count), pa.binary()),
                     pa.array(list(count.values()), pa.int64())], names=["lang", "term", "df"])
            got.clear()

        for batch in batches:
            for i, (lang, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2))):
                terms = set()
                for words in pieces(text.as_py(), TABLE):
                    terms.update(words)
                got.setdefault(lang, Counter()).update(terms)
                if i % 64 == 0 and sum(map(len, got.values())) > GATHERED:
                    yield from rows()
        yield from rows()

    counts = plain.mapInArrow(run, "lang string, term binary, df long")
    return counts.groupBy("lang", "term").agg(F.sum("df").alias("df")).filter(F.col("df") >= least).select("lang", "term")


def vocabulary(terms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows (lang, term, ordinal), rows (lang, first, low, model) of transducers).

    ``first`` and ``low`` are the smallest ordinal and term of a transducer.  Terms are dealt by range and sorted; runs end with their task, their language or after
    ``RUN`` terms, and a running total over the runs gives each its first ordinal.
    """
    schema = "lang string, task int, run int, place int, term binary"

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, run, lang, place = TaskContext.get().partitionId(), 0, None, 0
        for batch in batches:
            runs, places = [], []
            for value in batch["lang"]:
                if value != lang or place >= RUN:
                    run, place, lang = run + 1, 0, value
                runs.append(run)
                places.append(place)
                place += 1
            yield pd.DataFrame({"lang": batch["lang"], "task": task, "run": runs, "place": places, "term": batch["term"]})

    dealt = kept(terms.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
                 .mapInPandas(number, schema), "terms")
    runs = dealt.groupBy("lang", "task", "run").agg(F.count(F.lit(1)).alias("terms"))
    # One row per run of up to RUN terms.
    before = Window.partitionBy("lang").orderBy("task", "run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("first", F.coalesce(F.sum("terms").over(before), F.lit(0)))
    placed = dealt.join(runs.drop("terms"), ["lang", "task", "run"]).select(
        "lang", "task", "run", "first", "term", (F.col("first") + F.col("place")).alias("ordinal"))
    placed = kept(placed, "vocabulary")

    def make(group: pd.DataFrame) -> list[tuple]:
        one = group.iloc[0]
        t = build([bytes(b) for b in group["term"]], int(one["first"]))
        return [(one["lang"], int(one["first"]), bytes(one["term"]), pickle.dumps(t.__dict__, protocol=5))]

    models = _grouped(placed, ["lang", "task", "run"], ["ordinal"], make, "lang string, first long, low binary, model binary")
    return placed.select("lang", "term", "ordinal"), kept(models, "transducers")


def _ordinals(terms: list[bytes], runs: list[tuple[bytes, Transducer]]) -> np.ndarray:
    """Ordinals of terms by the runs of a language, which are sorted by their first term;
    each term goes through the one run whose range it falls in."""
    order = sorted(range(len(terms)), key=terms.__getitem__)
    spread = [terms[i] for i in order]
    out = np.full(len(terms), -1, dtype=np.int64)
    ends = [bisect_left(spread, low) for low, _ in runs] + [len(spread)]
    for (_, t), a, b in zip(runs, ends, ends[1:]):
        out[order[a:b]] = t.ordinals(spread[a:b])
    return out


def _stream(plain: DataFrame, models: list) -> DataFrame:
    """Rows (lang, source, ordinal, n): partial counts of the terms that the models know."""
    sent = plain.sparkSession.sparkContext.broadcast(
        sorted((r["lang"], bytes(r["low"]), bytes(r["model"])) for r in models))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[str, list] = {}
        for lang, low, model in sent.value:
            runs.setdefault(lang, []).append((low, Transducer.load(model)))
        numbers: dict[str, Numbers] = {}
        got: dict[tuple, list] = {}
        held = 0

        def rows() -> Iterator[pa.RecordBatch]:
            ordinals = {lang: _ordinals(list(n), runs[lang]) for lang, n in numbers.items()}
            for (lang, source), parts in got.items():
                found = ordinals[lang][np.concatenate(parts)]
                at, n = np.unique(found[found >= 0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array([source] * len(at), pa.string()),
                     pa.array(at), pa.array(n.astype(np.int64))], names=["lang", "source", "ordinal", "n"])
            numbers.clear()
            got.clear()

        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if lang not in runs:
                    continue
                number = numbers.setdefault(lang, Numbers()).__getitem__
                for terms in pieces(text.as_py(), TABLE):
                    got.setdefault((lang, source), []).append(np.fromiter(map(number, terms), np.int32, len(terms)))
                    held += len(terms)
                if held > 2 * GATHERED:
                    yield from rows()
                    held = 0
        yield from rows()

    return plain.mapInArrow(run, "lang string, source string, ordinal long, n long")


def recount(plain: DataFrame, models: DataFrame) -> DataFrame:
    """Rows (lang, source, ordinal, n) of all kept terms, counted by the transducers.

    What is sent to the executors at once is bounded by ``BROADCAST`` and one run; larger
    vocabularies are counted part by part, each over the whole text.
    """
    sizes = models.select("lang", "first", F.length("model").alias("bytes"))
    part = F.floor(F.sum("bytes").over(Window.orderBy("lang", "first")) / BROADCAST)
    models = kept(models.join(sizes.select("lang", "first", part.alias("part")), ["lang", "first"]), "transducer-parts")
    counts = _stream(plain, []) if models.isEmpty() else None
    for row in models.select("part").distinct().orderBy("part").collect():
        some = _stream(plain, models.filter(F.col("part") == row["part"]).select("lang", "low", "model").collect())
        counts = some if counts is None else counts.unionByName(some)
    return kept(counts.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n")), "counts")


def share(count: str, total: str) -> Column:
    """1 + floor(10**9 * count / total) for 0 <= count <= total, by long division in digits
    of 1000, so that no product overflows."""
    digits, rest = [], f"({count})"
    for worth in (1_000_000, 1000, 1):
        digits.append(f"{rest} * 1000L div ({total}) * {worth}L")
        rest = f"({rest} * 1000L % ({total}))"
    return F.expr(" + ".join(["1L", *digits]))


def _shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The same for whole arrays."""
    out, rest = np.ones(count.shape, dtype=np.int64), count
    for worth in (1_000_000, 1000, 1):
        rest = rest * 1000
        out += rest // total * worth
        rest = rest % total
    return out


def _term_rows(counts: DataFrame, groups: DataFrame, terms: DataFrame, top: int) -> DataFrame:
    whole = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("m"))
    total = groups.groupBy("lang").agg(F.sum("total").alias("all"))
    both = counts.join(groups, ["lang", "source"]).join(whole, ["lang", "ordinal"]).join(total, "lang")
    both = both.filter("n > 0").select(
        "lang", "source", "ordinal", share("n + 2", "total + 2 * kept").alias("p"), share("m + 2", "all + 2 * kept").alias("q"))
    both = both.filter("p > q").withColumn("value", F.expr("(p - q) * (p - q) div (p + q)"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal"))
    best = both.withColumn("rank", rank).filter(F.col("rank") <= top)
    return best.join(terms, ["lang", "ordinal"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value", "rank")


def _compare(group: pd.DataFrame) -> list[tuple]:
    """Rows (lang, a, b, value) of the pairs of sources in a piece of the vocabulary."""
    head = group[group["place"] < 0]
    width, lang = int(head["width"].iloc[0]), head["lang"].iloc[0]
    names, side = head["source"].to_list(), head["side"].to_numpy()
    number = {s: i for i, s in enumerate(names)}
    n = np.zeros((len(names), width), dtype=np.int64)
    body = group[group["place"] >= 0]
    n[body["source"].map(number).to_numpy(dtype=np.int64), body["place"].to_numpy()] = body["n"].to_numpy()
    total = head["total"].to_numpy(dtype=np.int64)[:, None]
    p = _shares(n + 2, np.maximum(total, 1))
    out = []
    for i in range(len(names)):
        rest = [j for j in range(len(names)) if (side[j] > side[i] if side.max() else j > i)]
        if rest:
            value = ((p[rest] - p[i])**2 // (p[rest] + p[i])).sum(axis=1)
            out += [(lang, names[i], names[j], int(v)) for j, v in zip(rest, value)]
    return out


def _pair_rows(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """All pairs of sources of a language, in blocks of sources and pieces of the vocabulary."""
    blocks = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / SOURCES).alias("blocks"))
    members = groups.join(blocks, "lang").withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks")))

    def numbers(count: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), count.cast("long") - 1))

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.withColumn("with", numbers(F.col("blocks"))).select(
            "lang", "span", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"),
            (F.col("block") > F.col("with")).cast("int").alias("side"), "source",
            (F.col("total") + 2 * F.col("kept")).alias("total"), "place", "n",
            F.least(F.lit(SPAN), F.col("kept") - F.col("span") * SPAN).alias("width"))

    spans = F.greatest(F.lit(1), F.ceil(F.col("kept") / SPAN))
    heads = members.withColumn("span", numbers(spans)).withColumns({"place": F.lit(-1).cast("long"), "n": F.lit(0).cast("long")})
    body = counts.join(members, ["lang", "source"]).withColumns(
        {"span": F.expr(f"ordinal div {SPAN}"), "place": F.col("ordinal") % SPAN})
    tasks = dealt(heads).unionByName(dealt(body))
    found = _grouped(tasks, ["lang", "span", "i", "j"], [], _compare, "lang string, a string, b string, value long")
    both = F.inline(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                            F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    sums = found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")).select("lang", "value", both)
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return sums.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
          least: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) on the wording of sources.

    Part ``pair`` has every other source of the language, the most different first; part
    ``term`` the ``top`` kept terms that a source uses more than its language does, the most
    telling first.  Null text, lang and source count as ''.  Ties rank by the bytes of the
    item.  A language without kept terms gives pairs of value 0; one with a single source
    gives no pairs; an empty table gives no rows.  Repeated rows are documents of their own;
    whole texts are read, in pieces; other columns are not read.
    """
    plain = _plain(docs, text, lang, source)
    terms, models = vocabulary(kept_terms(plain, least))
    counts = recount(plain, models)
    size = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    groups = (plain.select("lang", "source").distinct()
              .join(counts.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
              .join(size, "lang", "left")
              .select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "kept")]))
    groups = kept(groups, "groups")
    return _pair_rows(counts, groups).unionByName(_term_rows(counts, groups, terms, top))
