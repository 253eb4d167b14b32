"""Ranked lexical search over an inverted index in blocks, by hybrid TAAT-DAAT.

``build`` deals whole documents to blocks of a bounded number of postings; a block holds
for each of its terms the documents (numbers in order of their id) and the counts.  The
index is a table, so a search joins it with the terms of its queries and reads nothing else.

``search`` scores a group of queries in every block:

1. *Term at a time*: the postings of a query's short lists are summed into accumulators.
   Their sorted documents with the sums are from then on one list, with upper bounds like
   any other.
2. *Document at a time*: that list and the long ones are walked side by side in order of
   document, in steps of ``STEP`` documents.  A step whose bounds add up to less than the
   k-th best score is skipped.  In any other, lists that could not lift a document over that
   score by themselves name no candidates; they are only looked up for those that the
   others name, largest bound first, and candidates that fall behind are dropped.

The best k of a block are exact, ties included, hence so are the best k of all blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from airshed.llm.minhash import _grouped
from airshed.llm.terms import Numbers, pieces, splitter
from airshed.session import kept

TABLE = splitter(b"0123456789")
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Postings of a block (a single document may have more), and queries scored together.
POSTINGS = 2_000_000
QUERIES = 500
#: Short lists: the shortest of a query, as long as they hold so many postings together.
SHORT = 4096
STEP = 1024
INDEX = ("block long, term string, df long, docs array<int>, counts array<int>, "
         "ids array<bigint>, sizes array<bigint>, tokens long")


class _Block:
    """Postings of documents, gathered until there are enough for a block."""

    def __init__(self, number: int):
        self.number, self.postings = number, 0
        self.terms = Numbers()
        self.keys: list = []
        self.sizes: list[int] = []
        self.ids: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, key, text: bytes | None) -> None:
        found: list = []
        size = 0
        for words in pieces(text, TABLE):
            if words:
                size += len(words)
                found.append(np.unique(np.fromiter(map(self.terms.__getitem__, words), np.int64, len(words)),
                                       return_counts=True))
        if not size:
            return
        ids, counts = found[0]
        if len(found) > 1:
            ids, at = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([f[1] for f in found])).astype(np.int64)
        self.keys.append(key)
        self.sizes.append(size)
        self.ids.append(ids)
        self.counts.append(counts)
        self.postings += len(ids)

    def rows(self) -> pa.RecordBatch:
        """One row per term and, with a null term, one for the documents."""
        n = len(self.keys)
        order = sorted(range(n), key=lambda i: (self.keys[i] is None, self.keys[i] or 0))
        place = np.empty(n, dtype=np.int64)
        place[order] = np.arange(n)
        ids = np.concatenate(self.ids)
        docs = np.repeat(place, [len(i) for i in self.ids])
        by = np.lexsort((docs, ids))
        ids, docs, counts = ids[by], docs[by], np.concatenate(self.counts)[by]
        ends = np.searchsorted(ids, np.arange(len(self.terms) + 1))
        ends = np.append(ends, ends[-1]).astype(np.int32)
        df = np.diff(ends).astype(np.int64)
        df[-1] = n
        last = len(self.terms)

        def lists(values) -> pa.Array:
            offsets = pa.array(np.append(ends[:-1], ends[-2]), pa.int32())
            return pa.ListArray.from_arrays(offsets, pa.array(values, pa.int32()))

        def only_last(values: list) -> pa.Array:
            return pa.array([None] * last + [values], pa.list_(pa.int64()))

        known = [self.keys[i] for i in order if self.keys[i] is not None]
        tokens = np.zeros(last + 1, dtype=np.int64)
        tokens[-1] = sum(self.sizes)
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(last + 1, self.number)),
            pa.array([t.decode("utf-8", "replace") for t in self.terms] + [None], pa.string()),
            pa.array(df), lists(docs), lists(counts),
            only_last(known), only_last([self.sizes[i] for i in order]), pa.array(tokens)],
            names=["block", "term", "df", "docs", "counts", "ids", "sizes", "tokens"])


def build(docs: DataFrame, key: str = "doc_id", text: str = "text", postings: int = POSTINGS) -> DataFrame:
    """The index of all documents with at least one term, written to the shared folder.

    Per block and term: df, docs and counts; one more row per block, with a null term, holds
    its documents: ``ids`` (those without an id come last and are not listed), ``sizes`` in
    terms, their number as df and their sum as tokens.  Repeated rows are documents of their
    own.  Texts are read whole, in pieces.  An empty table gives no rows.
    """
    rows = docs.select(docs[key].cast("long").alias("key"), docs[text].cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        block = _Block(number)
        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                block.add(k, t.as_py())
                if block.postings >= postings:
                    yield block.rows()
                    number += 1
                    block = _Block(number)
        if block.postings:
            yield block.rows()

    return kept(rows.mapInArrow(run, INDEX), "index")


class _List:
    """A list of documents with scores and an upper bound per step."""

    __slots__ = ("docs", "scores", "starts", "most")

    def __init__(self, docs: np.ndarray, scores: np.ndarray, steps: int):
        self.docs, self.scores = docs, scores
        self.starts = np.searchsorted(docs, np.arange(steps + 1) * STEP)
        self.most = np.zeros(steps, dtype=np.int64)
        full = np.flatnonzero(np.diff(self.starts))
        if len(full):
            self.most[full] = np.maximum.reduceat(scores, self.starts[full])

    def step(self, s: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.starts[s], self.starts[s + 1]
        return self.docs[a:b], self.scores[a:b]


class _Best:
    """The k best (score, document) so far; equal scores by ascending document."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.docs, self.scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def add(self, docs: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= self.least
        docs, scores = np.append(self.docs, docs[good]), np.append(self.scores, scores[good])
        order = np.lexsort((docs, -scores))[:self.k]
        self.docs, self.scores = docs[order], scores[order]
        if len(order) == self.k:
            self.least = max(self.least, int(self.scores[-1]))


def best_of(lists: list[tuple[np.ndarray, np.ndarray]], k: int, documents: int, short: int = SHORT
            ) -> tuple[np.ndarray, np.ndarray]:
    """The k best documents and their scores, from lists (ascending documents, scores)."""
    steps = -(-documents // STEP)
    lists = sorted(lists, key=lambda x: len(x[0]))
    total, cut = 0, 0
    while cut < len(lists) and (total := total + len(lists[cut][0])) <= short:
        cut += 1
    best = _Best(k)
    walked = [_List(d, s, steps) for d, s in lists[cut:]]
    if cut:  # term at a time
        docs, at = np.unique(np.concatenate([d for d, _ in lists[:cut]]), return_inverse=True)
        sums = np.zeros(len(docs), dtype=np.int64)
        np.add.at(sums, at, np.concatenate([s for _, s in lists[:cut]]))
        if not walked:
            best.add(docs, sums)
            return best.docs, best.scores
        if len(sums) >= k:
            best.least = max(1, int(np.partition(sums, len(sums) - k)[len(sums) - k]))
        walked.append(_List(docs, sums, steps))
    bounds = np.sum([x.most for x in walked], axis=0)
    for s in range(steps):  # document at a time
        if bounds[s] < best.least:
            continue
        here = sorted((x for x in walked if x.most[s]), key=lambda x: -x.most[s])
        left = int(bounds[s])
        total = np.zeros(STEP, dtype=np.int64)
        named = np.zeros(STEP, dtype=bool)
        base = s * STEP
        at = 0
        while at < len(here) and left >= best.least:  # may name candidates
            docs, scores = here[at].step(s)
            total[docs - base] += scores
            named[docs - base] = True
            left -= int(here[at].most[s])
            at += 1
        candidates = np.flatnonzero(named)
        for x in here[at:]:  # looked up only
            candidates = candidates[total[candidates] + left >= best.least]
            if not len(candidates):
                break
            docs, scores = x.step(s)
            place = np.searchsorted(docs, candidates + base)
            place[place == len(docs)] = 0
            hit = docs[place] == candidates + base
            total[candidates[hit]] += scores[place[hit]]
            left -= int(x.most[s])
        best.add(candidates + base, total[candidates])
    return best.docs, best.scores


def _search_block(k: int, documents: int, tokens: int, short: int):
    def work(group: pd.DataFrame) -> list[tuple]:
        """Rows (item, rank here, named, doc, score) of a block's best for a group of queries."""
        head = group[group["weight"].isna()].iloc[0]
        ids, sizes = np.asarray(head["ids"], dtype=np.int64), head["sizes"]
        m = np.array([10 + 90 * int(n) * documents // tokens for n in sizes], dtype=np.int64)
        lists: dict[int, list] = {}
        rows = group[group["weight"].notna()]
        for weight, items, docs, counts in zip(rows["weight"], rows["items"], rows["docs"], rows["counts"]):
            docs, tf = np.asarray(docs, dtype=np.int64), np.asarray(counts, dtype=np.int64)
            scores = int(weight) * (1_000_000_000 * tf // (1000 * tf + 8 * m[docs]))
            for item in items:
                lists.setdefault(int(item), []).append((docs, scores))
        out = []
        for item, found in lists.items():
            docs, scores = best_of(found, k, len(sizes), short)
            out += [(item, bool(d < len(ids)), int(ids[d]) if d < len(ids) else 0, int(x))
                    for d, x in zip(docs, scores)]
        return out

    return work


def search(index: DataFrame, queries: DataFrame, k: int = 10, key: str = "item_id", text: str = "text",
           doc: str = "doc_id", short: int = SHORT) -> DataFrame:
    """Rows (key, rank, doc, score): each query's k best documents with a score above 0.

    ``index`` comes from ``build``.  Equal scores rank by ascending id, documents without an
    id last.  Queries that share an id are one query with the terms of all; queries without
    an id, without terms or without hits give no rows.  Other columns are not read.
    """
    terms = F.array_distinct(F.regexp_extract_all(
        F.translate(queries[text], "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(TERM), F.lit(0)))
    asked = (queries.select(queries[key].cast("long").alias("item"), F.explode(terms).alias("term"))
             .filter("item is not null").distinct())
    asked = kept(asked, "query-terms")
    total = index.filter("term is null").agg(F.sum("df").alias("n"), F.sum("tokens").alias("l")).first()
    documents, tokens = total["n"] or 0, total["l"] or 1
    chunks = -(-asked.agg(F.count_distinct("item")).first()[0] // QUERIES) or 1

    df = (index.filter("term is not null").select("term", "df")
          .join(asked.select("term").distinct(), "term").groupBy("term").agg(F.sum("df").alias("df")))
    weight = F.floor(1000 * F.log((2 * F.lit(documents) + 2) / (2 * F.col("df") + 1)))
    weights = df.select("term", weight.cast("long").alias("weight"))
    chunk = F.pmod(F.xxhash64("item"), F.lit(chunks))
    # A chunk bounds its queries, hence the list of those that hold a term.  Written first, so
    # that the join with the index knows its size and the index itself is not shuffled by term
    # where the terms are few.
    wanted = (asked.groupBy("term", chunk.alias("chunk")).agg(F.collect_list("item").alias("items"))
              .join(weights, "term"))
    wanted = kept(wanted, "query-lists")
    none = F.lit(None)
    lists = index.join(wanted, "term").select(
        "block", "chunk", "weight", "items", "docs", "counts", none.cast("array<bigint>").alias("ids"),
        none.cast("array<bigint>").alias("sizes"))
    heads = index.filter("term is null").select(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))).alias("chunk"),
        none.cast("long").alias("weight"), none.cast("array<bigint>").alias("items"), none.cast("array<int>").alias("docs"),
        none.cast("array<int>").alias("counts"), "ids", "sizes")
    found = _grouped(lists.unionByName(heads), ["block", "chunk"], [], _search_block(k, documents, tokens, short),
                     "item long, named boolean, doc long, score long")
    rows = found.select("item", F.when(F.col("named"), F.col("doc")).alias("doc"), "score")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc")))
    return (rows.withColumn("rank", rank).filter(F.col("rank") <= k)
            .select(F.col("item").alias(key), "rank", F.col("doc").alias(doc), "score"))
