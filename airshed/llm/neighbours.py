"""Approximate nearest neighbours by a robust-pruned directed graph per shard.

Equal vectors are one class with its smallest ids.  Classes are dealt to shards of bounded
size by their hash.  A shard's graph grows in batches: a greedy search from the middle of
the shard proposes neighbours for each new vector, and pruning keeps a proposal only if no
kept, closer one is nearer to it by the factor ``alpha``, which leaves long edges in all
directions.  Edges lead back as well; nodes with too many are pruned anew.

Largest inner product becomes smallest distance by one more component, which brings all
vectors of a shard to one length; queries have 0 there.  A beam search answers a block of
queries in every shard; what it ends with is measured again in double precision on the
original vectors.  The index is a table with one row per class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from airshed.llm.minhash import _grouped
from airshed.llm.vectors import _usable
from airshed.session import kept

NEAREST = 20
#: Vectors of a shard, bytes of their components, queries of a block.
SHARD, SHARD_BYTES, QUERIES = 8192, 64_000_000, 2048
DEGREE, PROPOSED, BEAM, ALPHA = 32, 64, 64, 1.2
#: Nodes a search opens at a time, and largest batch of new vectors.
OPENED, BATCH = 4, 512
#: Rows that are pruned or searched together.
TOGETHER = 512


class Graph:
    """Vectors with at most ``degree`` edges each; while it grows, with up to twice as many."""

    def __init__(self, x: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA):
        self.x = np.ascontiguousarray(x, dtype=np.float32)
        self.square = (self.x * self.x).sum(axis=1)
        self.degree, self.alpha = degree, np.float32(alpha)
        self.near = np.full((len(x), 2 * degree), -1, dtype=np.int32)
        self.count = np.zeros(len(x), dtype=np.int64)
        middle = self.x.mean(axis=0)
        self.start = int(np.argmin(self.square - 2 * (self.x @ middle))) if len(x) else 0

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids (-1: none) and squared distances of each query's beam, nearest first.

        Every step opens the nearest nodes not opened yet, until all of the beam are.
        """
        q = np.ascontiguousarray(queries, dtype=np.float32)
        size = (q * q).sum(axis=1)
        rows = np.arange(len(q))
        ids = np.full((len(q), beam), -1, dtype=np.int32)
        far = np.full((len(q), beam), np.inf, dtype=np.float32)
        opened = np.ones((len(q), beam), dtype=bool)
        seen = np.zeros((len(q), len(self.x)), dtype=bool)
        ids[:, 0], opened[:, 0] = self.start, False
        far[:, 0] = self.square[self.start] - 2 * (q @ self.x[self.start]) + size
        seen[:, self.start] = True
        while len(rows):
            new = ~opened[rows]
            first = new & (np.cumsum(new, axis=1) <= OPENED)
            at, column = np.nonzero(first)
            opened[rows[at], column] = True
            nodes = ids[rows[at], column]
            near = self.near[nodes]
            who = np.repeat(rows[at], near.shape[1])
            near = near.ravel()
            good = near >= 0
            who, near = who[good], near[good]
            # Nodes opened together may share neighbours.
            pair = np.unique(who * np.int64(len(self.x)) + near)
            who, near = pair // len(self.x), pair % len(self.x)
            fresh = ~seen[who, near]
            who, near = who[fresh], near[fresh]
            seen[who, near] = True
            d = self.square[near] - 2 * np.einsum("ij,ij->i", self.x[near], q[who]) + size[who]
            # Line the new ones up behind the beam of their query.
            number = np.bincount(who, minlength=len(q))
            place = np.arange(len(who)) - np.repeat(np.cumsum(number) - number, number)
            width = int(number.max()) if len(number) else 0
            some = np.flatnonzero(number)
            line = np.full(len(q), -1)
            line[some] = np.arange(len(some))
            more_ids = np.full((len(some), width), -1, dtype=np.int32)
            more_far = np.full((len(some), width), np.inf, dtype=np.float32)
            more_ids[line[who], place], more_far[line[who], place] = near, d
            all_ids = np.concatenate([ids[some], more_ids], axis=1)
            all_far = np.concatenate([far[some], more_far], axis=1)
            all_open = np.concatenate([opened[some], ~np.isfinite(more_far)], axis=1)
            order = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
            ids[some] = np.take_along_axis(all_ids, order, 1)
            far[some] = np.take_along_axis(all_far, order, 1)
            opened[some] = np.take_along_axis(all_open, order, 1)
            rows = rows[(~opened[rows]).any(axis=1)]
        return ids, far

    def _pruned(self, nodes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(edges, their number) of each node, out of its proposals (-1: none)."""
        x = self.x[ids]
        far = self.square[ids] - 2 * np.einsum("ijk,ik->ij", x, self.x[nodes]) + self.square[nodes][:, None]
        far = np.maximum(far, 0)
        far[(ids < 0) | (ids == nodes[:, None])] = np.inf
        out = np.full((len(nodes), self.degree), -1, dtype=np.int32)
        line = np.arange(len(nodes))
        alive = far.copy()
        number = np.zeros(len(nodes), dtype=np.int64)
        for _ in range(self.degree):
            best = alive.argmin(axis=1)
            there = np.isfinite(alive[line, best])
            if not there.any():
                break
            chosen = ids[line, best]
            out[line[there], number[there]] = chosen[there]
            number += there
            between = self.square[ids] - 2 * np.einsum("ijk,ik->ij", x, self.x[chosen]) + self.square[chosen][:, None]
            # Lengths are squared, so is the factor.
            alive[(self.alpha**2 * np.maximum(between, 0) <= far) & there[:, None]] = np.inf
            alive[line, best] = np.inf
        return out, number

    def _set(self, nodes: np.ndarray, ids: np.ndarray) -> None:
        for a in range(0, len(nodes), TOGETHER):
            part = nodes[a:a + TOGETHER]
            out, number = self._pruned(part, ids[a:a + TOGETHER])
            self.near[part] = -1
            self.near[part, :self.degree] = out
            self.count[part] = number

    def _lead_back(self, nodes: np.ndarray) -> None:
        """Edges from the new nodes' neighbours to them; the full ones are pruned."""
        to = self.near[nodes, :self.degree]
        source, target = np.repeat(nodes, self.degree), to.ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        hit, number = np.unique(target, return_counts=True)
        place = np.arange(len(target)) - np.repeat(np.cumsum(number) - number, number) + np.repeat(self.count[hit], number)
        fits = np.repeat(self.count[hit] + number <= self.near.shape[1], number)
        self.near[target[fits], place[fits]] = source[fits]
        room = self.count[hit] + number <= self.near.shape[1]
        self.count[hit[room]] += number[room]
        full = hit[~room]
        if len(full):
            line = np.full(len(self.x), -1)
            line[full] = np.arange(len(full))
            ids = np.full((len(full), int((self.count[full] + number[~room]).max())), -1, dtype=np.int32)
            ids[:, :self.near.shape[1]] = self.near[full]
            ids[line[target[~fits]], place[~fits]] = source[~fits]
            self._set(full, ids)

    def grow(self, proposed: int = PROPOSED) -> Graph:
        """Insert all vectors, in an order drawn by a fixed seed."""
        order = np.random.default_rng(5).permutation(len(self.x))
        order = np.append(self.start, order[order != self.start]) if len(order) else order
        done = 1
        while done < len(order):
            nodes = order[done:done + min(done, BATCH)]
            ids, _ = self.search(self.x[nodes], proposed)
            self._set(nodes, ids)
            self._lead_back(nodes)
            done += len(nodes)
        over = np.flatnonzero(self.count > self.degree)
        self._set(over, self.near[over])
        self.near = self.near[:, :self.degree]
        return self


def _one_length(x: np.ndarray) -> np.ndarray:
    """Scaled rows with one more component, so that all are of one length."""
    x = x / np.abs(x).max()
    square = (x * x).sum(axis=1)
    return np.column_stack([x, np.sqrt(np.maximum(square.max() - square, 0))])


def _stack(vectors) -> np.ndarray:
    return np.stack([np.frombuffer(v, dtype="<f8") for v in vectors])


def _usable_rows(rows: DataFrame) -> DataFrame:
    """Rows (id, same, copy, size, vector) of the usable vectors; same and copy are 128 bits of it."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        for batch in batches:
            out = []
            for i, v in zip(batch["id"], batch["vector"]):
                x = _usable(v)
                if x is not None:
                    raw = (x + 0.0).astype("<f8").tobytes()  # zeros have one sign
                    digest = xxhash.xxh3_128_digest(raw)
                    out.append((i, *np.frombuffer(digest, dtype="<i8").tolist(), len(x), raw))
            yield pd.DataFrame(out, columns=["id", "same", "copy", "size", "vector"])

    return rows.mapInPandas(run, "id long, same long, copy long, size long, vector binary")


def members(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Rows (id, same, copy, size, vector), one per id, in the shared folder."""
    plain = rows.select(rows[key].cast("long").alias("id"), rows[vector].cast("array<double>").alias("vector"))
    found = _usable_rows(plain.filter("id is not null"))
    one = Window.partitionBy("id").orderBy("same", "copy")
    return kept(found.withColumn("_n", F.row_number().over(one)).filter("_n = 1").drop("_n"), "members")


def build(rows: DataFrame, nearest: int = NEAREST, shard: int = SHARD, degree: int = DEGREE,
          proposed: int = PROPOSED, alpha: float = ALPHA) -> DataFrame:
    """The index of ``members``: rows (size, shard, place, ids, vector, near, start).

    ``ids`` has the ``nearest`` + 1 smallest ids of a class, which is all that an answer can
    need of it; ``near`` the places its edges lead to.
    """
    rank = F.row_number().over(Window.partitionBy("same", "copy").orderBy("id"))
    few = rows.select("same", "copy", "id").withColumn("n", rank).filter(F.col("n") <= nearest + 1)
    few = few.groupBy("same", "copy").agg(F.sort_array(F.collect_list("id")).alias("ids"), F.min("id").alias("id"))
    classes = kept(rows.join(few, ["same", "copy", "id"]).drop("id"), "classes")
    room = F.greatest(F.lit(1), F.least(F.lit(shard), F.floor(F.lit(SHARD_BYTES) / (8 * F.col("size")))))
    shards = classes.groupBy("size").agg(F.ceil(F.count(F.lit(1)) / F.first(room)).alias("shards"))
    dealt = classes.join(shards, "size").withColumn("shard", F.pmod(F.xxhash64("same", "copy"), F.col("shards")))

    def make(group: pd.DataFrame) -> list[tuple]:
        graph = Graph(_one_length(_stack(group["vector"])), degree, alpha).grow(proposed)
        size, shard = int(group["size"].iloc[0]), int(group["shard"].iloc[0])
        return [(size, shard, i, list(ids), v, near[near >= 0].tolist(), graph.start)
                for i, (ids, v, near) in enumerate(zip(group["ids"], group["vector"], graph.near))]

    columns = dealt.select("size", "shard", "same", "copy", "ids", "vector")
    return kept(_grouped(columns, ["size", "shard"], ["same", "copy"], make,
                         "size long, shard long, place int, ids array<bigint>, vector binary, near array<int>, start int"),
                "graphs")


def _answer(nearest: int, beam: int, degree: int):
    def work(group: pd.DataFrame) -> list[tuple]:
        """Rows (same, copy, score, ids): the nearest classes of a shard for each query."""
        is_node = (group["place"] >= 0).to_numpy()
        nodes, asked = group[is_node].sort_values("place"), group[~is_node]
        if not len(asked) or not len(nodes):
            return []
        x = _stack(nodes["vector"])
        graph = Graph(_one_length(x), degree)
        graph.start = int(nodes["start"].iloc[0])
        graph.near = np.full((len(x), degree), -1, dtype=np.int32)
        for i, near in enumerate(nodes["near"]):
            graph.near[i, :len(near)] = near
        ids = nodes["ids"].to_list()
        first = np.array([i[0] for i in ids], dtype=np.int64)
        out = []
        for a in range(0, len(asked), TOGETHER):
            part = asked.iloc[a:a + TOGETHER]
            q = _stack(part["vector"])
            scaled = q / np.abs(q).max(axis=1, keepdims=True)
            found, _ = graph.search(np.column_stack([scaled, np.zeros(len(q))]), beam)
            for query, same, copy, got in zip(q, part["same"], part["copy"], found):
                got = got[got >= 0]
                with np.errstate(over="ignore", invalid="ignore"):
                    score = x[got] @ query
                order = np.lexsort((first[got], -score))[:nearest + 1]
                out += [(int(same), int(copy), float(score[i]), list(ids[got[i]])) for i in order]
        return out

    return work


def search(index: DataFrame, rows: DataFrame, query: Column, nearest: int = NEAREST, beam: int = BEAM,
           degree: int = DEGREE) -> DataFrame:
    """Rows (query_id, rank, vec_id, score) for the ``members`` for which ``query`` holds.

    Equal queries are searched once; a block of them meets every shard of vectors of its
    length.  Equal scores rank by ascending id.
    """
    asked = rows.filter(query).select("id", "same", "copy", "size", "vector")
    classes = asked.dropDuplicates(["same", "copy"])
    blocks = classes.groupBy("size").agg(F.ceil(F.count(F.lit(1)) / QUERIES).alias("blocks"))
    shards = index.groupBy("size").agg((F.max("shard") + 1).alias("shards"))

    def numbers(column: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(column).cast("long") - 1))

    zero, none = F.lit(0).cast("long"), F.lit(None)
    nodes = index.join(blocks, "size").select(
        "size", "shard", numbers("blocks").alias("block"), "place", "ids", "vector", "near", "start",
        zero.alias("same"), zero.alias("copy"))
    dealt = F.pmod(F.xxhash64("same", "copy"), F.col("blocks"))
    tasks = classes.join(blocks, "size").join(shards, "size").select(
        "size", numbers("shards").alias("shard"), dealt.alias("block"), F.lit(-1).alias("place"),
        none.cast("array<bigint>").alias("ids"), "vector", none.cast("array<int>").alias("near"),
        F.lit(0).alias("start"), "same", "copy")
    found = _grouped(nodes.unionByName(tasks), ["size", "shard", "block"], [], _answer(nearest, beam, degree),
                     "same long, copy long, score double, ids array<bigint>")
    each = found.select("same", "copy", "score", F.explode("ids").alias("id"))
    rank = F.row_number().over(Window.partitionBy("same", "copy").orderBy(F.desc("score"), "id"))
    best = (each.withColumn("n", rank).filter(F.col("n") <= nearest + 1)
            .groupBy("same", "copy").agg(F.collect_list(F.struct("score", F.col("id").alias("vec_id"))).alias("best")))
    pairs = asked.select(F.col("id").alias("query_id"), "same", "copy").join(best, ["same", "copy"])
    pairs = pairs.select("query_id", F.inline("best")).filter("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(rows: DataFrame, query: Column, key: str = "vec_id", vector: str = "embedding",
                       nearest: int = NEAREST) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the nearest found of each query, by inner product.

    ``query`` is a condition on the column ``id``.  A vector that is null, empty, zero or
    holds a null, NaN or infinite component takes no part, nor does a row without an id; of
    rows that share an id the one that sorts first counts for all.  Vectors meet those of
    their length only.  Queries with fewer candidates get all of them; an empty table gives
    no rows.  Other columns are not read.
    """
    known = members(rows, key, vector)
    return search(build(known, nearest), known, query, nearest)
