"""A bounded sample of labelled documents, for fitting a classifier in one task."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from airshed.llm.memory import given_back


def remainder(key: str, modulus: int) -> Column:
    """crc32 of the key's decimal text, modulo ``modulus``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % modulus


def sample(docs: DataFrame, labels: DataFrame, label: str, learn: Callable[[str], Column],
           per_class: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, text, label, weight): about ``per_class`` labelled documents of each class.

    Only labels for which ``learn`` holds are read.  Of a key with several labels the
    largest counts; labels other than 0 and 1 are left out.  Keys are drawn by their
    hash, so the draw depends on nothing else; at most 1.2 * per_class + 200 keys per
    class are broadcast (the excess over the expected number is cut off by hash order).
    ``weight`` is the number of labelled rows that a drawn one stands for.
    """
    known = (
        labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & F.col("key").isNotNull() & learn("key"))
        .groupBy("key").agg(F.max("label").alias("label"))
    )
    count = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = []
    for value, n in sorted(count.items()):
        share = min(1.0, per_class / n)
        draw = F.pmod(F.xxhash64("key", F.lit(value)), F.lit(1_000_000))
        parts.append(
            known.filter((F.col("label") == value) & (draw < int(share * 1_000_000)))
            .orderBy(draw, "key").limit(int(1.2 * per_class) + 200)
            .withColumn("weight", F.lit(1.0 / share)))
    if not parts:
        return docs.select(docs[key].alias("key"), docs[text].alias("text"), F.lit(0).alias("label"),
                           F.lit(1.0).alias("weight")).limit(0)
    drawn = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    rows = docs.select(docs[key].alias("key"), F.coalesce(docs[text], F.lit("")).alias("text"))
    return rows.join(F.broadcast(drawn), "key")


def fit_once(rows: DataFrame, fit: Callable[[list[tuple]], bytes], max_bytes: int) -> bytes:
    """``fit`` over the sample in one task; what comes back is one small row.

    The task sees its rows in order of a hash of the key and stops after ``max_bytes`` of
    text, so the bound cuts the same rows in every run.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got, size = {}, 0
        for batch in batches:
            for k, t, y, w in zip(batch["key"], batch["text"], batch["label"], batch["weight"]):
                if size < max_bytes and (k, t) not in got:
                    got[k, t] = (int(y), float(w))
                    size += len(t)
        yield pd.DataFrame({"model": [fit([(k, t, y, w) for (k, t), (y, w) in sorted(got.items())])]})

    one = rows.repartition(1).sortWithinPartitions(F.xxhash64("key"), "key", "text").mapInPandas(given_back(run), "model binary")
    found = one.first()
    return bytes(found["model"]) if found else fit([])


def copies_left_out(rows: list[tuple], shingle: int = 5) -> list[tuple]:
    """One row per smallest shingle hash, so that groups of near copies count about once."""
    seen, out = set(), []
    for row in rows:
        words = row[1].encode().split()
        low = min((zlib.crc32(b" ".join(words[i:i + shingle]))
                   for i in range(max(1, len(words) - shingle + 1))), default=0)
        if (row[2], low) not in seen:
            seen.add((row[2], low))
            out.append(row)
    return out


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Coefficients (last: intercept) of a weighted logistic regression, by Newton steps."""
    x = np.column_stack([x, np.ones(len(y))])
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge * weight.sum() / max(len(y), 1))
    penalty[-1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - penalty * beta
        hessian = (x.T * (weight * p * (1 - p) + 1e-9)) @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def probability(x: np.ndarray, beta: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ beta[:-1] + beta[-1], -30, 30)))


def score_column(text: Column, scorer: Callable[[], Callable[[str], float]]) -> Column:
    """The score of a text as a column, in Arrow batches; null counts as empty."""
    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            score = scorer()
            for batch in batches:
                yield pd.Series([score(t or "") for t in batch], dtype=np.float64)

        yield from given_back(scores)(batches)

    return run(text)


def score_rows(docs: DataFrame, scorer: Callable[[], Callable[[str], float]], held_out: Callable[[str], Column],
               key: str = "doc_id", text: str = "text", cut: float = 0.7) -> DataFrame:
    """Rows (key, held_out, score, predicted) from whole texts; null counts as empty."""
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = scorer()
        for batch in batches:
            yield pd.DataFrame({
                "key": batch["key"],
                "score": np.array([score(t or "") for t in batch["text"]], dtype=np.float64)})

    kind = docs.schema[key].dataType.simpleString()
    scored = rows.mapInPandas(run, f"key {kind}, score double")
    out = F.coalesce(held_out("key"), F.lit(False))
    return scored.select(F.col("key").alias(key), out.alias("held_out"), "score",
                         F.when(F.col("score") >= cut, 1).otherwise(0).alias("predicted"))
