"""Quality classifier: support vectors on n-gram indicators scaled by naive Bayes ratios.

Fitting takes a bounded sample of labelled documents in one task.  Indicators of byte
n-grams (1 to 4) and of runs of repeated words are hashed to 2 ** 18 columns; each is
scaled by its smoothed log-count ratio of the classes, rows are brought to length one,
and a linear hinge-loss model is fitted by dual coordinate descent.  A logistic curve
on documents left out of that fit turns margins into scores.

Scoring reads whole texts, long ones in overlapping parts; a text's indicators are those
of all its parts.
"""

from __future__ import annotations

import operator
import pickle
import random
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame

from airshed.llm import labelled

SAMPLE = 3000
SAMPLE_BYTES = 32_000_000
BITS = 18
ORDERS = (1, 2, 3, 4)
PART = 1 << 20
#: Runs of this many equal neighbours are indicators of their own.
RUNS = (1, 2, 3, 5, 8)
COST = 1.0
ROUNDS = 30
_ODD = np.uint64(0x9E3779B97F4A7C15)


def columns(text: str, seen: np.ndarray) -> np.ndarray:
    """Columns of the indicators that a text has; ``seen`` is a scratch array of zeros."""
    data = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    for start in range(0, len(data), PART):
        part = data[start:start + PART + max(ORDERS) - 1].astype(np.uint64)
        code = part
        for n in ORDERS:
            if n > 1:
                if len(part) < n:
                    break
                code = (code[:-1] << np.uint64(8)) | part[n - 1:]
            seen[((code + np.uint64(n << 40)) * _ODD) >> np.uint64(64 - BITS)] = 1
    words = text.split()
    same = np.fromiter(map(operator.eq, words, words[1:]), dtype=bool, count=max(0, len(words) - 1))
    if same.any():
        ends = np.flatnonzero(~np.concatenate([[False], same, [False]]))
        longest = int(np.diff(ends).max()) - 1
        for n in RUNS:
            if longest >= n:
                seen[(1 << BITS) + n] = 1
    found = np.flatnonzero(seen)
    seen[found] = 0
    return found


def _scratch() -> np.ndarray:
    return np.zeros((1 << BITS) + max(RUNS) + 1, dtype=np.uint8)


def dual_descent(rows: list[np.ndarray], scale: np.ndarray, y: np.ndarray, cost: np.ndarray,
                 rounds: int = ROUNDS, seed: int = 5) -> np.ndarray:
    """Weights of the hinge-loss model over unit rows scale[columns] / length."""
    order = np.random.default_rng(seed)
    w, alpha = np.zeros(len(scale)), np.zeros(len(rows))
    values = [scale[r] / max(np.linalg.norm(scale[r]), 1e-12) for r in rows]
    for _ in range(rounds):
        worst = 0.0
        for i in order.permutation(len(rows)):
            r, v = rows[i], values[i]
            gradient = y[i] * float(w[r] @ v) - 1.0
            new = min(max(alpha[i] - gradient, 0.0), cost[i])
            if new != alpha[i]:
                w[r] += (new - alpha[i]) * y[i] * v
                worst = max(worst, abs(new - alpha[i]))
                alpha[i] = new
        if worst < 1e-3:
            break
    return w


def margin(found: np.ndarray, scale: np.ndarray, w: np.ndarray) -> float:
    v = scale[found]
    return float(w[found] @ v) / max(float(np.linalg.norm(v)), 1e-12)


def fit(rows: list[tuple]) -> bytes:
    """The model as bytes, from (key, text, label, weight) rows."""
    draw = random.Random(7)
    rows = list(rows)
    draw.shuffle(rows)
    cut = max(1, len(rows) * 3 // 4)
    train, check = labelled.copies_left_out(rows[:cut]), labelled.copies_left_out(rows[cut:])
    check = check or train
    seen = _scratch()
    found = [columns(t, seen) for _, t, _, _ in train]
    y = np.array([1.0 if r[2] else -1.0 for r in train])
    count = np.ones((2, len(seen)))
    for f, v in zip(found, y):
        count[int(v > 0), f] += 1
    rates = count / count.sum(axis=1, keepdims=True)
    scale = np.log(rates[1] / rates[0])
    share = np.array([max((y == v).mean(), 1e-9) for v in y]) if len(y) else np.zeros(0)
    w = dual_descent(found, scale, y, COST * 0.5 / share)
    x = np.array([[margin(columns(t, seen), scale, w)] for _, t, _, _ in check]).reshape(-1, 1)
    target = np.array([float(r[2]) for r in check])
    weight = np.array([r[3] for r in check])
    beta = labelled.logistic(x, target, weight / weight.mean()) if len(x) else np.array([0.0, 0.0])
    # One product per column is all that scoring needs.
    return pickle.dumps(((w * scale).astype(np.float32), (scale * scale).astype(np.float32), beta))


def scorer(model: bytes) -> Callable[[str], float]:
    product, square, beta = pickle.loads(model)
    seen = _scratch()

    def score(text: str) -> float:
        found = columns(text, seen)
        length = max(float(square[found].sum()) ** 0.5, 1e-12)
        return float(labelled.probability(np.array([[float(product[found].sum()) / length]]), beta)[0])

    return score


def learn(column: str) -> Column:
    return labelled.remainder(column, 4) != 2


def held_out(column: str) -> Column:
    return labelled.remainder(column, 4) == 2


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE, max_bytes: int = SAMPLE_BYTES,
          key: str = "doc_id", text: str = "text") -> bytes:
    rows = labelled.sample(docs, labels, "quality", learn, per_class, key, text)
    return labelled.fit_once(rows, fit, max_bytes)


def classify(docs: DataFrame, model: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, held_out, score (0 to 1), predicted (score >= 0.7).

    A null or empty text has no indicator and gets the score of margin 0; rows with a
    null key are scored and not held out; equal texts get equal scores.  Without labels
    all texts score alike.  An empty table gives no rows.
    """
    return labelled.score_rows(docs, lambda: scorer(model), held_out, key, text)
