"""Toxicity by compression distance: two zstandard dictionaries, windows, thresholds.

Fitting takes a bounded sample of labelled documents in one task:

1. An ordinary dictionary is trained on ordinary text, a toxic one on toxic text.  Most of a
   toxic document is ordinary wording, so what the toxic dictionary holds of it is cut out:
   only runs of bytes stay whose 8-byte pieces stand in significantly more toxic than
   ordinary documents.  The toxic side continues with the ordinary dictionary, so both sides
   compress ordinary wording alike and lengths differ where toxic wording is met.
2. Thresholds are calibrated on documents that the dictionaries have not seen: each part of
   the sample is measured with dictionaries trained on the other parts.  The smallest saving
   that few ordinary windows reach becomes the window threshold; a logistic curve over the
   savings of a document gives its score, moved down where more than a few ordinary documents
   would reach the cut.
3. The dictionaries that score are trained on the whole sample.

Scoring reads whole texts in windows of 64 bytes (with 8 more of the next window) and
keeps no state between documents.
"""

from __future__ import annotations

import math
import pickle
import random
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame

from airshed.llm import labelled

#: Labelled documents per class, and bytes of their text, that the fit may take.
SAMPLE = 4000
SAMPLE_BYTES = 48_000_000
WINDOW, OVERLAP = 64, 8
#: A piece of the toxic dictionary stays if it is this significant (log-likelihood ratio of
#: its document counts) and this many (natural logarithm) times as frequent in toxic documents.
LEAST_LIKELIHOOD, LEAST_LOG_RATIO = 10.0, 1.5
PIECE = 8
TOXIC_BYTES, ORDINARY_BYTES = 110_000, 32_768
#: Bytes of text per training sample, and samples of an ordinary document.
TRAINED, SAMPLES = 256, 8
#: Part of ordinary windows that may reach the window threshold.
WINDOW_ERROR = 0.003
#: Part of ordinary documents that may reach the cut.
DOCUMENT_ERROR, CUT = 0.005, 0.7
#: Parts of the sample for calibration.
FOLDS = 4
LEVEL = 6


def _compressors(toxic: bytes, ordinary: bytes):
    import zstandard as zs

    def one(content: bytes):
        given = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT) if content else None
        return zs.ZstdCompressor(level=LEVEL, dict_data=given, write_content_size=False,
                                 write_checksum=False, write_dict_id=False).compress

    return one(toxic + ordinary), one(ordinary)


def _plain(text: str) -> bytes:
    """Lower-cased words with single spaces between them and around."""
    return b" " + b" ".join(text.lower().encode("utf-8", "replace").split()) + b" "


def savings(text: str, toxic: Callable, ordinary: Callable) -> np.ndarray:
    """Bytes that the toxic dictionary saves on each window of the text."""
    data = _plain(text)
    span = WINDOW + OVERLAP
    return np.array([len(ordinary(w)) - len(toxic(w))
                     for w in (data[i:i + span] for i in range(0, len(data), WINDOW))], dtype=np.int64)


def features(saved: np.ndarray, threshold: int) -> list[float]:
    """The number of windows at the threshold, and the savings of all."""
    return [math.log1p(int((saved >= threshold).sum())), math.sqrt(np.clip(saved, 0, 8).sum() / (len(saved) + 4.0))]


def _pieces(data: bytes) -> np.ndarray:
    """All runs of 8 bytes, as numbers."""
    if len(data) < PIECE:
        return np.zeros(0, dtype=np.uint64)
    whole = np.lib.stride_tricks.sliding_window_view(np.frombuffer(data, dtype=np.uint8), PIECE)
    return np.ascontiguousarray(whole).view(np.uint64).ravel()


def _likelihood(a: np.ndarray, all_a: int, b: np.ndarray, all_b: int) -> np.ndarray:
    """Log-likelihood ratio of two shares a / all_a and b / all_b against one common share."""
    p = (a + b) / (all_a + all_b)

    def part(n, expected):
        return np.where(n > 0, n * np.log(np.maximum(n, 1) / np.maximum(expected, 1e-12)), 0.0)

    return (part(a, all_a * p) + part(all_a - a, all_a * (1 - p))
            + part(b, all_b * p) + part(all_b - b, all_b * (1 - p)))


def toxic_runs(dictionary: bytes, toxic: list[bytes], ordinary: list[bytes]) -> bytes:
    """What of a dictionary marks toxic text, the most significant runs last."""
    at = _pieces(dictionary)
    have = np.unique(at)
    counts = []
    for texts in (toxic, ordinary):
        n = np.zeros(len(have))
        for data in texts:
            found = np.unique(_pieces(data))
            place = np.minimum(np.searchsorted(have, found), max(len(have) - 1, 0))
            n[place[have[place] == found] if len(have) else place[:0]] += 1
        counts.append(n)
    a, b = counts
    ratio = np.log((a + 0.5) / (len(toxic) + 1) * (len(ordinary) + 1) / (b + 0.5))
    weight = _likelihood(a, len(toxic), b, len(ordinary))
    good = (ratio >= LEAST_LOG_RATIO) & (weight >= LEAST_LIKELIHOOD)
    place = np.searchsorted(have, at)
    value = np.where(good[place], weight[place], 0.0) if len(at) else np.zeros(0)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], value > 0, [0]]).astype(int)))
    runs: dict[bytes, float] = {}
    for i, j in zip(edges[::2], edges[1::2]):
        run = dictionary[i:j - 1 + PIECE]
        runs[run] = max(runs.get(run, 0.0), float(value[i:j].max()))
    return b"".join(sorted(runs, key=lambda r: (runs[r], r)))


def _train(size: int, samples: list[bytes], **how) -> bytes:
    """A trained dictionary; where samples are too few for training, their own bytes."""
    import zstandard as zs

    try:
        return zs.train_dictionary(size, samples, **how).as_bytes()
    except zs.ZstdError:
        return b"".join(samples)[-size:]


def dictionaries(rows: list[tuple]) -> tuple[bytes, bytes]:
    """The toxic and the ordinary dictionary of (key, text, label, weight) rows."""
    draw = random.Random(11)
    texts: dict[int, list[bytes]] = {0: [], 1: []}
    for _, text, y, _ in rows:
        texts[y].append(_plain(text))
    plain, toxic = [], []
    for data in texts[0]:
        starts = range(0, len(data), TRAINED)
        plain += [data[i:i + TRAINED] for i in draw.sample(starts, min(SAMPLES, len(starts)))]
    for data in texts[1]:
        toxic += [data[i:i + TRAINED] for i in range(0, len(data), TRAINED)]
    # Short segments: about a word each.
    raw = _train(TOXIC_BYTES, toxic, k=16, d=8) if toxic else b""
    return toxic_runs(raw, texts[1], texts[0]), _train(ORDINARY_BYTES, plain) if plain else b""


def fit(rows: list[tuple]) -> bytes:
    """The model as bytes, from (key, text, label, weight) rows."""
    draw = random.Random(11)
    rows = list(rows)
    draw.shuffle(rows)
    rows = labelled.copies_left_out(rows)
    saved, order = [], []
    for k in range(FOLDS):
        check = rows[k::FOLDS]
        sides = _compressors(*dictionaries([r for i, r in enumerate(rows) if i % FOLDS != k]))
        saved += [savings(t, *sides) for _, t, _, _ in check]
        order += check
    y = np.array([r[2] for r in order], dtype=float)
    weight = np.array([r[3] for r in order])
    clean = np.concatenate([s for s, v in zip(saved, y) if not v] or [np.zeros(1, dtype=np.int64)])
    threshold = next(t for t in range(1, 64) if (clean >= t).mean() <= WINDOW_ERROR or t == 63)
    x = np.array([features(s, threshold) for s in saved])
    beta = labelled.logistic(x, y, weight / weight.mean()) if len(x) else np.array([0.0, 0.0, -3.0])
    if (y == 0).any():
        reached = np.sort(x[y == 0] @ beta[:-1] + beta[-1])
        allowed = reached[int((1 - DOCUMENT_ERROR) * (len(reached) - 1))]
        beta[-1] -= max(0.0, allowed - math.log(CUT / (1 - CUT)))
    return pickle.dumps((dictionaries(rows), threshold, beta))


def scorer(model: bytes) -> Callable[[str], float]:
    content, threshold, beta = pickle.loads(model)
    toxic, ordinary = _compressors(*content)

    def score(text: str) -> float:
        x = features(savings(text, toxic, ordinary), threshold)
        return float(labelled.probability(np.array([x]), beta)[0])

    return score


def learn(column: str) -> Column:
    return labelled.remainder(column, 3) != 1


def held_out(column: str) -> Column:
    return labelled.remainder(column, 3) == 1


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE, max_bytes: int = SAMPLE_BYTES,
          key: str = "doc_id", text: str = "text") -> bytes:
    rows = labelled.sample(docs, labels, "toxic", learn, per_class, key, text)
    return labelled.fit_once(rows, fit, max_bytes)


def classify(docs: DataFrame, model: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, held_out, score (0 to 1), predicted (score >= 0.7).

    A null or empty text gets the score of a text without any toxic window; rows with a
    null key are scored and not held out; equal texts get equal scores.  Without labels
    every score is low.  An empty table gives no rows.
    """
    return labelled.score_rows(docs, lambda: scorer(model), held_out, key, text)


def keep_clean(docs: DataFrame, model: bytes, text: str = "text", cut: float = 0.7) -> DataFrame:
    """The input rows and columns whose text scores below ``cut``; null texts stay."""
    return docs.filter(labelled.score_column(docs[text], lambda: scorer(model)) < cut)
