"""Thresholds, AUC, drift and decisions against brute force."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from airshed.operators import drift as dr, metrics as mt

RNG = random.Random(11)
LABELS = [int(RNG.random() < 0.3) for _ in range(600)]
SCORES = [(y, round(0.8 * RNG.random() + 0.2 * y, 2)) for y in LABELS]
SCORES += [(1, k / 100) for k in range(29, 72)] + [(0, k / 100) for k in range(29, 72)]


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(SCORES, "label int, score double")


def pick(t):
    tp = sum(1 for y, s in SCORES if y and s >= t)
    predicted = sum(1 for _, s in SCORES if s >= t)
    return tp, predicted


def test_sweep_matches_counting(scored):
    rows = mt.threshold_sweep(scored).orderBy("threshold").collect()
    assert [round(r.threshold * 100) for r in rows] == list(range(30, 70))
    for r in rows:
        tp, predicted = pick(r.threshold)
        assert (r.tp, r.tp + r.fp) == (tp, predicted)


def test_select_threshold_policies(spark):
    sweep = spark.createDataFrame([(0.3, 1.0), (0.4, 0.95), (0.5, 0.6)],
                                  "threshold double, recall double")
    assert mt.select_threshold(sweep).first()[0] == 0.4
    assert mt.select_threshold(sweep, policy="lowest").first()[0] == 0.3
    assert mt.select_threshold(sweep, target=1.1).first()[0] == 0.5


def test_precision_floor(scored):
    positives = sum(y for y, _ in SCORES)
    best = None
    for t in sorted({s for _, s in SCORES}):
        tp, predicted = pick(t)
        if tp / predicted > 0.4 and (best is None or tp / positives > best[1]):
            best = (t, tp / positives)
    row = mt.threshold_precision_floor(scored, floor=0.4).first()
    assert best is not None and (row.threshold, row.recall) == pytest.approx(best)
    assert mt.threshold_precision_floor(scored, floor=1.0).first().threshold == 0.5


def test_auc_matches_pairs(scored):
    pos = [s for y, s in SCORES if y]
    neg = [s for y, s in SCORES if not y]
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    assert mt.roc_auc(scored).first()[0] == pytest.approx(wins / len(pos) / len(neg))


def test_missing_scores_are_left_out(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (None, 0.5), (1, None)],
                               "label int, score double")
    row = mt.classification_metrics(df).first()
    assert (row.tp, row.fp, row.fn, row.tn, row.roc_auc) == (1, 0, 0, 1, 1.0)


def two_periods(spark, base, current):
    rows = [(False, float(v)) for v in base] + [(True, float(v)) for v in current]
    return spark.createDataFrame(rows, "is_current boolean, x double")


def test_psi_matches_numpy(spark):
    rng = np.random.default_rng(1)
    base, current = rng.normal(0, 1, 900).round(2), rng.normal(0.5, 1.2, 700).round(2)
    edges = np.quantile(base, np.arange(1, 10) / 10)
    def shares(x):
        counts = np.bincount(np.searchsorted(edges, x, side="left"), minlength=10)
        return np.maximum(counts / len(x), 1e-4)
    p, q = shares(current), shares(base)
    row = dr.psi(two_periods(spark, base, current), ["x"]).first()
    assert row.psi == pytest.approx(float(((p - q) * np.log(p / q)).sum()))
    assert row.level == ("alert" if row.psi > 0.25 else "warning" if row.psi >= 0.1 else "stable")


def test_ks_matches_numpy(spark):
    rng = np.random.default_rng(2)
    base, current = rng.normal(0, 1, 400).round(1), rng.normal(0.3, 1, 300).round(1)
    grid = np.unique(np.concatenate([base, current]))
    d = max(abs((base <= g).mean() - (current <= g).mean()) for g in grid)
    z = math.sqrt(400 * 300 / 700) * d
    p = sum(2 * (-1) ** (k - 1) * math.exp(-2 * k * k * z * z) for k in range(1, 60))
    row = dr.ks_test(two_periods(spark, base, current), ["x"]).first()
    assert row.statistic == pytest.approx(d) and row.p_value == pytest.approx(p)


def test_same_distribution_has_no_drift(spark):
    values = [i / 100 for i in range(100)]
    df = two_periods(spark, values, values).withColumnRenamed("x", "score")
    assert dr.psi(df, ["score"]).first().psi == pytest.approx(0)
    assert dr.ks_test(df, ["score"]).first().p_value == 1.0
    assert dr.kl_divergence(df).first().kl == pytest.approx(0)


def test_rolling_recall_waits_for_truth(spark):
    day = dt.date(2024, 1, 1)
    predictions = spark.createDataFrame(
        [("a", day + dt.timedelta(days=i), i % 2) for i in range(10)],
        "station_id string, date date, predicted int")
    truth = spark.createDataFrame([("a", day + dt.timedelta(days=i), 1) for i in range(8)],
                                  "station_id string, date date, label int")
    rows = {(r.date - day).days: r for r in mt.rolling_recall(predictions, truth).collect()}
    assert rows[1].recall_7d == 0.5 and rows[9].recall_7d == pytest.approx(3 / 5)
    assert rows[9].recall_30d == 0.5 and rows[9].tp == 0


def test_decisions(spark):
    runs = spark.createDataFrame(
        [(False, 0.1, 9.0, 9), (True, 0.79, 9.0, 9), (True, 0.8, 0.26, 9), (True, 0.8, 0.25, 4),
         (True, 0.9, 0.1, 3)],
        "new_data boolean, rolling_recall double, max_psi double, weeks_since int")
    got = [(r.reason, r.retrain) for r in mt.retrain_decision(runs).collect()]
    assert got == [("no new data", False), ("recall degradation", True), ("feature drift", True),
                   ("scheduled retrain", True), ("no trigger met", False)]
    models = spark.createDataFrame([(0.9, 0.9, 0.25), (0.89, 0.8, 0.1), (0.95, 0.98, 0.1),
                                    (0.95, 0.9, 0.3)],
                                   "new_recall double, current_recall double, new_psi double")
    assert [r.deploy for r in mt.select_champion(models).collect()] == [True, False, False, False]


def test_volume_and_label_drift(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),)] * 4 + [(dt.date(2024, 1, 2),)] * 9,
                               "date date")
    rows = {r.date.day: r.alert for r in dr.prediction_volume(df, F.lit(10)).collect()}
    assert rows == {1: True, 2: False}
    drift = spark.createDataFrame([(False, 30.0), (False, 1.0), (True, 30.0), (True, None)],
                                  "is_current boolean, pm25_mean double")
    row = dr.label_drift(drift).first()
    assert (row.base_pct, row.current_pct, row.alert) == (50.0, 100.0, True)
