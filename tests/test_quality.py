import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from airshed.operators import features as fe, models as md, quality as ql

DAY = dt.date(2024, 1, 1)


def store(spark, n=60, stations=3):
    rng = random.Random(1)
    rows = [(f"FR00{s}", "FR", DAY + dt.timedelta(days=d), 50 * rng.random(), 3.0 + d % 5)
            for s in range(stations) for d in range(n)]
    df = spark.createDataFrame(
        rows, "station_id string, country_code string, date date, pm25_mean double, temp_2m double")
    df = df.withColumn("boundary_layer_height", F.col("temp_2m") * 100)
    return fe.add_history(df)


def failed(report):
    return {r.check_name for r in report.collect() if not r.passed}


def test_good_store_passes(spark):
    report = ql.quality_report(store(spark), min_rows=10)
    assert failed(report) == set()
    row = ql.gate(report).first()
    assert row.n_checks == 20 and row.n_failed == 0 and row.safe_to_train


def broken(df, name, value):
    return df.withColumn(name, value)


@pytest.mark.parametrize("change, check", [
    (lambda d: broken(d, "pm25_mean_lag1", F.col("pm25_mean")), "lags_look_back"),
    (lambda d: broken(d, "pm25_mean_rolling7d", F.col("pm25_mean")), "rolling_excludes_today"),
    (lambda d: broken(d, "pm25_exceedance_t1", 1 - F.col("pm25_exceedance_t1")),
     "target_looks_forward"),
    (lambda d: broken(d, "pm25_exceedance_t2", F.lit(7)), "binary_pm25_exceedance_t2"),
    (lambda d: broken(d, "pm25_exceedance_t2", F.col("pm25_exceedance_t1")), "target_rates_differ"),
    (lambda d: broken(d, "temp_2m", F.lit(None).cast("double")), "weather_hit_rate_above_90"),
    (lambda d: d.unionByName(d), "no_duplicate_keys"),
    (lambda d: d.unionByName(d.limit(1).withColumn("station_id", F.lit(None).cast("string"))),
     "no_null_station_id"),
    (lambda d: d.filter(F.dayofmonth("date") != 20), "stations_with_gaps_below_20"),
    (lambda d: broken(d, "pm25_mean_rolling7d", F.lit(1e6)), "rolling_mean_within_bound"),
])
def test_each_fault_is_found(spark, change, check):
    report = ql.quality_report(change(store(spark)), min_rows=10)
    assert check in failed(report)


def test_copies_do_not_disturb_series_checks(spark):
    df = store(spark)
    copies = df.unionByName(df).unionByName(df)
    assert failed(ql.quality_report(copies, min_rows=10)) == {"no_duplicate_keys"}


def test_schema_report(spark):
    rows = {r.column_name: r for r in ql.schema_report(store(spark)).collect()}
    assert len(rows) == 25 + 33 + 14
    assert rows["pm25_mean_lag7"].present and rows["pm25_mean_lag7"].type_ok
    assert not rows["season"].present and rows["date"].type_ok


def test_landing_report(spark):
    files = spark.createDataFrame(
        [("a", True, 200_000, 5, []), ("b", True, 5, 5, []), ("c", True, 200_000, 5, ["End"]),
         ("d", True, 200_000, 0, []), ("e", False, None, None, [])],
        "file_name string, found boolean, size_bytes long, n_rows long, "
        "missing_columns array<string>")
    report = ql.landing_report(files)
    assert {r.file_name for r in report.collect() if r.passed} == {"a"}
    diff = spark.createDataFrame([("a", "new"), ("b", "unchanged")], "file_name string, status string")
    assert ql.new_data_gate(diff, report).first().run_downstream is False
    good = report.filter("file_name = 'a'")
    assert ql.new_data_gate(diff, good).first().run_downstream is True
    old = diff.filter("status = 'unchanged'")
    assert ql.new_data_gate(old, good).first().run_downstream is False


def test_models_learn_and_are_checked(spark):
    df = store(spark, n=120, stations=6)
    split = F.when(F.col("date") < "2024-03-01", "train").when(
        F.col("date") < "2024-03-20", "validation").otherwise("test")
    rows = df.withColumn("split", split)
    features = ["pm25_mean", "pm25_mean_lag1", "temp_2m"]
    for kind in ("gbt", "forest", "logistic"):
        model = md.train(rows, features, kind=kind, rounds=5)
        scored = md.score(model, rows, features)
        assert scored.filter("score < 0 or score > 1").count() == 0
        assert scored.count() == rows.count()
        assert scored.filter("score is not null").count() == rows.dropna(subset=features).count()
        assert scored.filter("(score is null) <> (missing <> '')").count() == 0
        if kind == "gbt":
            table = md.importance(model, rows, features)
            assert table.first().feature.startswith("pm25")
            metrics = spark.createDataFrame([(0.9, 0.4)], "roc_auc double, recall double")
            checks = ql.model_checks(metrics, table)
            report = ql.quality_report(df, 10, checks)
            assert "baseline_recall_above_50" in failed(report)
            assert not ql.gate(report).first().safe_to_train


def test_stored_model_scores_alike(spark, tmp_path):
    rows = store(spark, n=60, stations=3).withColumn("split", F.lit("train"))
    features = ["pm25_mean", "pm25_mean_lag1"]
    model = md.train(rows, features, kind="forest", rounds=5)
    md.save(model, features, 0.3, str(tmp_path))
    stored, names, threshold = md.load(str(tmp_path))
    assert (names, threshold) == (features, 0.3)
    a = md.score(model, rows, features, 0.3).select("station_id", "date", "score", "predicted").collect()
    b = md.score(stored, rows, names, threshold).select("station_id", "date", "score", "predicted").collect()
    assert sorted(a) == sorted(b) and any(r.predicted for r in a)


def test_undecided_correlations_fail(spark):
    df = store(spark).withColumn("boundary_layer_height_lag7", F.lit(1.0))
    report = {r.check_name: r for r in ql.store_checks(df, 10).collect()}
    assert not report["lag_correlations_below_99"].passed


def test_class_weight(spark):
    df = spark.createDataFrame([("train", 0)] * 6 + [("train", 1)] * 2 + [("test", 1)] * 9,
                               "split string, pm25_exceedance_t1 int")
    weights = {r.pm25_exceedance_t1: r.weight for r in md.with_class_weight(df).collect()}
    assert weights == {0: 1.0, 1: 3.0}
