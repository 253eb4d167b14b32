import datetime as dt

from pyspark.sql import functions as F

from airshed.functions import columns as fx
from airshed.operators import features as fe
from airshed.operators.joins import salted_left_join

DAY = dt.date(2024, 1, 1)


def days(spark, offsets, values=None, station="FR001"):
    values = values or [float(i) for i in range(len(offsets))]
    rows = [(station, DAY + dt.timedelta(days=o), v) for o, v in zip(offsets, values)]
    return spark.createDataFrame(rows, "station_id string, date date, pm25_mean double")


def by_offset(df, column):
    return {(r.date - DAY).days: r[column] for r in df.collect()}


def test_row_and_calendar_lags_differ_after_gaps(spark):
    df = days(spark, [0, 1, 3, 11])
    rows = by_offset(fe.add_lags(df), "pm25_mean_lag1")
    assert rows == {0: None, 1: 0.0, 3: 1.0, 11: 2.0}
    assert by_offset(fe.add_lags(df, "calendar"), "pm25_mean_lag1") == {
        0: None, 1: 0.0, 3: None, 11: None}
    assert by_offset(fe.add_lags(df, "calendar"), "pm25_mean_lag2")[3] == 1.0


def test_rolling_mean_leaves_today_out(spark):
    df = days(spark, range(10))
    rows = by_offset(fe.add_rolling(df), "pm25_mean_rolling7d")
    assert rows[0] is None and rows[1] == 0.0 and rows[9] == sum(range(3, 9)) / 6
    calendar = by_offset(fe.add_rolling(df, "calendar"), "pm25_mean_rolling7d")
    assert calendar[9] == sum(range(2, 9)) / 7


def test_targets_strict_and_as_coded(spark):
    df = days(spark, range(5), [10.0, 30.0, None, 40.0, 5.0])
    coded = fe.add_targets(df, "as_coded")
    assert by_offset(coded, "pm25_exceedance_t1") == {0: 1, 1: 0, 2: 1, 3: 0, 4: 0}
    assert by_offset(coded, "pm25_exceedance_t2") == {0: 0, 1: 1, 2: 0, 3: 0, 4: 0}
    strict = fe.add_targets(df, "strict")
    assert by_offset(strict, "pm25_exceedance_t1") == {2: 1}


def test_limit_itself_is_no_exceedance(spark):
    df = days(spark, range(3), [1.0, 25.0, 25.0001])
    row = fe.add_targets(df).first()
    assert (row.pm25_exceedance_t1, row.pm25_exceedance_t2) == (0, 1)


def test_no_future_reaches_the_features(spark):
    early = days(spark, range(20), [float(i % 7) for i in range(20)])
    late = days(spark, range(20), [float(i % 7) for i in range(15)] + [999.0] * 5)
    names = ["pm25_mean_lag1", "pm25_mean_lag7", "pm25_mean_rolling7d", "pm25_mean_rolling14d"]
    for name in names:
        a = by_offset(fe.add_rolling(fe.add_lags(early)), name)
        b = by_offset(fe.add_rolling(fe.add_lags(late)), name)
        assert {k: v for k, v in a.items() if k <= 15} == {k: v for k, v in b.items() if k <= 15}


def test_history_is_one_window_stage(spark):
    df = days(spark, range(5)).withColumn("temp_2m", F.lit(1.0))
    plan = fe.add_history(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("+- Window [") + plan.count("Window [") >= 1
    assert plan.count(" Sort [") <= 1


def test_iso_year_joins_new_year_days(spark):
    features = spark.createDataFrame([("FR001x", dt.date(2021, 1, 1)), ("FR001x", dt.date(2021, 1, 4)),
                                      ("DE999x", dt.date(2021, 1, 4))],
                                     "station_id string, date date")
    weekly = spark.createDataFrame([("FR001", 2020, 53, 7.0), ("FR001", 2021, 1, 9.0)],
                                   "nuts3_code string, year int, week int, deaths double")
    rows = {(r.station_id, r.date.day): r.weekly_deaths
            for r in fe.join_outcomes(features, weekly).collect()}
    assert rows == {("FR001x", 1): 7.0, ("FR001x", 4): 9.0, ("DE999x", 4): None}


def test_salted_join_equals_plain_join_on_a_hot_key(spark):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"), "id")
    right = spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plain = left.join(right, ["k"], "left").select("k", "id", "v")
    salted = salted_left_join(left, right, ["k"], ["id"], 7).select("k", "id", "v")
    assert plain.exceptAll(salted).count() == 0 and salted.exceptAll(plain).count() == 0


def test_seasons_flags_and_names(spark):
    df = spark.createDataFrame([(m, 1 + m % 7) for m in range(1, 13)], "month int, day_of_week int")
    rows = {r.month: r for r in fe.add_calendar(df).collect()}
    assert [rows[m].season for m in (12, 2, 3, 5, 6, 8, 9, 11)] == [
        "winter", "winter", "spring", "spring", "summer", "summer", "autumn", "autumn"]
    assert {m for m in rows if rows[m].heating_season} == {10, 11, 12, 1, 2, 3}
    assert {rows[m].day_of_week for m in rows if rows[m].is_weekend} == {1, 7}


def test_iso_monday(spark):
    df = spark.createDataFrame([(2020, 53), (2021, 53), (2021, 1), (2024, 99), (2024, 0)],
                               "y int, w int")
    got = [r[0] for r in df.select(fx.iso_monday(F.col("y"), F.col("w"))).collect()]
    assert got == [dt.date(2020, 12, 28), None, dt.date(2021, 1, 4), None, None]


def test_coverage_filter(spark):
    df = days(spark, range(10), [1.0] * 6 + [None] * 4).union(
        days(spark, range(10), [1.0] * 7 + [None] * 3, station="DE001"))
    assert {r.station_id for r in fe.low_coverage_stations(df).collect()} == {"FR001"}
    assert {r.station_id for r in fe.enough_coverage(df).collect()} == {"DE001"}


def test_float_comparison(spark):
    df = spark.createDataFrame([(1.0, 1.0 + 1e-7), (1.0, 1.1), (None, None), (1.0, None)],
                               "a double, b double")
    got = [r[0] for r in df.select(fx.near(F.col("a"), F.col("b"))).collect()]
    assert got == [True, False, True, False]
