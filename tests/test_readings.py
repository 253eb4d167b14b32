import datetime as dt

from airshed.operators import readings as rd

COLUMNS = ("AirQualityStationEoICode string, AirPollutant string, Start string, Value string, "
           "Validity string, verification_level string")


def raw(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def row(station="fr001", pollutant="PM2.5", start="2024-01-01T05:00:00+01:00", value="10",
        validity="1", level="E1a"):
    return (station, pollutant, start, value, validity, level)


def test_bad_numbers_and_flags_are_dropped(spark):
    rows = [row(value=v) for v in ("7", "NaN", "abc", None, "-1")]
    rows += [row(value="8", validity=v) for v in ("-1", "-99", "x", None, "0", "2")]
    kept = rd.prepared(raw(spark, rows)).collect()
    assert sorted(r.value for r in kept) == [7.0, 8.0]


def test_local_day_is_kept(spark):
    kept = rd.prepared(raw(spark, [row(start="2018-03-15T00:00:00+01:00")])).first()
    assert kept.date == dt.date(2018, 3, 15)
    assert (kept.year, kept.month, kept.day_of_week, kept.country_code) == (2018, 3, 5, "FR")


def test_clip_by_pollutant(spark):
    rows = [row(pollutant=p, value="5000") for p in ("PM2.5", "PM10", "NO2", "O3", "SO2", "CO")]
    values = {r.pollutant: r.value for r in rd.prepared(raw(spark, rows)).collect()}
    assert values == {"PM2.5": 900, "PM10": 1500, "NO2": 1000, "O3": 400, "SO2": 2000, "CO": 5000}


def test_verified_level_wins_and_is_averaged(spark):
    rows = [row(value="10"), row(value="20"), row(value="90", level="E2a")]
    strict = rd.daily_verified_first(rd.prepared(raw(spark, rows))).first()
    assert (strict.value_mean, strict.value_max, strict.reading_count) == (15.0, 20.0, 2)
    assert strict.verification_level == "E1a"
    mixed = rd.daily_mixed(rd.prepared(raw(spark, rows))).first()
    assert (mixed.value_mean, mixed.value_max, mixed.reading_count) == (40.0, 90.0, 3)
    assert mixed.verification_level == "E1a"


def test_unlisted_level_comes_last_but_is_kept(spark):
    rows = [row(value="1", level="X"), row(value="2", level="E2a"),
            row(station="fr002", value="3", level="X")]
    daily = {r.station_id: r for r in rd.daily_verified_first(rd.prepared(raw(spark, rows)))
             .collect()}
    assert daily["fr001"].value_mean == 2.0
    assert (daily["fr002"].value_mean, daily["fr002"].verification_level) == (3.0, "other")


def test_fused_plan_equals_steps(spark):
    rows = [row(station=f"fr{i % 3}", pollutant=p, value=str(i * 3 % 50),
                start=f"2024-01-0{1 + i % 4}T00:00:00", level=("E1a", "E2a")[i % 2])
            for i in range(60) for p in ("PM2.5", "O3")]
    df = raw(spark, rows)
    steps = rd.pivot_pollutants(rd.daily_verified_first(rd.prepared(df)))
    assert sorted(map(str, rd.station_days(df).collect())) == sorted(map(str, steps.collect()))


def test_pollutant_outside_the_list_keeps_the_station_day(spark):
    wide = rd.station_days(raw(spark, [row(pollutant="CO")])).collect()
    assert len(wide) == 1 and wide[0].pm25_mean is None


def test_absent_columns_are_skipped(spark):
    df = raw(spark, [row()]).drop("AirPollutant")
    assert "pollutant" not in rd.standardise(df).columns


def test_station_dimension_is_repeatable(spark):
    df = spark.createDataFrame([("fr1", 2.0, 1.0), ("fr1", 1.0, 9.0), ("de1", 5.0, 5.0)] * 3,
                               "station_id string, latitude double, longitude double")
    found = {r.station_id: (r.latitude, r.longitude, r.country_code)
             for r in rd.station_dimension(df).collect()}
    assert found == {"fr1": (1.0, 9.0, "FR"), "de1": (5.0, 5.0, "DE")}


def test_two_shuffles_from_raw_to_wide(spark):
    plan = rd.station_days(raw(spark, [row()]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert "SortAggregate" not in plan


def test_hot_station_in_many_partitions(spark):
    """A station with a third of the readings gives the same result as pandas."""
    rows = [row(station="FRHOT" if i % 3 == 0 else f"FR{i % 40:03d}", value=str(i % 97),
                start=f"2024-01-{1 + i % 28:02d}T00:00:00", level=("E1a", "E2a")[i % 2])
            for i in range(6000)]
    daily = rd.daily_verified_first(rd.prepared(raw(spark, rows).repartition(16))).toPandas()
    import pandas as pd

    frame = pd.DataFrame(rows, columns=["station", "p", "start", "value", "v", "level"])
    frame["value"] = frame["value"].astype(float)
    frame["date"] = frame["start"].str[:10]
    best = frame.groupby(["station", "date"])["level"].transform("min")
    expected = frame[frame["level"] == best].groupby(["station", "date"])["value"].mean()
    got = daily.assign(date=daily["date"].astype(str)).set_index(["station_id", "date"])
    assert len(got) == len(expected)
    assert (got["value_mean"].sort_index().values - expected.sort_index().values).max() < 1e-9


def test_readings_without_keys_are_left_out_and_counted(spark):
    rows = [("FR1", "O3", "2024-01-01 01:00:00", "5", "1"), (None, "O3", "2024-01-01 01:00:00", "5", "1"),
            ("FR1", "O3", "soon", "5", "1"), ("FR1", "O3", "2024-01-01 02:00:00", "-5", "1"),
            ("FR1", "O3", "2024-01-01 02:00:00", None, "1")]
    raw = spark.createDataFrame(rows, "AirQualityStationEoICode string, AirPollutant string, Start string, "
                                      "Value string, Validity string")
    assert rd.prepared(raw).count() == 1
    assert tuple(rd.removed(raw).first()) == (5, 2, 2, 1)
