import datetime as dt
import re

import pytest

from airshed.operators import grid as gr

HOUR = dt.datetime(2024, 1, 1)


def cube(spark, nodes, hours=2):
    rows = [(HOUR + dt.timedelta(hours=h), y, x, 273.15 + v + h, 3.0, 4.0, 100000.0 + 100 * v, 0.001,
             400.0 + v) for y, x, v in nodes for h in range(hours)]
    return spark.createDataFrame(
        rows, "time timestamp, latitude double, longitude double, t2m double, u10 double, "
              "v10 double, sp double, tp double, blh double")


SQUARE = [(45.0, 2.0, 0.0), (45.0, 2.25, 10.0), (45.25, 2.0, 20.0), (45.25, 2.25, 30.0)]


def at(spark, lat, lon, nodes=SQUARE, **options):
    stations = spark.createDataFrame([("FR1", lat, lon)],
                                     "station_id string, latitude double, longitude double")
    rows = gr.interpolate(gr.daily_grid(cube(spark, nodes)), stations, **options).collect()
    return rows[0] if rows else None


def test_daily_units(spark):
    row = gr.daily_grid(cube(spark, SQUARE[:1])).first()
    assert row.t2m == pytest.approx(0.5) and row.sp == pytest.approx(1000.0)
    assert row.tp == pytest.approx(2.0) and row.blh_min == 400.0


@pytest.mark.parametrize("lat, lon, expected", [
    (45.0, 2.0, 0.0), (45.25, 2.25, 30.0), (45.125, 2.125, 15.0), (45.0, 2.125, 5.0),
    (45.0625, 2.1875, 12.5),
])
def test_bilinear(spark, lat, lon, expected):
    assert at(spark, lat, lon).t2m == pytest.approx(expected + 0.5)


def test_station_on_edge_needs_only_the_edge(spark):
    assert at(spark, 45.0, 2.125, SQUARE[:2]).t2m == pytest.approx(5.5)


def test_missing_corner_gives_null(spark):
    row = at(spark, 45.1, 2.1, SQUARE[:3])
    assert row is None or row.t2m is None


def test_outside_the_grid(spark):
    row = at(spark, 50.0, 9.0)
    assert row is None or row.t2m is None


def test_negative_coordinates(spark):
    nodes = [(-0.25, -0.25, 0.0), (-0.25, 0.0, 10.0), (0.0, -0.25, 20.0), (0.0, 0.0, 30.0)]
    assert at(spark, -0.125, -0.125, nodes).t2m == pytest.approx(15.5)


def test_nearest_and_inverse_distance(spark):
    assert at(spark, 45.2, 2.05, method="nearest").t2m == pytest.approx(20.5)
    assert at(spark, 45.125, 2.125, method="idw").t2m == pytest.approx(15.5)
    assert at(spark, 45.25, 2.0, method="idw").t2m == pytest.approx(20.5)
    d = {v: (0.2 - (y - 45) / 0.25) ** 2 + (0.4 - (x - 2) / 0.25) ** 2 for y, x, v in SQUARE}
    expected = sum(v / s for v, s in d.items()) / sum(1 / s for s in d.values())
    assert at(spark, 45.05, 2.1, method="idw").t2m == pytest.approx(expected + 0.5)


def test_station_weather_columns(spark):
    stations = spark.createDataFrame([("fr1", 45.0, 2.0)],
                                     "station_id string, latitude double, longitude double")
    row = gr.station_weather(cube(spark, SQUARE), stations).first()
    assert row.wind_speed == pytest.approx(5.0) and row.low_blh_flag == 1
    assert (row.country_code, row.year, row.month) == ("FR", 2024, 1)


def test_crop_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "grid")
    cube(spark, SQUARE).write.parquet(path)
    plan = gr.crop(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(latitude,34.0)" in plan


def test_many_stations_on_one_node_match_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    nodes = [(45 + 0.25 * i, 2 + 0.25 * j, float(rng.integers(0, 100)))
             for i in range(4) for j in range(4)]
    value = {(round(y / 0.25), round(x / 0.25)): v for y, x, v in nodes}
    places = [(f"S{i}", 45.25, 2.25) for i in range(100)]
    places += [(f"T{i}", 45 + 0.74 * rng.random(), 2 + 0.74 * rng.random()) for i in range(200)]
    places = [(s, float(y), float(x)) for s, y, x in places]
    stations = spark.createDataFrame(places, "station_id string, latitude double, longitude double")
    daily = gr.daily_grid(cube(spark, nodes))
    for salts in (1, 8):
        found = {r.station_id: r.t2m for r in
                 gr.interpolate(daily, stations, salts=salts).collect()}
        assert len(found) == 300
        for s, y, x in places:
            a, b = y / 0.25, x / 0.25
            i, j = int(np.floor(a)), int(np.floor(b))
            total = sum((1 - abs(a - p)) * (1 - abs(b - q)) * value[(p, q)]
                        for p in (i, i + 1) for q in (j, j + 1) if (p, q) in value)
            assert found[s] == pytest.approx(total + 0.5, abs=1e-6)


def test_days_are_utc_in_any_session(spark):
    rows = spark.sql("select 50.0 as latitude, 5.0 as longitude, timestamp_seconds(1704067200 + 3600 * h) as time, "
                     "280.0 as t2m, 1.0 as u10, 1.0 as v10, 1e5 as sp, 0.001 as tp, 500.0 as blh from "
                     "(select explode(sequence(0, 23)) as h)")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert [str(r.date) for r in gr.daily_grid(rows).collect()] == ["2024-01-01"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_no_task_holds_station_days(spark):
    stations = spark.createDataFrame([("FR1", 45.1, 2.1)], "station_id string, latitude double, longitude double")
    out = gr.interpolate(gr.daily_grid(cube(spark, SQUARE)), stations)
    grouped = re.findall(r"Aggregate \[([^\]]*)\]", out._jdf.queryExecution().optimizedPlan().toString())
    assert grouped and not any("station_id" in g and "date" in g for g in grouped)


def test_repeated_and_nameless_stations(spark):
    places = [("once", 45.0, 2.0), ("twice", 45.0, 2.0), ("twice", 45.0, 2.0),
              # Two nodes, of which one is there, and one node: found 2, needed 2.
              ("two", 45.0, 1.875), ("two", 45.25, 2.25), (None, 45.0, 2.25), ("nowhere", None, 2.0)]
    stations = spark.createDataFrame(places, "station_id string, latitude double, longitude double")
    rows = gr.interpolate(gr.daily_grid(cube(spark, SQUARE)), stations).collect()
    assert {r.station_id: r.t2m for r in rows} == {
        "once": pytest.approx(0.5), "twice": None, "two": pytest.approx(0.25 + 30.5), None: pytest.approx(10.5)}
    assert len(rows) == 4


def test_station_days_are_dealt_by_number(spark):
    # 60 stations of one place: few bytes in, many rows out. AQE merges partitions by the bytes in.
    stations = spark.createDataFrame([(f"FR{i}", 45.1, 2.1) for i in range(60)],
                                     "station_id string, latitude double, longitude double")
    out = gr.interpolate(gr.daily_grid(cube(spark, SQUARE, hours=24 * 8)), stations)
    assert out.count() == 60 * 8
    plan = out._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"hashpartitioning\(place#\w+, _salt#\w+, 8\), REPARTITION_BY_NUM", plan)
    assert len(dealt) == 2
