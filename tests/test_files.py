"""Sources, manifests, sinks and streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from airshed.operators import readings as rd
from airshed.sources import landing as ld
from airshed.sources import manifest as mf, readings as sr, sinks, tables
from airshed.streaming import ingest as si

RAW = ("AirQualityStationEoICode string, AirPollutant string, Start string, Value string, "
       "Validity string")


def reading(value, start="2024-01-01T00:00:00", station="FR001", pollutant="O3"):
    return (station, pollutant, start, value, "1")


def land(spark, folder, name, rows):
    spark.createDataFrame(rows, RAW).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")


def test_level_comes_from_the_path(spark, tmp_path):
    folder = str(tmp_path)
    land(spark, folder, "O3_E1a.parquet", [reading("1")])
    spark.createDataFrame([reading("2") + ("x",)], RAW + ", extra string").write.parquet(
        f"{folder}/O3_E2a.parquet")
    rows = {r.verification_level: r for r in sr.load_readings(spark, folder).collect()}
    assert rows["E1a"].Value == "1" and rows["E1a"].extra is None and rows["E2a"].extra == "x"


def test_single_files_and_differing_types(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    a, b = str(tmp_path / "O3_E1a.parquet"), str(tmp_path / "O3_E2a.parquet")
    pq.write_table(pa.table({"Value": ["1"], "Validity": ["1"]}), a)
    pq.write_table(pa.table({"Value": [2.5]}), b)
    rows = {r.verification_level: (r.Value, r.Validity)
            for r in sr.load_readings_as_text(spark, [a, b]).collect()}
    assert rows == {"E1a": ("1", "1"), "E2a": ("2.5", None)}


def test_who_table_is_found_below_and_may_be_absent(spark, tmp_path):
    assert tables.who_table(spark, str(tmp_path / "nowhere")).count() == 0
    (tmp_path / "a" / "b").mkdir(parents=True)
    assert tables.who_table(spark, str(tmp_path)).columns == tables.WHO_COLUMNS
    (tmp_path / "a" / "b" / "mortalitydata.csv").write_text("country,cause,year,deaths1\n4130,J1,2001,5\n")
    (tmp_path / "a" / "other.csv").write_text("x\n1\n")
    rows = tables.who_table(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in rows] == [("4130", "J1", "2001", "5")]


def test_manifest_of_real_files(spark, tmp_path):
    folder = str(tmp_path)
    land(spark, folder, "O3_E1a.parquet", [reading("1")])
    first = mf.landed_files(spark, folder).collect()
    assert [r.file_name for r in first] == ["O3_E1a.parquet"] and first[0].size_bytes > 0
    before = spark.createDataFrame(first)
    land(spark, folder, "NO2_E1a.parquet", [reading("1")])
    diff = {r.file_name: r.status for r in mf.manifest_diff(
        mf.landed_files(spark, folder), before).collect()}
    assert diff == {"O3_E1a.parquet": "unchanged", "NO2_E1a.parquet": "new"}


def test_equal_names_in_different_folders_stay_apart(spark, tmp_path):
    for year in ("2019", "2020"):
        (tmp_path / year).mkdir()
        land(spark, str(tmp_path / year), "grid_01.parquet", [reading("1")])
    names = {r.file_name for r in mf.landed_files(spark, str(tmp_path)).collect()}
    assert names == {"2019/grid_01.parquet", "2020/grid_01.parquet"}


def test_landed_files_are_inspected_one_by_one(spark, tmp_path):
    folder = str(tmp_path)
    spark.range(3).selectExpr("id as a", "id as b").write.parquet(f"{folder}/good.parquet")
    spark.range(3).selectExpr("id as a").write.parquet(f"{folder}/narrow.parquet")
    spark.range(0).selectExpr("id as a", "id as b").write.parquet(f"{folder}/empty.parquet")
    (tmp_path / "broken.parquet").write_bytes(b"not a table")
    expected = spark.createDataFrame([(f"{n}.parquet",) for n in ("good", "narrow", "empty", "broken", "absent")],
                                     "file_name string")
    found = {r.file_name.split(".")[0]: r for r in ld.inspect(spark, folder, expected, ld.Contract(("a", "b"), 1)).collect()}
    assert [(found[n].found, found[n].n_rows, found[n].missing_columns) for n in ("good", "narrow", "empty", "absent")] == [
        (True, 3, []), (True, 3, ["b"]), (True, 0, []), (False, None, ["a", "b"])]
    assert found["broken"].n_rows == 0 and found["broken"].missing_columns == ["a", "b"]


def test_mortality_files_are_inspected_by_their_header(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "mortalitydata.csv").write_text("country,cause,deaths1\n1,J,5\n")
    expected = spark.createDataFrame([("x/mortalitydata.csv",)], "file_name string")
    row = ld.inspect(spark, str(tmp_path), expected, ld.MORTALITY).first()
    assert (row.n_rows, row.missing_columns) == (1, ["year"])


def test_manifest_statuses_and_rules(spark):
    t = dt.datetime(2024, 1, 10)
    schema = "file_name string, size_bytes long, modified timestamp"
    now = spark.createDataFrame([("same", 1, t), ("grown", 2, t), ("newer", 1, t), ("fresh", 1, t)],
                                schema)
    old = spark.createDataFrame(
        [("same", 1, t), ("grown", 1, t), ("newer", 1, t - dt.timedelta(days=40)), ("gone", 1, t)],
        schema)
    assert {r.file_name: r.status for r in mf.manifest_diff(now, old).collect()} == {
        "same": "unchanged", "grown": "changed", "newer": "changed", "fresh": "new",
        "gone": "removed"}
    at = F.lit(t).cast("timestamp")

    def taken(rule):
        rows = mf.ingest_decision(now, old, rule, at).collect()
        return {r.file_name for r in rows if r.decision == "take"}

    assert taken("absent") == {"fresh"}
    assert taken("newer") == {"fresh", "newer"} == taken("age")
    assert taken("size") == {"fresh", "grown"}


def test_sink_keeps_numeric_codes_and_replaces_partitions(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("01", 2020, 1), ("01", 2021, 2), ("02", 2020, 3)],
                               "country_code string, year int, v int")
    sinks.write_partitioned(df, path)
    sinks.write_partitioned(df.filter("year = 2021").withColumn("v", F.lit(9)), path,
                            replace="partitions")
    back = tables.processed_table(spark, path, df.schema)
    assert sorted(map(tuple, back.select("country_code", "year", "v").collect())) == [
        ("01", 2020, 1), ("01", 2021, 9), ("02", 2020, 3)]
    plan = back.filter(F.col("country_code") == "01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(country_code" in plan
    sinks.write_partitioned(df.limit(1), path)
    assert tables.processed_table(spark, path, df.schema).count() == 1


def test_each_file_is_taken_once(spark, tmp_path):
    folder, target, state = (str(tmp_path / n) for n in ("land", "out", "state"))
    land(spark, folder, "O3_E1a.parquet", [reading("1"), reading("2")])
    schema = spark.createDataFrame([], RAW).schema
    def run():
        si.ingest_new_files(si.reading_stream(spark, folder, schema), target, state)
        return spark.read.parquet(target).count()
    assert run() == 2 and run() == 2
    land(spark, folder, "O3_E2a.parquet", [reading("3")])
    assert run() == 3
    levels = {r.verification_level for r in spark.read.parquet(target).collect()}
    assert levels == {"E1a", "E2a"}


def test_late_verified_values_replace_unverified_ones(spark, tmp_path):
    folder, target, state = (str(tmp_path / n) for n in ("land", "out", "state"))
    schema = spark.createDataFrame([], RAW).schema
    def run():
        si.accumulate_daily(si.reading_stream(spark, folder, schema), target, state)
        return si.current_daily(spark, target)
    land(spark, folder, "O3_E2a.parquet", [reading("10"), reading("30"),
                                           reading("5", "2024-06-01T00:00:00")])
    assert {r.date.month: r.value_mean for r in run().collect()} == {1: 20.0, 6: 5.0}
    land(spark, folder, "O3_E1a.parquet", [reading("7"), reading("8")])
    rows = {r.date.month: r for r in run().collect()}
    assert rows[1].value_mean == 7.5 and rows[1].verification_level == "E1a"
    assert rows[6].value_mean == 5.0
    batch = rd.daily_verified_first(rd.prepared(sr.load_readings(spark, folder)))
    assert sorted(map(str, batch.collect())) == sorted(map(str, run().collect()))


def test_windowed_means_emit_closed_days(spark, tmp_path):
    folder, target, state = (str(tmp_path / n) for n in ("land", "out", "state"))
    schema = spark.createDataFrame([], RAW).schema
    land(spark, folder, "O3_E1a.parquet",
         [reading(str(d), f"2024-01-{d:02d}T05:00:00") for d in range(1, 11)])
    si.run_windowed(si.reading_stream(spark, folder, schema), target, state)
    days = {r.date.day: r.value_mean for r in spark.read.parquet(target).collect()}
    assert days == {d: float(d) for d in range(1, 7)}


def test_unknown_modes_are_refused(spark):
    df = spark.createDataFrame([reading("1")], RAW)
    with pytest.raises(ValueError):
        rd.station_days(df, "other")


def test_bad_files_are_named_and_left_out(spark, tmp_path):
    from airshed.sources import quarantine

    folder, schema = f"{tmp_path}/in", "id long, x double"
    schema = spark.createDataFrame([], schema).schema
    rows = spark.range(10).select("id", F.col("id").cast("double").alias("x"))
    rows.coalesce(1).write.parquet(f"{folder}/a b.parquet")
    rows.withColumn("x", F.col("x").cast("string")).coalesce(1).write.parquet(f"{folder}/text.parquet")
    rows.limit(0).coalesce(1).write.parquet(f"{folder}/empty.parquet")
    rows.drop("x").withColumn("extra", F.lit(1)).coalesce(1).write.parquet(f"{folder}/less.parquet")
    (tmp_path / "in" / "broken.parquet").write_text("no footer")
    (tmp_path / "in" / "nothing.parquet").write_text("")
    report = quarantine.file_report(spark, folder, schema).cache()
    found = {r.file_name: (r.n_footer, r.n_read, r.reason) for r in report.collect()}
    plain = found.pop("a b.parquet", None) or found.pop("a%20b.parquet")
    assert plain == (10, 10, None) and found == {
        "text.parquet": (10, 0, quarantine.ROWS), "empty.parquet": (0, 0, None), "less.parquet": (10, 10, None),
        "broken.parquet": (0, 0, quarantine.FOOTER)}
    rows.coalesce(1).write.parquet(f"{folder}/late.parquet")
    taken = quarantine.sound_rows(spark, folder, schema, report)
    assert taken.count() == 20 and taken.filter("x is null").count() == 10 and taken.columns == ["id", "x"]


def test_a_sound_folder_is_read_whole(spark, tmp_path):
    from airshed.sources import quarantine

    rows = spark.range(10).select("id")
    rows.write.parquet(f"{tmp_path}/a.parquet")
    report = quarantine.file_report(spark, str(tmp_path), rows.schema)
    assert report.filter("reason is not null").count() == 0
    assert quarantine.sound_rows(spark, str(tmp_path), rows.schema, report).count() == 10
