"""Shape of the physical plans that matter at scale."""

from pyspark.sql import functions as F

from airshed.operators import features, grid, readings
from airshed.registry.inputs import Inputs

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_weather_join_adds_no_shuffle(spark):
    t = Inputs(spark, FOLDER)
    wide, weather = readings.station_days(t.raw), grid.station_weather(t.grid, t.stations)
    joined = features.join_weather(wide, weather)
    count = lambda df: plan_of(df).count("Exchange hashpartitioning")
    assert count(joined) <= count(wide) + count(weather)


def test_store_needs_one_window_shuffle(spark):
    t = Inputs(spark, FOLDER)
    joined = features.join_weather(t.wide, t.weather)
    plan = plan_of(features.add_history(joined))
    assert plan.count("Exchange hashpartitioning(station_id#") >= 1
    assert plan.count("Window [") == 1


def test_no_python_and_no_cartesian_in_the_store(spark):
    plan = plan_of(Inputs(spark, FOLDER).store)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas",
                "SortAggregate"):
        assert bad not in plan


def test_scan_reads_only_needed_columns(spark):
    t = Inputs(spark, FOLDER)
    plan = plan_of(t.wide.select("station_id", "pm25_mean"))
    schema = plan.split("ReadSchema: ")[1].split(">")[0]
    assert "props" not in schema


def test_country_filter_goes_below_the_window(spark, tmp_path):
    path = str(tmp_path / "days")
    Inputs(spark, FOLDER).wide.write.partitionBy("country_code", "year").parquet(path)
    stored = spark.read.parquet(path)
    plan = plan_of(features.add_lags(stored.filter(F.col("country_code") == "FR")))
    assert "PartitionFilters: [isnotnull(country_code" in plan


def test_station_days_are_not_merged_into_few_tasks(spark):
    t = Inputs(spark, FOLDER)
    for frame in (t.weather, features.join_weather(t.wide, t.weather)):
        assert plan_of(frame).count("REPARTITION_BY_NUM") == 2
