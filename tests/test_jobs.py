"""The jobs end to end on files, and that a second run changes nothing."""

import pytest
from pyspark.sql import functions as F

from airshed.operators import profile as pf
from airshed.plans import jobs
from airshed.registry.inputs import Inputs

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("run"))
    t = Inputs(spark, FOLDER)
    name = F.concat("AirPollutant", F.lit("_"), "verification_level", F.lit(".parquet"))
    files = t.raw.withColumn("source", name).drop("verification_level")
    files.write.partitionBy("source").parquet(f"{base}/raw")
    t.grid.write.parquet(f"{base}/grid")
    t.stations.write.parquet(f"{base}/stations")
    t.health_wide.write.parquet(f"{base}/stats/demo_r_mweek3")
    t.causes_wide.write.parquet(f"{base}/stats/hlth_cd_aro")
    t.causes_wide.withColumn("geo", F.substring("geo", 1, 2)).write.parquet(
        f"{base}/stats/hlth_co_hospit")
    return base


def all_jobs(spark, base):
    jobs.clean_readings(spark, f"{base}/raw", f"{base}/clean")
    jobs.clean_weather(spark, f"{base}/grid", f"{base}/stations", f"{base}/weather")
    jobs.clean_outcomes(spark, f"{base}/stats", f"{base}/health")
    jobs.join_features(spark, f"{base}/clean", f"{base}/weather", f"{base}/health/weekly_mortality",
                       f"{base}/store", f"{base}/years")
    store = spark.read.parquet(f"{base}/store")
    return sorted(map(str, store.select(sorted(store.columns)).collect()))


def test_jobs_equal_the_single_plan(spark, run):
    first = all_jobs(spark, run)
    expected = Inputs(spark, FOLDER).store
    assert first == sorted(map(str, expected.select(sorted(expected.columns)).collect()))
    assert all_jobs(spark, run) == first
    assert spark.read.parquet(f"{run}/years").count() > 0
    # No WHO file had landed, so that table has no partitions yet.
    who = spark.read.schema("cause_group string, deaths double, country_code string, year int")
    assert who.parquet(f"{run}/health/who_mortality").count() == 0
    assert spark.read.parquet(f"{run}/health/weekly_by_cause").count() > 0
    verdict = jobs.validate(spark, f"{run}/store", f"{run}/report").first()
    assert verdict.n_checks == 27
    report = spark.read.parquet(f"{run}/report")
    assert report.filter("critical").count() == 11
    failed = {r.check_name for r in report.filter("critical and not passed").collect()}
    assert failed <= {"baseline_auc_above_075", "baseline_recall_above_50"}


def test_landing_job_names_what_is_absent(spark, run):
    spark.range(3).selectExpr("id as Value").write.mode("overwrite").parquet(f"{run}/landed/O3_E1a.parquet")
    report = {r.file_name: r for r in jobs.landing(spark, f"{run}/landed", f"{run}/landing_report").collect()}
    assert len(report) == 10 and not any(r.passed for r in report.values())
    assert [n for n, r in report.items() if r.found] == ["O3_E1a.parquet"] and not report["O3_E1a.parquet"].columns_ok


def test_column_families(spark, run):
    families = pf.column_families(Inputs(spark, FOLDER).store)
    assert len(families["lag"]) == 33 and len(families["rolling"]) == 14
    assert families["target"] == ["pm25_exceedance_t1", "pm25_exceedance_t2"]
    assert "boundary_layer_height" in families["weather"] and "pm25_mean" in families["pollutant"]
