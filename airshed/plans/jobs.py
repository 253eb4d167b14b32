"""The jobs of a weekly run, from folder to folder.

    spark-submit ... -m airshed.plans.jobs readings RAW CLEAN

Each job reads its inputs once and writes its table once; later jobs read what
earlier ones wrote.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, functions as F

from airshed import fixed_values as fv
from airshed.operators import features, grid, metrics, models, outcomes, quality, readings, summary
from airshed.plans import incremental
from airshed.session import build_session
from airshed.sources import landing as landed
from airshed.sources import quarantine, tables
from airshed.sources.readings import load_readings
from airshed.sources.sinks import write_partitioned


def clean_readings(spark: SparkSession, source: str, target: str) -> None:
    """Raw reading files to the wide station-day table, and beside it (``TARGET_counts``) how
    many readings were left out and why, counted by the pass that writes."""
    valid, counts = readings.observed(load_readings(spark, source))
    write_partitioned(readings.days_of(valid), target)
    spark.createDataFrame([counts.get]).write.mode("overwrite").parquet(f"{target.rstrip('/')}_counts")


def clean_weather(spark: SparkSession, source: str, stations: str, target: str) -> None:
    """Hourly grid files and station table to station-day weather.  Grid files that cannot be
    read as declared are left out and named in ``TARGET_quarantine``."""
    noted = f"{target.rstrip('/')}_quarantine"
    quarantine.file_report(spark, source, tables.GRID_SCHEMA).write.mode("overwrite").parquet(noted)
    hours = quarantine.sound_rows(spark, source, tables.GRID_SCHEMA, spark.read.parquet(noted))
    write_partitioned(grid.station_weather(hours, spark.read.parquet(stations)), target)


def clean_outcomes(spark: SparkSession, source: str, target: str) -> None:
    """Statistical tables below one folder to weekly deaths, causes, admissions and WHO deaths."""
    weekly = outcomes.weekly_deaths(tables.wide_table(spark, f"{source}/demo_r_mweek3"))
    causes = outcomes.cause_deaths(tables.wide_table(spark, f"{source}/hlth_cd_aro"))
    admissions = outcomes.hospital_admissions(tables.wide_table(spark, f"{source}/hlth_co_hospit"))
    who = outcomes.who_mortality(tables.who_table(spark, source))
    write_partitioned(weekly, f"{target}/weekly_mortality")
    write_partitioned(causes, f"{target}/cause_deaths")
    write_partitioned(admissions, f"{target}/hospitalisations")
    write_partitioned(who, f"{target}/who_mortality")
    split = outcomes.split_by_cause(
        tables.processed_table(spark, f"{target}/weekly_mortality", tables.OUTCOME_SCHEMA), causes
    )
    write_partitioned(split, f"{target}/weekly_by_cause")


def join_features(spark: SparkSession, clean: str, weather: str, weekly: str, target: str,
                  aggregations: str) -> None:
    """Clean tables to the feature store, then the yearly summary from what was written."""
    joined = features.join_weather(spark.read.parquet(clean), spark.read.parquet(weather))
    history = features.add_calendar(features.add_history(joined))
    deaths = tables.processed_table(spark, weekly, tables.OUTCOME_SCHEMA)
    store = features.join_outcomes(history, deaths)
    write_partitioned(store, target)
    written = tables.processed_table(spark, target, store.schema)
    write_partitioned(summary.station_year(written), aggregations)


def baseline_checks(store: DataFrame) -> DataFrame:
    """Checks of a baseline model: trained on the first 70 % of the period, stopped early by
    the next 15 %, measured on the rest."""
    first, last = store.agg(F.min("date"), F.max("date")).first()
    ends = [str(first + (last - first) * part) for part in (0.70, 0.85)]
    rows = metrics.temporal_split(store, *ends)
    features = [c for c in fv.BASELINE_FEATURES if c in store.columns]
    complete = rows.dropna(subset=[*features, models.TARGET])
    there = {r["split"] for r in complete.select("split").distinct().collect()}
    if not {"train", "validation"} <= there:  # no model, so its checks are undecided: failed
        spark = store.sparkSession
        return quality.model_checks(
            spark.createDataFrame([(None, None)], "roc_auc double, recall double"),
            spark.createDataFrame([("none", 0.0)], "feature string, importance double"))
    model = models.train(rows, features)
    scored = models.score(model, rows.filter("split = 'test'"), features)
    measured = metrics.classification_metrics(scored.withColumn("label", F.col(models.TARGET)))
    return quality.model_checks(measured, models.importance(model, rows, features))


def validate(spark: SparkSession, store: str, target: str) -> DataFrame:
    """The whole report of a feature store, schema and baseline model included; returns the
    totals and the verdict."""
    table = spark.read.parquet(store)
    report = quality.quality_report(table, model=baseline_checks(table), schema=True)
    report.write.mode("overwrite").parquet(target)
    return quality.gate(spark.read.parquet(target))


def landing(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Check of the reading files below a folder, one row per expected file."""
    pollutants = spark.createDataFrame([(p,) for p in fv.POLLUTANT_BOUNDS], "pollutant string")
    levels = spark.createDataFrame([(x,) for x in fv.VERIFICATION_LEVELS], "verification_level string")
    expected = quality.expected_files(pollutants, levels).select("file_name")
    found = landed.inspect(spark, source, expected, landed.READINGS)
    quality.landing_report(found).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def update(spark: SparkSession, source: str, weather: str, weekly: str, base: str) -> DataFrame:
    """Station-days, feature store and yearly summary below ``base``, brought up to date with
    the reading files; returns the folders that were rebuilt."""
    return incremental.update(spark, source, weather, weekly, base)


JOBS = {"readings": clean_readings, "weather": clean_weather, "outcomes": clean_outcomes,
        "features": join_features, "validate": validate, "landing": landing,
        "update": update}


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("paths", nargs="+", help="inputs and outputs of the job, in its order")
    args = parser.parse_args()
    spark = build_session(f"airshed-{args.job}")
    result = JOBS[args.job](spark, *args.paths)
    if result is not None:
        result.show(truncate=False)


if __name__ == "__main__":
    main()
