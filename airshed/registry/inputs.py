"""Inputs of the registered queries, derived by Spark from the given tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from airshed.operators import features, grid, outcomes, readings
from airshed.plans import feature_store
from airshed.registry.sql import VIEWS


class Inputs:
    """Lazy frames over one folder of Parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        text = VIEWS[name]
        used = [t for t in ("events", "lineitem", "orders", "customer") if f"{{{t}}}" in text]
        return self.spark.sql(text, **{t: self.table(t) for t in used})

    @cached_property
    def raw(self) -> DataFrame:
        return self.view("fx_readings")

    @cached_property
    def stations(self) -> DataFrame:
        return self.view("fx_stations")

    @cached_property
    def grid(self) -> DataFrame:
        hours = F.col("day_idx") * 24 + F.col("hour")
        return self.view("fx_grid").withColumn(
            "time", F.timestamp_seconds(F.lit(1704067200) + hours * 3600)
        ).drop("day_idx", "hour")

    @cached_property
    def health_wide(self) -> DataFrame:
        """One column per ISO week, as the statistical office publishes it."""
        label = F.concat("year", F.lit("W"), F.lpad(F.col("week").cast("string"), 2, "0"))
        weeks = [f"2024W{w:02d}" for w in range(1, 6)]
        return (
            self.view("fx_health")
            .groupBy(F.col("nuts3_code").alias("geo"), "sex", "age")
            .agg(*[F.sum(F.when(label == w, F.col("deaths"))).alias(w) for w in weeks])
        )

    @cached_property
    def causes_wide(self) -> DataFrame:
        years = [str(y) for y in range(2019, 2026)]
        return (
            self.view("fx_causes")
            .groupBy("geo", "icd10")
            .agg(*[F.sum(F.when(F.col("year") == int(y), F.col("deaths"))).alias(y)
                   for y in years])
        )

    @cached_property
    def weekly(self) -> DataFrame:
        return outcomes.weekly_deaths(self.health_wide)

    @cached_property
    def causes(self) -> DataFrame:
        return outcomes.cause_deaths(self.causes_wide)

    @cached_property
    def population(self) -> DataFrame:
        return self.view("fx_population")

    @cached_property
    def scores(self) -> DataFrame:
        return self.view("fx_scores")

    @cached_property
    def wide(self) -> DataFrame:
        return readings.station_days(self.raw)

    @cached_property
    def weather(self) -> DataFrame:
        return grid.station_weather(self.grid, self.stations)

    @cached_property
    def days(self) -> DataFrame:
        """Station-days with weather and region."""
        return features.add_region(features.join_weather(self.wide, self.weather))

    @cached_property
    def store(self) -> DataFrame:
        return feature_store.build(self.raw, self.grid, self.stations, self.weekly)
