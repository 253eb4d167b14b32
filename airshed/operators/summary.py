"""Summaries of the station-day table used by reports and by the causal analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from airshed import fixed_values as fv
from airshed.functions import columns as fx


def station_year(df: DataFrame) -> DataFrame:
    """Yearly figures per station.  ``days_with_data`` counts rows, ``days_with_pm25`` values."""
    pm25 = F.col("pm25_mean")
    return df.groupBy("country_code", "station_id", "year").agg(
        F.avg(pm25).alias("pm25_annual_mean"),
        F.count_if(pm25 > fv.EU_DAILY_LIMIT).alias("days_above_eu_limit"),
        F.count_if(pm25 > fv.WHO_ANNUAL_GUIDELINE).alias("days_above_who_guideline"),
        F.avg("boundary_layer_height").alias("mean_blh"),
        F.count("*").alias("days_with_data"),
        F.count(pm25).alias("days_with_pm25"),
    )


EXPOSURES = ["pm25_mean", "temp_2m", "wind_speed", "precipitation", "boundary_layer_height"]


def region_day_totals(df: DataFrame) -> DataFrame:
    """Sums and counts per region and day, from which daily and weekly means follow.

    The station-days are read and shuffled once for both; needs nuts3_code.
    """
    present = [c for c in EXPOSURES if c in df.columns]
    return (
        df.filter(F.col("nuts3_code").isNotNull())
        .groupBy("nuts3_code", "date")
        .agg(*[f(c).alias(f"{c}_{name}") for c in present
               for name, f in (("sum", F.sum), ("n", F.count))])
    )


def daily_means(totals: DataFrame) -> DataFrame:
    mean = fx.ratio(F.col("pm25_mean_sum"), F.col("pm25_mean_n"))
    return totals.select("nuts3_code", "date", mean.alias("pm25_mean"))


def weekly_means(totals: DataFrame) -> DataFrame:
    present = [c for c in EXPOSURES if f"{c}_n" in totals.columns]
    return totals.groupBy(
        "nuts3_code",
        fx.iso_year(F.col("date")).alias("iso_year"),
        F.weekofyear("date").alias("iso_week"),
    ).agg(
        *[fx.ratio(F.sum(f"{c}_sum"), F.sum(f"{c}_n")).alias(c) for c in present],
        F.sum("pm25_mean_n").alias("station_days"),
    )


def region_days(df: DataFrame) -> DataFrame:
    """Mean PM2.5 of a region's stations per day."""
    return daily_means(region_day_totals(df))


def region_week_exposure(df: DataFrame) -> DataFrame:
    """Mean of all station-days of a region in an ISO week, with weather means."""
    return weekly_means(region_day_totals(df))


def episodes(
    region_day: DataFrame, limit: float = fv.EU_DAILY_LIMIT, min_days: int = 3
) -> DataFrame:
    """Runs of consecutive days above the limit, at least ``min_days`` long.

    Days above the limit minus their running number is constant inside a run.
    There is one row per region and day, so a window is as long as the calendar.
    """
    w = Window.partitionBy("nuts3_code").orderBy("date")
    above = region_day.filter(F.col("pm25_mean") > limit)
    runs = above.withColumn("run", F.date_sub("date", F.row_number().over(w)))
    found = runs.groupBy("nuts3_code", "run").agg(
        F.min("date").alias("start_date"),
        F.max("date").alias("end_date"),
        F.count("*").alias("days"),
        F.max("pm25_mean").alias("peak"),
    )
    return found.filter(F.col("days") >= min_days).drop("run")


def seasonal_means(df: DataFrame) -> DataFrame:
    """Country, year and season means; season from the month."""
    return df.groupBy("country_code", "year", fx.season_of(F.col("month")).alias("season")).agg(
        F.avg("pm25_mean").alias("pm25_mean"), F.count("pm25_mean").alias("n")
    )


def country_days(df: DataFrame) -> DataFrame:
    return df.groupBy("country_code", "date").agg(F.avg("pm25_mean").alias("pm25_mean"))


def cross_border_corr(df: DataFrame) -> DataFrame:
    """Yearly correlation of country-day means, for each pair of countries in the data.

    Pairs are formed of countries within a year and of country-days within a day, so their
    number is bounded by the calendar and the list of countries, whatever the number of
    stations.  A pair with fewer than two common days has no correlation: null.
    """
    days = country_days(df).filter(F.col("country_code").isNotNull()).withColumn("year", F.year("date"))
    value = F.col("pm25_mean")
    first = days.select("year", "date", F.col("country_code").alias("country_a"), value.alias("a"))
    second = days.select("date", F.col("country_code").alias("country_b"), value.alias("b"))
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    found = first.join(second, "date").filter("country_a < country_b").groupBy(
        "year", "country_a", "country_b"
    ).agg(fx.correlation(F.col("a"), F.col("b")).alias("r"), F.count_if(both).alias("n_days"))
    listed = days.select("year", "country_code").distinct()
    pairs = listed.withColumnRenamed("country_code", "country_a").join(
        listed.withColumnRenamed("country_code", "country_b"), "year"
    ).filter("country_a < country_b")
    return pairs.join(found, ["year", "country_a", "country_b"], "left").select(
        "year", "country_a", "country_b", F.when(F.col("n_days") > 1, F.col("r")).alias("r"),
        F.coalesce("n_days", F.lit(0)).cast("long").alias("n_days"),
    )
