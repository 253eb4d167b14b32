"""Feature store: weather and outcomes joined on, history features, calendar, targets.

The station-day table has one row per (station, date) because it comes out of an
aggregation on that key.  A station's window partition is therefore never longer
than the days on record, whatever the share of raw readings it contributed.  All
history features of one frame share a single exchange and a single sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from airshed import fixed_values as fv
from airshed.functions import columns as fx
from airshed.operators.joins import salted_left_join


def _by_day() -> Window:
    """Station series ordered by day number, usable by row and by calendar frames alike."""
    return Window.partitionBy("station_id").orderBy(F.unix_date("date"))


def join_weather(days: DataFrame, weather: DataFrame) -> DataFrame:
    """Attach station-day weather; every reading row is kept.

    Both sides are dealt by (station_id, date), so Spark reuses those partitions and the
    join itself shuffles nothing.
    """
    extra = [c for c in weather.columns if c not in ("year", "month", "country_code")]
    return days.join(weather.select(*extra), ["station_id", "date"], "left")


def lag_columns(columns: list[str], days: list[int], frame: str) -> dict[str, Column]:
    """``{column}_lag{n}``: n rows back, or (``calendar``) exactly n days back."""
    w = _by_day()
    if frame == "rows":
        return {f"{c}_lag{n}": F.lag(c, n).over(w) for c in columns for n in days}
    if frame == "calendar":
        return {
            f"{c}_lag{n}": F.max(c).over(w.rangeBetween(-n, -n)) for c in columns for n in days
        }
    raise ValueError(f"unknown frame {frame!r}")


def rolling_columns(columns: list[str], days: list[int], frame: str) -> dict[str, Column]:
    """``{column}_rolling{n}d``: mean over the past without today.

    ``rows`` covers the n-1 preceding rows, ``calendar`` the n preceding days.
    """
    w = _by_day()
    if frame == "rows":
        spec = {n: w.rowsBetween(-(n - 1), -1) for n in days}
    elif frame == "calendar":
        spec = {n: w.rangeBetween(-n, -1) for n in days}
    else:
        raise ValueError(f"unknown frame {frame!r}")
    return {f"{c}_rolling{n}d": F.avg(c).over(spec[n]) for c in columns for n in days}


def target_columns(mode: str, limit: float = fv.EU_DAILY_LIMIT) -> dict[str, Column]:
    """``pm25_exceedance_t1`` and ``_t2``: does the following row exceed the limit?

    ``strict`` leaves the target null where that row or its value is missing;
    ``as_coded`` counts a missing value as no exceedance.
    """
    w = _by_day()
    future = {h: F.lead("pm25_mean", h).over(w) for h in (1, 2)}
    if mode == "strict":
        return {f"pm25_exceedance_t{h}": fx.exceeds(v, limit) for h, v in future.items()}
    if mode == "as_coded":
        return {f"pm25_exceedance_t{h}": fx.flag(v > limit) for h, v in future.items()}
    raise ValueError(f"unknown mode {mode!r}")


def _present(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def add_lags(df: DataFrame, frame: str = "rows") -> DataFrame:
    columns = _present(df, fv.FEATURE_POLLUTANTS + fv.FEATURE_WEATHER)
    return df.select("*", *_named(lag_columns(columns, fv.LAG_DAYS, frame)))


def add_rolling(df: DataFrame, frame: str = "rows") -> DataFrame:
    columns = _present(df, fv.ROLLING_COLUMNS)
    return df.select("*", *_named(rolling_columns(columns, fv.ROLLING_DAYS, frame)))


def add_targets(df: DataFrame, mode: str = "strict") -> DataFrame:
    """Add both targets and keep the rows that have them."""
    return with_targets_only(df.select("*", *_named(target_columns(mode))))


def with_targets_only(df: DataFrame) -> DataFrame:
    return df.filter(
        F.col("pm25_exceedance_t1").isNotNull() & F.col("pm25_exceedance_t2").isNotNull()
    )


def _named(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in columns.items()]


def add_history(df: DataFrame, frame: str = "rows", targets: str = "strict",
                known_targets: bool = True) -> DataFrame:
    """Lags, rolling means and targets in one window stage, then the target filter.

    ``known_targets=False`` keeps every row, as scoring the newest days needs it.
    """
    lagged = _present(df, fv.FEATURE_POLLUTANTS + fv.FEATURE_WEATHER)
    rolled = _present(df, fv.ROLLING_COLUMNS)
    columns = {
        **lag_columns(lagged, fv.LAG_DAYS, frame),
        **rolling_columns(rolled, fv.ROLLING_DAYS, frame),
        **target_columns(targets),
    }
    history = df.select("*", *_named(columns))
    return with_targets_only(history) if known_targets else history


def add_calendar(df: DataFrame) -> DataFrame:
    month = F.col("month")
    return df.withColumns({
        "season": fx.season_of(month),
        "is_weekend": fx.flag(F.col("day_of_week").isin(1, 7)),
        "heating_season": fx.flag(month.isin(10, 11, 12, 1, 2, 3)),
    })


def add_week(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "iso_year": fx.iso_year(F.col("date")),
        "week_of_year": F.weekofyear("date"),
    })


def add_region(df: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """nuts3_code: from a station lookup, else the first five characters of the id."""
    if regions is None:
        return df.withColumn("nuts3_code", F.substring("station_id", 1, 5))
    return df.join(regions.select("station_id", "nuts3_code"), ["station_id"], "left")


def join_outcomes(
    df: DataFrame, weekly: DataFrame, regions: DataFrame | None = None, salts: int = 8
) -> DataFrame:
    """Attach weekly deaths on (nuts3_code, ISO year, ISO week); feature rows are kept.

    Keyed on the ISO year, so the days around New Year meet the week they belong
    to.  One region may hold a third of the rows: the feature side is salted by
    station and date, the small outcome side repeated per salt.
    """
    features = add_region(add_week(df), regions)
    outcomes = weekly.groupBy("nuts3_code", "year", "week").agg(
        F.sum("deaths").alias("weekly_deaths")
    )
    outcomes = outcomes.withColumnsRenamed({"year": "iso_year", "week": "week_of_year"})
    keys = ["nuts3_code", "iso_year", "week_of_year"]
    return salted_left_join(features, outcomes, keys, ["station_id", "date"], salts)


def model_frame(df: DataFrame, features: list[str] | None = None,
                target: str = "pm25_exceedance_t1") -> DataFrame:
    """Complete cases: rows with every model feature and the target."""
    return df.dropna(subset=[*_present(df, features or fv.BASELINE_FEATURES), target])


def enough_coverage(df: DataFrame, minimum_pct: float = 70.0) -> DataFrame:
    """Rows of stations whose PM2.5 coverage reaches the minimum."""
    return df.join(low_coverage_stations(df, minimum_pct), ["station_id"], "left_anti")


def low_coverage_stations(df: DataFrame, minimum_pct: float = 70.0) -> DataFrame:
    stations = df.groupBy("station_id").agg(
        F.count("date").alias("total"), F.count("pm25_mean").alias("with_pm25")
    )
    stations = stations.withColumn("pct", fx.ratio(F.col("with_pm25"), F.col("total")) * 100)
    return stations.filter(F.col("pct") < minimum_pct)
