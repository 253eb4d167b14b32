"""The whole chain from raw inputs to the feature store, as one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame

from airshed.operators import features, grid, readings, summary


def build(
    raw: DataFrame,
    weather_grid: DataFrame,
    stations: DataFrame,
    weekly: DataFrame,
    regions: DataFrame | None = None,
    levels_mode: str = "verified_first",
    frame: str = "rows",
    targets: str = "strict",
    interpolation: str = "bilinear",
) -> DataFrame:
    """Readings, weather grid and weekly deaths to one row per station-day.

    Nothing is counted or collected on the way; write the result once and derive
    summaries from what was written.
    """
    days = readings.station_days(raw, levels_mode)
    weather = grid.station_weather(weather_grid, stations, method=interpolation)
    joined = features.join_weather(days, weather)
    history = features.add_history(joined, frame, targets)
    return features.join_outcomes(features.add_calendar(history), weekly, regions)


def station_years(store: DataFrame) -> DataFrame:
    """Yearly summary from the written store."""
    return summary.station_year(store)
