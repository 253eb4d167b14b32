"""Cleaning of long sensor readings: one row per reading in, one per station-day out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from airshed import fixed_values as fv
from airshed.functions import columns as fx

KEYS = ["station_id", "pollutant", "date"]


def standardise(raw: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Clean names and types.  Absent columns are skipped, bad text becomes null."""
    df = raw.withColumnsRenamed(names or fv.RAW_COLUMN_NAMES)
    return df.withColumns({
        "value": fx.number(F.col("value")),
        "validity": F.col("validity").try_cast("int"),
    })


def with_calendar(df: DataFrame, start: str = "timestamp_start") -> DataFrame:
    """date, year, month and day_of_week (1 = Sunday) from the start of the reading."""
    return calendar_of(df.withColumn("date", fx.local_date(F.col(start))))


def calendar_of(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "year": F.year("date"),
        "month": F.month("date"),
        "day_of_week": F.dayofweek("date"),
    })


def with_country(df: DataFrame) -> DataFrame:
    return df.withColumn("country_code", fx.country_of(F.col("station_id")))


def valid_only(df: DataFrame, minimum: int = fv.MIN_VALIDITY) -> DataFrame:
    """Readings flagged valid that hold a non-negative number."""
    return df.filter(
        (F.col("validity") >= minimum) & F.col("value").isNotNull() & (F.col("value") >= 0)
    )


def clip(df: DataFrame, bounds: dict[str, float] | None = None) -> DataFrame:
    """Cap each pollutant at its bound; pollutants without a bound stay as they are."""
    bound = fx.lookup(bounds or fv.POLLUTANT_BOUNDS, F.col("pollutant"))
    return df.withColumn("value", F.least("value", bound))


def has_keys() -> Column:
    """Readings without station, pollutant or a readable start belong to no station-day."""
    return fx.all_of([F.col(c).isNotNull() for c in KEYS])


def prepared(raw: DataFrame) -> DataFrame:
    """Rename, cast, date, country, key and validity filters and clip: one narrow stage."""
    dated = with_country(with_calendar(standardise(raw)))
    return clip(valid_only(dated.filter(has_keys())))


def removed(raw: DataFrame) -> DataFrame:
    """One row: how many readings there are, and how many ``prepared`` leaves out and why."""
    return with_calendar(standardise(raw)).agg(*_removal_counts())


def _removal_counts() -> list[Column]:
    valid = F.coalesce((F.col("validity") >= fv.MIN_VALIDITY) & (F.col("value") >= 0), F.lit(False))
    return [
        F.count(F.lit(1)).alias("n_readings"),
        F.count_if(~has_keys()).alias("n_without_key"),
        F.count_if(has_keys() & ~valid).alias("n_invalid"),
        F.count_if(has_keys() & valid).alias("n_kept"),
    ]


def observed(raw: DataFrame, name: str = "removed") -> tuple[DataFrame, Observation]:
    """``prepared`` readings, with the counts of ``removed`` gathered by the pass that reads
    them; the observation has them once the plan was written."""
    dated = with_country(with_calendar(standardise(raw)))
    counts = Observation(name)
    return clip(valid_only(dated.observe(counts, *_removal_counts()).filter(has_keys()))), counts


def level_rank(levels: tuple[str, ...]) -> Column:
    """Position of the verification level; anything unlisted comes after the listed ones.

    A number rather than the text keeps the aggregation buffers fixed-width, so
    Spark hashes instead of sorting.
    """
    ranks = fx.lookup({level: i for i, level in enumerate(levels)}, F.col("verification_level"))
    return F.coalesce(ranks, F.lit(len(levels)))


def _level(rank: Column, levels: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in (*levels, "other")]), rank + 1)


def daily_mixed(df: DataFrame, levels: tuple[str, ...] = fv.VERIFICATION_LEVELS) -> DataFrame:
    """Station-pollutant-day statistics over readings of every level together."""
    daily = df.groupBy(*KEYS).agg(
        F.avg("value").alias("value_mean"),
        F.max("value").alias("value_max"),
        F.count("value").alias("reading_count"),
        F.min(level_rank(levels)).alias("rank"),
    )
    return with_level_name(daily, levels)


def _by_level(df: DataFrame, levels: tuple[str, ...]) -> DataFrame:
    """One row per station, pollutant, day and level.  Partial sums are formed before
    the shuffle, so a station that holds most readings costs one row per task."""
    return df.groupBy(*KEYS, level_rank(levels).alias("rank")).agg(
        F.avg("value").alias("value_mean"),
        F.max("value").alias("value_max"),
        F.count("value").alias("reading_count"),
    )


def daily_verified_first(
    df: DataFrame, levels: tuple[str, ...] = fv.VERIFICATION_LEVELS
) -> DataFrame:
    """Station-pollutant-day statistics over readings of the best level that day only."""
    measures = ["value_mean", "value_max", "reading_count"]
    daily = _by_level(df, levels).groupBy(*KEYS).agg(
        *[F.min_by(c, "rank").alias(c) for c in measures], F.min("rank").alias("rank")
    )
    return with_level_name(daily, levels)


def with_level_name(daily: DataFrame, levels: tuple[str, ...]) -> DataFrame:
    df = daily.withColumn("verification_level", _level(F.col("rank"), levels)).drop("rank")
    return calendar_of(with_country(df))


def _wide(daily: DataFrame, pick, slugs: dict[str, str]) -> DataFrame:
    """Conditional aggregates instead of ``pivot``: one aggregation, one shuffle."""
    sources = {"mean": "value_mean", "max": "value_max", "readings": "reading_count"}
    columns = [
        pick(F.col("pollutant") == name, source).alias(f"{slug}_{suffix}")
        for suffix, source in sources.items()
        for name, slug in slugs.items()
    ]
    wide = daily.groupBy("station_id", "date").agg(*columns)
    return calendar_of(with_country(wide))


def pivot_pollutants(daily: DataFrame, slugs: dict[str, str] | None = None) -> DataFrame:
    """Daily long rows to one row per station-day with mean, max and count per pollutant."""
    def pick(is_pollutant, source):
        return F.max(F.when(is_pollutant, F.col(source)))

    return _wide(daily, pick, slugs or fv.POLLUTANT_SLUGS)


def station_days(
    raw: DataFrame,
    mode: str = "verified_first",
    levels: tuple[str, ...] = fv.VERIFICATION_LEVELS,
    slugs: dict[str, str] | None = None,
) -> DataFrame:
    """Raw readings to the clean wide table, one row per station-day.

    ``verified_first`` picks the level and pivots in the same aggregation: two
    shuffles in all, the second over daily rows only.  ``mixed`` averages all
    levels together.
    """
    return days_of(prepared(raw), mode, levels, slugs)


def days_of(readings: DataFrame, mode: str = "verified_first", levels: tuple[str, ...] = fv.VERIFICATION_LEVELS,
            slugs: dict[str, str] | None = None) -> DataFrame:
    """The wide table from prepared readings."""
    slugs = slugs or fv.POLLUTANT_SLUGS
    if mode == "mixed":
        return pivot_pollutants(daily_mixed(readings, levels), slugs)
    if mode != "verified_first":
        raise ValueError(f"unknown mode {mode!r}")

    return pivot_levels(_by_level(readings, levels), slugs)


def pivot_levels(by_level: DataFrame, slugs: dict[str, str] | None = None) -> DataFrame:
    """Statistics by station, pollutant, day and level to the wide table, best level first."""
    def pick(is_pollutant, source):
        return F.min_by(F.when(is_pollutant, F.col(source)), F.when(is_pollutant, F.col("rank")))

    return _wide(by_level, pick, slugs or fv.POLLUTANT_SLUGS)


def level_partials(df: DataFrame, levels: tuple[str, ...] = fv.VERIFICATION_LEVELS, *by: str) -> DataFrame:
    """Sums of prepared readings that merge over files and batches."""
    return df.groupBy(*by, *KEYS, level_rank(levels).alias("rank")).agg(
        F.sum("value").alias("total"), F.count("value").alias("n"), F.max("value").alias("top"))


def merged_partials(partials: DataFrame) -> DataFrame:
    """Statistics by station, pollutant, day and level from partial sums."""
    merged = partials.groupBy(*KEYS, "rank").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n"), F.max("top").alias("top"))
    return merged.select(*KEYS, "rank", (F.col("total") / F.col("n")).alias("value_mean"),
                         F.col("top").alias("value_max"), F.col("n").alias("reading_count"))


def station_dimension(df: DataFrame) -> DataFrame:
    """One row per station with its coordinates.

    Distinct positions are formed first, so the choice among several positions
    of one station works on few rows; the smallest (latitude, longitude) wins,
    which makes the result repeatable.
    """
    positions = df.select("station_id", "latitude", "longitude").distinct()
    first = positions.groupBy("station_id").agg(
        F.min(F.struct("latitude", "longitude")).alias("position")
    )
    return with_country(first.select("station_id", "position.latitude", "position.longitude"))
