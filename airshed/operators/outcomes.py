"""Statistical tables of deaths and admissions: wide to long, harmonised, split and rated."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window, functions as F

from airshed import fixed_values as fv
from airshed.functions import columns as fx
from airshed.operators.joins import salted_left_join

WEEK_COLUMN = r"^\d{4}W\d{2}$"
YEAR_COLUMN = r"^\d{4}$"


def unpivot_matching(df: DataFrame, pattern: str, name: str, value: str) -> DataFrame:
    """Wide to long over the columns whose names match; values become numbers or null."""
    wide = [c for c in df.columns if re.match(pattern, c)]
    ids = [c for c in df.columns if c not in wide]
    numbers = df.select(*[F.col(f"`{c}`") for c in ids],
                        *[fx.number(F.col(f"`{c}`")).alias(c) for c in wide])
    return numbers.unpivot(ids, [f"`{c}`" for c in wide], name, value)


def unpivot_weeks(df: DataFrame) -> DataFrame:
    """Week columns ``YYYYWww`` to rows with year, week and the Monday of the week.

    Missing numbers and weeks the year does not have are dropped.
    """
    long = unpivot_matching(df, WEEK_COLUMN, "year_week", "deaths")
    long = long.withColumns({
        "year": F.substring("year_week", 1, 4).cast("int"),
        "week": F.substring("year_week", 6, 2).cast("int"),
    })
    long = long.withColumn("date", fx.iso_monday(F.col("year"), F.col("week")))
    return long.dropna(subset=["deaths", "date"]).drop("year_week")


def unpivot_years(df: DataFrame, value: str = "deaths") -> DataFrame:
    """Year columns ``YYYY`` to rows; missing numbers are dropped."""
    long = unpivot_matching(df, YEAR_COLUMN, "year", value)
    return long.withColumn("year", F.col("year").cast("int")).dropna(subset=[value])


def weekly_deaths(wide: DataFrame) -> DataFrame:
    """All-cause deaths of both sexes and all ages per NUTS3 region and ISO week."""
    totals = wide.filter(F.col("sex").isin("T", "TOTAL") & F.col("age").isin("TOTAL", "Y_GE0"))
    long = unpivot_weeks(totals.withColumnRenamed("geo", "nuts3_code"))
    return long.select(
        "nuts3_code", fx.country_of(F.col("nuts3_code")).alias("country_code"),
        "year", "week", "date", "deaths",
    )


def _codes(mode: str) -> list[str]:
    """``chapters`` counts each death once; ``as_coded`` adds the sub-ranges on top."""
    if mode == "chapters":
        return [fv.RESPIRATORY_CODES[0], fv.CIRCULATORY_CODES[0]]
    if mode == "as_coded":
        return fv.RESPIRATORY_CODES + fv.CIRCULATORY_CODES
    raise ValueError(f"unknown mode {mode!r}")


def cause_rows(wide: DataFrame, mode: str = "chapters", value: str = "deaths") -> DataFrame:
    """Annual rows of the two cause groups, still per geography and code."""
    chosen = wide.filter(F.col("icd10").isin(_codes(mode)))
    return unpivot_years(chosen, value).withColumn("cause_group", fx.cause_group(F.col("icd10")))


def cause_deaths(wide: DataFrame, mode: str = "chapters") -> DataFrame:
    """Deaths per NUTS2 region, year and cause group."""
    return (
        cause_rows(wide, mode)
        .filter(F.col("geo").isNotNull())
        .groupBy(
            F.col("geo").alias("nuts2_code"), fx.country_of(F.col("geo")).alias("country_code"),
            "year", "cause_group",
        )
        .agg(F.sum("deaths").alias("deaths"))
    )


def hospital_admissions(wide: DataFrame, mode: str = "chapters") -> DataFrame:
    """Admissions per country, year and cause group."""
    rows = cause_rows(wide, mode, "admissions")
    return (
        rows.filter(F.col("geo").isNotNull())
        .groupBy(F.upper("geo").alias("country_code"), "year", "cause_group")
        .agg(F.sum("admissions").alias("admissions"))
    )


def who_mortality(table: DataFrame, countries: dict[str, str] | None = None) -> DataFrame:
    """WHO rows of mapped countries with causes in chapters I and J."""
    cause = F.col("cause").cast("string")
    df = table.select(
        fx.lookup(countries or fv.WHO_COUNTRIES, F.col("country").cast("string"))
        .alias("country_code"),
        fx.number(F.col("year")).cast("int").alias("year"),
        F.when(cause.startswith("J"), "respiratory").otherwise("cardiovascular")
        .alias("cause_group"),
        fx.number(F.col("deaths1")).alias("deaths"),
        cause.rlike("^[IJ]").alias("in_scope"),
    )
    return df.filter("in_scope").drop("in_scope").dropna(
        subset=["country_code", "year", "deaths"]
    )


def harmonise_codes(df: DataFrame, correspondence: DataFrame, code: str = "nuts3_code",
                    vintage: str = "vintage", values: tuple[str, ...] = ()) -> DataFrame:
    """Region codes of older classifications to the current one; unlisted codes stay.

    A code that was split comes out once per new code.  ``values`` are shared out over
    them: by the ``share`` column of the correspondence where it has one, else evenly.
    """
    whole = F.count("*").over(Window.partitionBy("old_code", "vintage"))
    part = F.col("share") if "share" in correspondence.columns else 1 / whole
    table = correspondence.select(
        F.col("old_code").alias(code), F.col("vintage").alias(vintage), "new_code", part.alias("_part")
    )
    mapped = salted_left_join(df, table, [code, vintage], [c for c in df.columns])
    shared = {c: F.col(c) * F.coalesce("_part", F.lit(1.0)) for c in values}
    return mapped.withColumns({code: F.coalesce("new_code", code), **shared}).drop("new_code", "_part")


def regions_by_box(stations: DataFrame, boxes: DataFrame, cell: float = 1.0) -> DataFrame:
    """Station to the region whose bounding box holds it.

    The range join becomes an equi-join on coarse cells: a box is listed in each
    cell it touches, a station in its own.  If boxes overlap, the smallest area
    wins, then the smaller code.
    """
    def cells(low: str, high: str):
        return F.sequence(F.floor(F.col(low) / cell), F.floor(F.col(high) / cell))

    listed = boxes.select("*", F.explode(cells("south", "north")).alias("cy")).select(
        "*", F.explode(cells("west", "east")).alias("cx")
    )
    placed = stations.select(
        "station_id", "latitude", "longitude",
        F.floor(F.col("latitude") / cell).alias("cy"),
        F.floor(F.col("longitude") / cell).alias("cx"),
    )
    inside = F.col("latitude").between(F.col("south"), F.col("north")) & F.col(
        "longitude"
    ).between(F.col("west"), F.col("east"))
    area = F.round((F.col("north") - F.col("south")) * (F.col("east") - F.col("west")), 9)
    hits = salted_left_join(placed, listed, ["cy", "cx"], ["station_id"]).select(
        "station_id", F.when(inside, area).alias("area"),
        F.when(inside, F.col("nuts3_code")).alias("nuts3_code"),
    )
    best = F.min(F.when(F.col("area").isNotNull(), F.struct("area", "nuts3_code")))
    return hits.groupBy("station_id").agg(best.alias("best")).select(
        "station_id", F.col("best.nuts3_code").alias("nuts3_code")
    )


def split_by_cause(weekly: DataFrame, causes: DataFrame) -> DataFrame:
    """Approximate weekly deaths by cause.

    The share of a cause in the deaths of a NUTS2 region and year is applied to
    the weekly deaths of the NUTS3 regions inside it.  Shares become columns, so
    the weekly table is joined once.
    """
    nuts2 = F.substring("nuts3_code", 1, 4)
    annual = weekly.groupBy(nuts2.alias("nuts2_code"), "year").agg(
        F.sum("deaths").alias("all_deaths")
    )
    groups = ["respiratory", "cardiovascular"]
    wide = causes.groupBy("nuts2_code", "year").agg(*[
        F.sum(F.when(F.col("cause_group") == g, F.col("deaths"))).alias(g) for g in groups
    ])
    shares = annual.join(wide, ["nuts2_code", "year"], "left").select(
        "nuts2_code", "year",
        *[fx.ratio(F.col(g), F.col("all_deaths")).alias(f"{g}_share") for g in groups],
    )
    joined = salted_left_join(
        weekly.withColumn("nuts2_code", nuts2), shares, ["nuts2_code", "year"],
        ["nuts3_code", "week"],
    )
    return joined.withColumns({
        f"{g}_deaths": F.col("deaths") * F.col(f"{g}_share") for g in groups
    })


def rate_per_100k(df: DataFrame, population: DataFrame, keys: list[str],
                  value: str = "deaths") -> DataFrame:
    """Attach the population and the rate per 100,000 residents."""
    joined = df.join(population.select(*keys, "population"), keys, "left")
    rate = fx.ratio(F.col(value), F.col("population")) * 100_000
    return joined.withColumn("rate_per_100k", rate)


def missing_weeks(weekly: DataFrame, countries: DataFrame, start: str, end: str) -> DataFrame:
    """Mondays of the period on which a country reports nothing."""
    present = weekly.select("country_code", "date").distinct()
    return calendar(countries, start, end).join(present, ["country_code", "date"], "left_anti")


def calendar(countries: DataFrame, start: str, end: str) -> DataFrame:
    """One row per country and Monday; a calendar is bounded by the period."""
    first = fx.monday_of(F.date_add(F.lit(start).cast("date"), 6))
    mondays = F.sequence(first, F.lit(end).cast("date"), F.expr("interval 7 days"))
    return countries.select("country_code").distinct().select(
        "country_code", F.explode(mondays).alias("date")
    )


def completeness(weekly: DataFrame, start: str, end: str, minimum_pct: float = 90.0) -> DataFrame:
    """Weeks present and missing per country against the calendar of Mondays."""
    first = fx.monday_of(F.date_add(F.lit(start).cast("date"), 6))
    last = F.lit(end).cast("date")
    expected = F.floor(F.datediff(last, first) / 7) + 1
    inside = weekly.filter(F.col("date").between(F.lit(start), F.lit(end)))
    counted = inside.groupBy("country_code").agg(F.countDistinct("date").alias("weeks_present"))
    # Countries of which no week is there are the worst case, not an absent one.
    countries = weekly.select("country_code").distinct()
    counted = countries.join(counted, "country_code", "left").select(
        "country_code", F.coalesce("weeks_present", F.lit(0)).cast("long").alias("weeks_present"))
    pct = F.round(fx.ratio(F.col("weeks_present"), expected) * 100, 1)
    return counted.select(
        "country_code", "weeks_present", expected.alias("expected"),
        (expected - F.col("weeks_present")).alias("missing"), pct.alias("pct"),
        (pct < minimum_pct).alias("flagged"),
    )


def country_weeks(weekly: DataFrame) -> DataFrame:
    return weekly.groupBy("country_code", "date").agg(F.sum("deaths").alias("deaths"))
