"""Scalar expressions shared by the operators.  All are native Spark."""

from __future__ import annotations

import functools

from pyspark.sql import Column, functions as F

from airshed import fixed_values as fv


def nan_to_null(value: Column) -> Column:
    """NaN sorts above every number in Spark, so it must not reach a comparison."""
    return F.when(~F.isnan(value), value)


def number(value: Column) -> Column:
    """Text or number to double; bad text and NaN become null instead of raising."""
    return nan_to_null(value.try_cast("double"))


def local_date(value: Column) -> Column:
    """Date part of ISO text, keeping the writer's local day, or of a timestamp."""
    return value.try_cast("date")


def country_of(code: Column) -> Column:
    return F.upper(F.substring(code, 1, 2))


def iso_year(date: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), date).cast("int")


def iso_monday(year: Column, week: Column) -> Column:
    """Monday of an ISO week; null when the year has no such week."""
    fourth = F.make_date(year, F.lit(1), F.lit(4))
    monday = F.date_add(fourth, (week - 1) * 7 - F.weekday(fourth))
    exists = (F.weekofyear(monday) == week) & (iso_year(monday) == year)
    return F.when(exists, monday)


def monday_of(date: Column) -> Column:
    return F.date_sub(date, F.weekday(date))


def season_of(month: Column) -> Column:
    """Three-month seasons; an unknown month counts as autumn."""
    return (
        F.when(month.isin(12, 1, 2), "winter")
        .when(month.isin(3, 4, 5), "spring")
        .when(month.isin(6, 7, 8), "summer")
        .otherwise("autumn")
    )


def flag(condition: Column) -> Column:
    """1 or 0; unknown counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def exceeds(value: Column, limit: float) -> Column:
    """1 or 0, null where the value is missing."""
    return (value > F.lit(limit)).cast("int")


def lookup(mapping: dict, key: Column) -> Column:
    """Value of a small fixed map; null for unknown keys."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def cause_group(code: Column, respiratory: list[str] | None = None) -> Column:
    codes = fv.RESPIRATORY_CODES if respiratory is None else respiratory
    return F.when(code.isin(codes), "respiratory").otherwise("cardiovascular")


def ratio(part: Column, whole: Column) -> Column:
    """Division as double; null when the denominator is zero or missing."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def correlation(left: Column, right: Column) -> Column:
    """Pearson r over the pairs that are complete; null if either side is constant.

    The built-in ``corr`` raises on a constant side under ANSI rules.
    """
    both = left.isNotNull() & right.isNotNull()
    spread = F.stddev_samp(F.when(both, left)) * F.stddev_samp(F.when(both, right))
    return ratio(F.covar_samp(left, right), spread)


def near(left: Column, right: Column, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    """Equal within tolerance; two missing values are equal, one is not."""
    close = F.abs(left - right) <= F.lit(atol) + F.lit(rtol) * F.abs(right)
    return F.coalesce(close, left.isNull() & right.isNull())


def all_of(conditions: list[Column]) -> Column:
    return functools.reduce(lambda a, b: a & b, conditions)
