"""Registered queries: a Spark function each, and where SQL can say the same, that SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from airshed.registry.inputs import Inputs
from airshed.registry.sql import with_ctes

# Doubles are compared at six digits.  Means of short decimals can fall exactly on a
# rounding tie, where engines differ by the last bit; both sides move up by TIE first.
DIGITS = 6
TIE = 1e-10


@dataclass(frozen=True)
class Query:
    run: Callable[[Inputs], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None, rounded: str = ""):
    """Register a function of ``Inputs`` under its own name.

    ``sql`` may use the shared CTEs; ``rounded`` lists its double columns, which
    are rounded like the Spark side, where every double column is.
    """
    def register(function: Callable[[Inputs], DataFrame]):
        text = None
        if sql is not None:
            replaced = ", ".join(f"round({c} + {TIE}, {DIGITS}) + 0.0 as {c}" for c in rounded.split())
            body = f"select * replace ({replaced}) from ({sql}) q" if replaced else sql
            text = with_ctes(body)
        REGISTRY[function.__name__] = Query(function, text)
        return function

    return register


def rounded_doubles(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.round(F.col(f"`{f.name}`") + TIE, DIGITS).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(q: Query):
        return lambda spark, sf_dir: rounded_doubles(q.run(Inputs(spark, sf_dir)))

    return {name: bound(q) for name, q in REGISTRY.items()}


def oracle_queries() -> dict[str, str]:
    return {name: q.sql for name, q in REGISTRY.items() if q.sql is not None}
