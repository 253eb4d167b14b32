"""Joins on keys with few distinct values."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def salted_left_join(
    left: DataFrame, right: DataFrame, keys: list[str], spread: list[str], salts: int = 8
) -> DataFrame:
    """Left join whose hot keys are split over ``salts`` tasks.

    Left rows get a salt from the ``spread`` columns; the right side is repeated
    once per salt.  Every pair still meets exactly once.  If the right side turns
    out small, Spark broadcasts it by its own size check and the salt is harmless.
    """
    if salts <= 1:
        return left.join(right, keys, "left")
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    repeated = right.select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    return left.withColumn("_salt", salt).join(repeated, [*keys, "_salt"], "left").drop("_salt")
