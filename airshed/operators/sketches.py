"""Mergeable sketches of a table as a stored artefact: quantiles (KLL) and distinct counts (HLL).

A sketch table has one row per key and column, a few kilobytes each.  Tasks build sketches of
what they read and the aggregation merges them, so no value is shuffled; the tables of single
weeks or partitions merge the same way, without the rows they came from.  The rank error of a
KLL sketch of parameter k = 2048 is about 0.2 %, whatever the number of values; up to k values
it is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from airshed.operators import drift

K = 2048
LG_K = 12


def value_sketches(df: DataFrame, columns: list[str], keys: tuple[str, ...] = (), k: int = K) -> DataFrame:
    """Rows (keys, feature, sketch, n) for numeric columns; null and NaN are left out."""
    def usable(c: str):
        value = F.col(f"`{c}`").cast("double")
        return F.when(~F.isnan(value), value)

    parts = [F.struct(F.kll_sketch_agg_double(usable(c), F.lit(k)).alias("sketch"), F.count(usable(c)).alias("n")).alias(f"s{i}")
             for i, c in enumerate(columns)]
    found = df.groupBy(*keys).agg(*parts)
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"s{i}.sketch"), F.col(f"s{i}.n")) for i, c in enumerate(columns)])
    return found.select(*keys, F.inline(rows))


def merge_values(tables: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Sketch rows of several parts, one row per key and feature."""
    # A part without values has an empty sketch, which merges like any other.
    return tables.groupBy(*keys, "feature").agg(F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, points: dict[str, float]) -> DataFrame:
    """The sketch rows with a column per point; null where there are no values."""
    ranks = {name: F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(p)))) for name, p in points.items()}
    return sketches.withColumns(ranks).drop("sketch")


def psi(base: DataFrame, current: DataFrame, bins: int = 10) -> DataFrame:
    """Population stability index of two sketch tables (one row per feature each) and its band.

    Bins lie between the baseline's quantiles, as in ``drift.psi``; both shares of a bin come
    from ranks, each off by at most twice the rank error of the sketches.
    """
    points = {f"e{i}": i / bins for i in range(1, bins)}
    # One row of edges per feature name: bounded by the schema.  Ranks are asked for at literals.
    edges = {r["feature"]: [r[p] for p in points] for r in quantiles(base.filter("n > 0"), points).collect()}
    both = base.filter("n > 0").select("feature", F.col("sketch").alias("old")).join(
        current.filter("n > 0").select("feature", F.col("sketch").alias("new")), "feature")

    def shares(sketch: str):
        ranks = F.array().cast("array<double>")
        for feature, at in edges.items():
            found = F.array(F.lit(0.0), *[F.kll_sketch_get_rank_double(sketch, F.lit(e)) for e in at], F.lit(1.0))
            ranks = F.when(F.col("feature") == feature, found).otherwise(ranks)
        return ranks

    ranked = both.select("feature", shares("old").alias("q"), shares("new").alias("p"))
    each = ranked.select("feature", F.explode(F.transform(F.sequence(F.lit(1), F.lit(bins)), lambda i: F.struct(
        (F.get("p", i) - F.get("p", i - 1)).alias("share_current"), (F.get("q", i) - F.get("q", i - 1)).alias("share_base")))).alias("b"))
    p, q = (F.greatest(F.col(f"b.{c}"), F.lit(drift.FLOOR)) for c in ("share_current", "share_base"))
    found = each.groupBy("feature").agg(F.sum((p - q) * F.log(p / q)).alias("psi"))
    return found.withColumn("level", drift.psi_level())


def distinct_sketches(df: DataFrame, column: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Rows (keys, sketch) that count the distinct values of a column."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(F.col(column).cast("string"), LG_K).alias("sketch"))


def distinct_counts(tables: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Distinct values over merged sketch rows."""
    merged = tables.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(*keys, F.hll_sketch_estimate("sketch").alias("n_distinct"))


def within(found: DataFrame, exact: DataFrame, key: str, value: str, error: float) -> DataFrame:
    """Rows (key, exact value, close): whether a sketched value is within ``error`` of the exact one."""
    both = exact.select(key, value).join(found.select(key, F.col(value).alias("_found")), key)
    return both.select(key, value, (F.abs(F.col("_found") - F.col(value)) <= error).alias("close"))
