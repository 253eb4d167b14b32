"""Distribution shift between a baseline period and the current one.

Frames carry a boolean ``is_current``; false marks the baseline.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from airshed import fixed_values as fv
from airshed.functions import columns as fx
from airshed.operators.ordered import quantiles, running_totals
from airshed.session import cut_lineage

FLOOR = 1e-4


def long_features(df: DataFrame, features: list[str]) -> DataFrame:
    """One row per feature and distinct value with the number of rows in each period."""
    numeric = df.select("is_current", *[F.col(c).cast("double").alias(c) for c in features])
    long = numeric.unpivot(["is_current"], features, "feature", "value")
    return long.filter(F.col("value").isNotNull()).groupBy("feature", "value").agg(
        F.count_if(~F.col("is_current")).alias("n_base"),
        F.count_if("is_current").alias("n_current"),
    )


def baseline_edges(counts: DataFrame, bins: int = 10) -> DataFrame:
    """Inner quantile edges of each feature over the baseline: the stored artefact.

    Takes the counts of ``long_features``.
    """
    points = {f"e{i}": i / bins for i in range(1, bins)}
    found = quantiles(counts, ["feature"], "value", points, F.col("n_base"))
    return found.select("feature", F.array(*points).alias("edges"))


def psi_bins(df: DataFrame, features: list[str], bins: int = 10) -> DataFrame:
    """Share of each period per feature and bin; bin k holds edge(k-1) < value <= edge(k)."""
    # Edges and bins both come from the counts, so the table is read once.
    counts = cut_lineage(long_features(df, features))
    # One row per feature name: bounded by the schema, so it may be broadcast.
    edges = F.broadcast(baseline_edges(counts, bins))
    binned = counts.join(edges, ["feature"])
    place = F.size(F.filter("edges", lambda e: e < F.col("value"))).alias("bin")
    grouped = binned.groupBy("feature", place).agg(
        F.sum("n_base").alias("n_base"), F.sum("n_current").alias("n_current")
    )
    by_feature = Window.partitionBy("feature")
    return grouped.select(
        "feature", "bin", "n_base", "n_current",
        fx.ratio(F.col("n_base"), F.sum("n_base").over(by_feature)).alias("share_base"),
        fx.ratio(F.col("n_current"), F.sum("n_current").over(by_feature)).alias("share_current"),
    )


def _floored(share: str) -> Column:
    return F.greatest(F.col(share), F.lit(FLOOR))


def psi(df: DataFrame, features: list[str], bins: int = 10) -> DataFrame:
    """Population stability index per feature and its band: stable, warning or alert."""
    p, q = _floored("share_current"), _floored("share_base")
    found = psi_bins(df, features, bins).groupBy("feature").agg(
        F.sum((p - q) * F.log(p / q)).alias("psi")
    )
    return found.withColumn("level", psi_level())


def baseline_table(df: DataFrame, features: list[str], bins: int = 10) -> DataFrame:
    """What is stored of a training period: per feature its edges and the share of each bin.

    One row per feature; written once after training, so that later runs need no raw rows.
    """
    periods = psi_bins(df.withColumn("is_current", F.lit(False)), features, bins)
    shares = periods.groupBy("feature").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "share_base"))).alias("found"),
        F.sum("n_base").alias("n_base"),
    )
    edges = baseline_edges(long_features(df.withColumn("is_current", F.lit(False)), features), bins)
    filled = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)),
                         lambda b: F.coalesce(F.col("found")[b], F.lit(0.0)))
    return shares.join(edges, "feature").select("feature", "edges", filled.alias("shares"), "n_base")


def psi_against(current: DataFrame, table: DataFrame) -> DataFrame:
    """Population stability index of the current rows against a stored baseline."""
    features = [r["feature"] for r in table.select("feature").collect()]  # one row per column
    counts = current.select(*[F.col(c).cast("double").alias(c) for c in features]).unpivot(
        [], features, "feature", "value").filter(F.col("value").isNotNull())
    # One row per feature name: bounded by the schema, so it may be broadcast.
    placed = counts.join(F.broadcast(table), "feature").groupBy(
        "feature", F.size(F.filter("edges", lambda e: e < F.col("value"))).alias("bin")
    ).agg(F.count("*").alias("n"))
    bins = table.select("feature", F.posexplode("shares").alias("bin", "share_base"))
    joined = bins.join(placed, ["feature", "bin"], "left")
    whole = F.sum("n").over(Window.partitionBy("feature"))
    shares = joined.select("feature", "share_base", F.coalesce(fx.ratio(F.col("n"), whole), F.lit(0.0)).alias("share_current"))
    p, q = _floored("share_current"), _floored("share_base")
    found = shares.groupBy("feature").agg(F.sum((p - q) * F.log(p / q)).alias("psi"))
    return found.withColumn("level", psi_level())


def psi_level() -> Column:
    level = F.when(F.col("psi") > 0.25, "alert").when(F.col("psi") >= 0.1, "warning")
    return level.otherwise("stable")


def ks_test(df: DataFrame, features: list[str], alpha: float = 0.01) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic per feature with its asymptotic p value."""
    totals = running_totals(
        long_features(df, features), ["feature"], "value",
        {"base": F.col("n_base"), "current": F.col("n_current")},
    )
    upto = {w: fx.ratio(F.col(f"{w}_before") + F.col(w), F.col(f"{w}_total"))
            for w in ("base", "current")}
    found = totals.groupBy("feature").agg(
        F.max(F.abs(upto["base"] - upto["current"])).alias("statistic"),
        F.max("base_total").alias("n_base"), F.max("current_total").alias("n_current"),
    )
    n, m = F.col("n_base").cast("double"), F.col("n_current").cast("double")
    z = F.sqrt(fx.ratio(n * m, n + m)) * F.col("statistic")
    series = F.lit(0.0)
    for k in range(1, 31):
        series = series + 2 * (-1) ** (k - 1) * F.exp(-2.0 * k * k * z * z)
    # Below 0.2 the distribution function is under 1e-12 and the series is slow.
    p = F.when(z < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))
    return found.withColumn("p_value", p).withColumn("alert", F.col("p_value") < alpha)


def kl_divergence(df: DataFrame, score: str = "score", bins: int = 10,
                  alert: float = 0.1) -> DataFrame:
    """Divergence of the current score distribution from the baseline, fixed bins on [0, 1]."""
    place = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int").alias("bin")
    counts = df.filter(F.col(score).isNotNull()).groupBy(place).agg(
        F.count_if(~F.col("is_current")).alias("n_base"),
        F.count_if("is_current").alias("n_current"),
    )
    # One row per bin, so the window is short.
    whole = Window.partitionBy()
    shares = counts.select(
        fx.ratio(F.col("n_base"), F.sum("n_base").over(whole)).alias("share_base"),
        fx.ratio(F.col("n_current"), F.sum("n_current").over(whole)).alias("share_current"),
    )
    p, q = _floored("share_current"), _floored("share_base")
    found = shares.agg(F.sum(p * F.log(p / q)).alias("kl"))
    return found.withColumn("alert", F.col("kl") > alert)


def label_drift(df: DataFrame, value: str = "pm25_mean", limit: float = fv.EU_DAILY_LIMIT,
                tolerance: float = 10.0) -> DataFrame:
    """Exceedance share now against the baseline, in percentage points."""
    share = {
        name: F.avg(F.when(period, fx.exceeds(F.col(value), limit))) * 100
        for name, period in (("base_pct", ~F.col("is_current")), ("current_pct", F.col("is_current")))
    }
    found = df.agg(*[c.alias(n) for n, c in share.items()])
    moved = F.col("current_pct") - F.col("base_pct")
    return found.select("base_pct", "current_pct", moved.alias("difference"),
                        (F.abs(moved) > tolerance).alias("alert"))


def prediction_volume(predictions: DataFrame, expected_per_day: Column,
                      minimum: float = 0.5) -> DataFrame:
    """Predictions per day against the expected number."""
    daily = predictions.groupBy("date").agg(F.count("*").alias("n_predictions"))
    share = fx.ratio(F.col("n_predictions"), expected_per_day)
    return daily.select("date", "n_predictions", expected_per_day.alias("expected"),
                        share.alias("share"), (share < minimum).alias("alert"))
