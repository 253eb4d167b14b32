"""Scores against labels: thresholds, confusion counts, AUC, and rolling recall.

Frames carry ``label`` (0/1) and ``score``; rows missing either are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from airshed.functions import columns as fx
from airshed.operators.ordered import running_totals


def scored_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("label").isNotNull() & F.col("score").isNotNull())


def score_table(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per distinct score: positives and negatives on it, below it, and in all."""
    positive = F.col("label").cast("long")
    return running_totals(scored_only(df), keys or [], "score",
                          {"pos": positive, "neg": 1 - positive})


def threshold_precision_floor(df: DataFrame, floor: float = 0.20,
                              fallback: float = 0.5) -> DataFrame:
    """The threshold of highest recall among those with precision above the floor.

    Ties go to the lowest threshold.  One row; the fallback if none qualifies.
    """
    table = score_table(df)
    tp = F.col("pos_total") - F.col("pos_before")
    fp = F.col("neg_total") - F.col("neg_before")
    precision, recall = fx.ratio(tp, tp + fp), fx.ratio(tp, F.col("pos_total"))
    best = (
        table.select("score", precision.alias("precision"), recall.alias("recall"))
        .filter(F.col("precision") > floor)
        .orderBy(F.desc("recall"), "score")
        .limit(1)
    )
    return best.agg(
        F.coalesce(F.max("score"), F.lit(fallback)).alias("threshold"),
        F.max("recall").alias("recall"), F.max("precision").alias("precision"),
    )


def threshold_sweep(df: DataFrame, first: int = 30, last: int = 69) -> DataFrame:
    """Recall and precision at each threshold from first to last percent.

    Each row is put in its percent bin and the bins, at most 41, are summed from
    the top; no row is repeated per threshold.
    """
    score = F.col("score")
    near = F.floor(score * 100)
    percent = F.when(score >= (near + 1) / 100.0, near + 1).when(
        score < near / 100.0, near - 1
    ).otherwise(near)
    bounded = F.least(F.greatest(percent, F.lit(first - 1)), F.lit(last))
    bins = scored_only(df).groupBy(bounded.cast("int").alias("percent")).agg(
        F.sum("label").cast("long").alias("pos"), F.count("*").alias("n")
    )
    grid = bins.sparkSession.range(first, last + 1).select(F.col("id").cast("int").alias("percent"))
    totals = bins.agg(F.sum("pos"))
    above = Window.orderBy(F.desc("percent"))
    cumulative = (
        bins.join(grid, ["percent"], "full")
        .select("percent", F.sum(F.coalesce("pos", F.lit(0))).over(above).alias("tp"),
                F.sum(F.coalesce("n", F.lit(0))).over(above).alias("predicted"))
        .filter(F.col("percent") >= first)
    )
    return cumulative.select(
        (F.col("percent") / 100.0).alias("threshold"), "tp",
        (F.col("predicted") - F.col("tp")).alias("fp"),
        fx.ratio(F.col("tp"), totals.scalar()).alias("recall"),
        fx.ratio(F.col("tp"), F.col("predicted")).alias("precision"),
    )


def select_threshold(sweep: DataFrame, target: float = 0.90, policy: str = "highest",
                     fallback: float = 0.5) -> DataFrame:
    """The sweep's threshold that reaches the target recall: the highest, or the lowest."""
    pick = {"highest": F.max, "lowest": F.min}[policy]
    reaching = F.when(F.col("recall") >= target, F.col("threshold"))
    return sweep.agg(F.coalesce(pick(reaching), F.lit(fallback)).alias("threshold"))


def confusion(threshold: float) -> dict[str, Column]:
    predicted = F.col("score") >= threshold
    label = F.col("label") == 1
    return {
        "tp": F.count_if(label & predicted), "fp": F.count_if(~label & predicted),
        "fn": F.count_if(label & ~predicted), "tn": F.count_if(~label & ~predicted),
    }


def rates() -> dict[str, Column]:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return {
        "recall": fx.ratio(tp, tp + fn),
        "precision": fx.ratio(tp, tp + fp),
        "f1": fx.ratio(2 * tp, 2 * tp + fp + fn),
        "accuracy": fx.ratio(tp + tn, tp + fp + fn + tn),
        "safe_recall": fx.ratio(tn, tn + fp),
        "safe_precision": fx.ratio(tn, tn + fn),
    }


def _aggregated(df: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    error = F.col("score") - F.col("label")
    counts = [c.alias(n) for n, c in confusion(threshold).items()]
    grouped = scored_only(df).groupBy(*keys).agg(*counts, F.avg(error * error).alias("brier"))
    return grouped.select("*", *[c.alias(n) for n, c in rates().items()])


def roc_auc(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Area under the ROC curve by the rank sum; equal scores count one half."""
    keys = keys or []
    wins = F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0)
    table = score_table(df, keys)
    found = table.groupBy(*keys).agg(
        F.sum(wins).alias("u"), F.max("pos_total").alias("p"), F.max("neg_total").alias("q")
    )
    return found.select(*keys, fx.ratio(F.col("u"), F.col("p") * F.col("q")).alias("roc_auc"))


def classification_metrics(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Confusion counts, rates, Brier score and AUC: one row, all from one table of scores."""
    s, pos, neg = F.col("score"), F.col("pos"), F.col("neg")
    hit = s >= threshold
    cells = {"tp": F.when(hit, pos), "fp": F.when(hit, neg), "fn": F.when(~hit, pos), "tn": F.when(~hit, neg)}
    found = score_table(df).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in cells.items()],
        fx.ratio(F.sum(pos * (s - 1) * (s - 1) + neg * s * s), F.sum(pos + neg)).alias("brier"),
        F.sum(pos * (F.col("neg_before") + neg / 2.0)).alias("_u"),
        F.max(F.col("pos_total") * F.col("neg_total")).alias("_pq"),
    )
    return found.select(*cells, "brier", *[c.alias(n) for n, c in rates().items()],
                        fx.ratio(F.col("_u"), F.col("_pq")).alias("roc_auc"))


def recall_by(df: DataFrame, keys: list[str], threshold: float = 0.5,
              minimum: float = 0.85) -> DataFrame:
    found = _aggregated(df, keys, threshold)
    return found.select(*keys, "tp", "fn", "recall", (F.col("recall") >= minimum).alias("meets"))


def rolling_recall(predictions: DataFrame, truth: DataFrame,
                   windows: tuple[int, ...] = (7, 30)) -> DataFrame:
    """Recall and precision over the last 7 and 30 days, per day.

    Predictions (station_id, date, predicted) meet the truth that arrives later
    (station_id, date, label); days without truth yet count for nothing.  The
    windows run over daily totals, one row per day.
    """
    joined = predictions.join(truth, ["station_id", "date"], "left")
    label, predicted = F.col("label") == 1, F.col("predicted") == 1
    daily = joined.groupBy("date").agg(
        F.count_if(label & predicted).alias("tp"),
        F.count_if(label & ~predicted).alias("fn"),
        F.count_if(~label & predicted).alias("fp"),
    )
    columns = []
    for n in windows:
        w = Window.orderBy(F.unix_date("date")).rangeBetween(-(n - 1), 0)
        tp, fn, fp = (F.sum(c).over(w) for c in ("tp", "fn", "fp"))
        columns += [fx.ratio(tp, tp + fn).alias(f"recall_{n}d"),
                    fx.ratio(tp, tp + fp).alias(f"precision_{n}d")]
    return daily.select("date", "tp", "fn", "fp", *columns)


def temporal_split(df: DataFrame, train_end: str, validation_end: str) -> DataFrame:
    """Tag rows train, validation or test by date: up to and including each end."""
    date = F.col("date")
    return df.withColumn(
        "split",
        F.when(date <= F.lit(train_end).cast("date"), "train")
        .when(date <= F.lit(validation_end).cast("date"), "validation")
        .otherwise("test"),
    )


def select_champion(runs: DataFrame, recall_min: float = 0.90, psi_max: float = 0.25,
                    tolerance: float = 0.02) -> DataFrame:
    """Deploy a new model only if it is good, undrifted and no worse than the current one."""
    deploy = (
        (F.col("new_recall") >= recall_min)
        & (F.col("new_psi") <= psi_max)
        & (F.col("new_recall") >= F.col("current_recall") - tolerance)
    )
    return runs.withColumn("deploy", F.coalesce(deploy, F.lit(False)))


def retrain_decision(runs: DataFrame, recall_min: float = 0.80, psi_max: float = 0.25,
                     every_weeks: int = 4) -> DataFrame:
    """Whether to retrain and why; the first rule that applies decides."""
    recall, psi, weeks = F.col("rolling_recall"), F.col("max_psi"), F.col("weeks_since")
    reason = (
        F.when(~F.col("new_data"), "no new data")
        .when(recall < recall_min, "recall degradation")
        .when(psi > psi_max, "feature drift")
        .when(weeks >= every_weeks, "scheduled retrain")
        .otherwise("no trigger met")
    )
    df = runs.withColumn("reason", reason)
    return df.withColumn("retrain", ~F.col("reason").isin("no new data", "no trigger met"))
