"""Exceedance classifiers with Spark ML: train, score, importance."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from airshed.session import cut_lineage

TARGET = "pm25_exceedance_t1"


def with_class_weight(df: DataFrame, target: str = TARGET, split: str = "split") -> DataFrame:
    """Weight positives by negatives / positives of the training rows."""
    counts = df.filter(F.col(split) == "train").agg(
        F.count_if(F.col(target) == 0).alias("neg"), F.count_if(F.col(target) == 1).alias("pos")
    )
    weight = counts.select(F.coalesce(F.try_divide("neg", "pos"), F.lit(1.0))).scalar()
    return df.withColumn("weight", F.when(F.col(target) == 1, weight).otherwise(F.lit(1.0)))


def classifier(kind: str, rounds: int = 300, seed: int = 42):
    """``gbt`` is the model of record, ``forest`` and ``logistic`` are for comparison."""
    common = {"featuresCol": "features", "labelCol": "label", "weightCol": "weight"}
    if kind == "gbt":
        return GBTClassifier(maxIter=rounds, stepSize=0.05, maxDepth=5, seed=seed,
                             validationIndicatorCol="is_validation", **common)
    if kind == "forest":
        return RandomForestClassifier(numTrees=rounds, maxDepth=5, seed=seed, **common)
    if kind == "logistic":
        return LogisticRegression(maxIter=rounds, regParam=0.01, **common)
    raise ValueError(f"unknown classifier {kind!r}")


def train(df: DataFrame, features: list[str], target: str = TARGET, kind: str = "gbt",
          rounds: int = 300) -> PipelineModel:
    """Fit on rows tagged train; gbt also watches the validation rows and stops early.

    Rows missing a feature or the target are left out.
    """
    rows = with_class_weight(df.dropna(subset=[*features, target]), target)
    used = rows.filter(F.col("split").isin("train", "validation")).select(
        *[F.col(c).cast("double").alias(c) for c in features],
        F.col(target).cast("double").alias("label"), "weight",
        (F.col("split") == "validation").alias("is_validation"),
    )
    if kind != "gbt":
        used = used.filter(~F.col("is_validation"))
    # Fitting reads the rows many times; keep them so the features are made once.
    used = cut_lineage(used)
    stages = [VectorAssembler(inputCols=features, outputCol="features"),
              classifier(kind, rounds)]
    return Pipeline(stages=stages).fit(used)


def score(model: PipelineModel, df: DataFrame, features: list[str],
          threshold: float = 0.5) -> DataFrame:
    """Batch scoring: one row per input row, with the probability and the decision at the
    stored threshold.  A row that lacks a feature has no score; ``missing`` names what it lacks.
    """
    values = {f"_x{i}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for i, c in enumerate(features)}
    rows = df.select("*", missing_features(df, features).alias("missing"),
                     F.array(*values.values()).alias("_values"))
    rows = rows.withColumn("features", array_to_vector("_values"))
    scored = PipelineModel(model.stages[1:]).transform(rows)
    probability = F.when(F.col("missing") == "", vector_to_array("probability")[1])
    kept = scored.select(*df.columns, "missing", probability.alias("score"))
    return kept.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def missing_features(df: DataFrame, features: list[str]) -> Column:
    """Names of the features a row lacks, joined by commas."""
    return F.concat_ws(",", *[F.when(F.col(c).isNull() | F.isnan(F.col(c).cast("double")), F.lit(c))
                              for c in features])


def save(model: PipelineModel, features: list[str], threshold: float, path: str) -> None:
    """The model with its features and threshold below one path."""
    model.write().overwrite().save(f"{path}/model")
    _session().createDataFrame([(features, float(threshold))], "features array<string>, threshold double").coalesce(
        1).write.mode("overwrite").parquet(f"{path}/decision")


def load(path: str) -> tuple[PipelineModel, list[str], float]:
    """What ``save`` has stored."""
    decision = _session().read.parquet(f"{path}/decision").first()
    return PipelineModel.load(f"{path}/model"), list(decision["features"]), decision["threshold"]


def _session() -> SparkSession:
    return SparkSession.getActiveSession()


def importance(model: PipelineModel, df: DataFrame, features: list[str]) -> DataFrame:
    """Importance per feature, largest first; trees only."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(v)) for name, v in zip(features, values)]
    table = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")
