"""Gradient-boosted churn model on Spark ML: training frame, fit, batch scoring, explanation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType

from tidemark.operators.evaluation import SCORE_THRESHOLD, predicted
from tidemark.operators.merge import left_any_join

# Feature list, label and hyper-parameters of the churn model.
FEATURES = ("recency_days", "orders_last_30d", "monetary_365d", "avg_ticket", "tickets_support_90d")
LABEL = "churn_label"
SENSITIVE = ("gender", "age_band")
SEED = 42


@dataclass(frozen=True)
class Boosting:
    trees: int
    depth: int
    rate: float
    subsample: float = 1.0


PRIMARY = Boosting(400, 5, 0.08, 0.9)
FALLBACK = Boosting(300, 3, 0.05)


def training_frame(features: DataFrame, columns: Sequence[str] = FEATURES, label: str = LABEL) -> DataFrame:
    return features.where(F.col(label).isNotNull()).select(
        "customer_id", *[F.col(c).cast("double").alias(c) for c in columns], F.col(label).cast("int").alias(label)
    )


def check_signature(frame: DataFrame, columns: Sequence[str] = FEATURES) -> None:
    """Raises unless the frame has every feature as a number, as the model was trained on."""
    kinds = {f.name: f.dataType for f in frame.schema.fields}
    wrong = [c for c in columns if not isinstance(kinds.get(c), NumericType)]
    if wrong:
        raise ValueError(f"not numeric or missing in the scoring frame: {wrong}")


def train(
    frame: DataFrame, weight: float, columns: Sequence[str] = FEATURES, params: Boosting = PRIMARY, label: str = LABEL
) -> PipelineModel:
    """Fits on the cluster; `weight` multiplies the positive class."""
    weighted = frame.withColumn("_weight", F.when(F.col(label) == 1, F.lit(float(weight))).otherwise(F.lit(1.0)))
    assembler = VectorAssembler(inputCols=list(columns), outputCol="_features", handleInvalid="keep")
    trees = GBTClassifier(
        featuresCol="_features",
        labelCol=label,
        weightCol="_weight",
        maxIter=params.trees,
        maxDepth=params.depth,
        stepSize=params.rate,
        subsamplingRate=params.subsample,
        seed=SEED,
    )
    return Pipeline(stages=[assembler, trees]).fit(weighted)


def score(model: PipelineModel, frame: DataFrame, threshold: float = SCORE_THRESHOLD) -> DataFrame:
    """Adds `churn_score` and `churn_pred`; the model's own columns are dropped."""
    check_signature(frame)
    scored = model.transform(frame)
    probability = vector_to_array("probability").getItem(1)
    return scored.withColumn("churn_score", probability).select(
        *frame.columns, "churn_score", predicted("churn_score", threshold).alias("churn_pred")
    )


def with_sensitive(features: DataFrame, customers: DataFrame, columns: Sequence[str] = SENSITIVE) -> DataFrame:
    """Adds the sensitive columns of the current customer version; the feature grain stays 1:1."""
    versions = customers.select("customer_id", "is_current", "version", *columns)
    return left_any_join(features, versions, "customer_id", ["is_current", "version"]).drop("is_current", "version")


def feature_importance(model: PipelineModel, frame: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Importance per feature with the feature's mean over `frame`."""
    weights = model.stages[-1].featureImportances
    means = frame.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns])
    cells = [
        F.struct(F.lit(c).alias("feature"), F.lit(float(weights[i])).alias("importance"), F.col(c).alias("mean"))
        for i, c in enumerate(columns)
    ]
    return means.select(F.inline(F.array(*cells)))
