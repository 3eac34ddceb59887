"""Model life cycle on shared storage: stored versions, promotion by gate, loading by stage.

A version is a folder with the fitted pipeline. Two small append-only logs hold what was registered
and which stage a version entered; the last entry counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.operators import churn, evaluation
from tidemark.sources import tables
from tidemark.sources.files import Files

VERSION_SCHEMA = "version int, run_id string, roc_auc double, features string, path string"
STAGE_SCHEMA = "version int, stage string, step int"
STAGING, PRODUCTION, ARCHIVED = "Staging", "Production", "Archived"


@dataclass(frozen=True)
class Stored:
    version: int
    model: PipelineModel
    features: tuple[str, ...]
    path: str


def _log(spark: SparkSession, home: str, name: str, schema: str) -> DataFrame:
    path = f"{home}/{name}"
    if not Files(spark, path).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def versions(spark: SparkSession, home: str) -> DataFrame:
    """Registered versions with their present stage."""
    newest = Window.partitionBy("version").orderBy(F.desc("step"))
    stages = _log(spark, home, "stages", STAGE_SCHEMA).withColumn("_n", F.row_number().over(newest)).where("_n = 1")
    return _log(spark, home, "versions", VERSION_SCHEMA).join(stages.select("version", "stage"), "version", "left")


def _enter(spark: SparkSession, home: str, moves: Sequence[tuple[int, str]]) -> None:
    step = _log(spark, home, "stages", STAGE_SCHEMA).count()
    rows = [(version, stage, step + i) for i, (version, stage) in enumerate(moves)]
    tables.append(spark.createDataFrame(rows, STAGE_SCHEMA).coalesce(1), f"{home}/stages")


def register(spark: SparkSession, home: str, model: PipelineModel, run_id: str, roc_auc: float, features: Sequence[str] = churn.FEATURES) -> int:
    """Stores a fitted model as the next version, in staging; returns its number."""
    version = (versions(spark, home).agg(F.max("version")).first()[0] or 0) + 1
    path = f"{home}/model-{version:05d}"
    model.write().overwrite().save(path)
    row = spark.createDataFrame([(version, run_id, float(roc_auc), ",".join(features), path)], VERSION_SCHEMA)
    tables.append(row.coalesce(1), f"{home}/versions")
    _enter(spark, home, [(version, STAGING)])
    return version


def promote(spark: SparkSession, home: str, run_id: str | None = None, min_roc_auc: float = evaluation.MIN_ROC_AUC):
    """Applies `promotion_gate` to the newest version; a promoted one replaces what was in production.

    Returns the decision row.
    """
    known = versions(spark, home)
    decision = evaluation.promotion_gate(known, min_roc_auc, run_id).first()
    if decision.promoted:
        serving = [r.version for r in known.where(F.col("stage") == PRODUCTION).collect() if r.version != decision.candidate_version]
        _enter(spark, home, [(v, ARCHIVED) for v in serving] + [(decision.candidate_version, PRODUCTION)])
    return decision


def load(spark: SparkSession, home: str, stage: str = PRODUCTION) -> Stored:
    """The newest version of a stage, with the columns it was trained on."""
    row = versions(spark, home).where(F.col("stage") == stage).orderBy(F.desc("version")).first()
    if row is None:
        raise LookupError(f"no model in stage {stage!r} under {home}")
    return Stored(row.version, PipelineModel.load(row.path), tuple(row.features.split(",")), row.path)


def score(stored: Stored, frame: DataFrame) -> DataFrame:
    """Batch scores by a stored version; the frame must have the columns of its signature, as numbers."""
    churn.check_signature(frame, stored.features)
    return churn.score(stored.model, frame)
