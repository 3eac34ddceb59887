"""Classifier metrics, scoring summaries and the gates that act on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.ranking import quantiles_of_counts, running_totals
from tidemark.session import settle

MIN_ROC_AUC = 0.72
SCORE_THRESHOLD = 0.5
APPROVED, REJECTED = "aprobado", "rechazado"


def predicted(score: Column | str, threshold: float = SCORE_THRESHOLD) -> Column:
    c = F.col(score) if isinstance(score, str) else score
    return (c >= threshold).cast("int")


def class_weight(df: DataFrame, label: str = "churn_label") -> DataFrame:
    """Negatives, positives and the weight negatives / max(positives, 1) of the positive class."""
    neg, pos = F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)
    return df.agg(neg.alias("negatives"), pos.alias("positives"), (neg / F.greatest(pos, F.lit(1))).alias("weight"))


def model_metrics(scored: DataFrame, group: str, label: str = "churn_label", score: str = "churn_score") -> DataFrame:
    """ROC-AUC, average precision and Brier score per `group` (a model version, say).

    Rows collapse to one per distinct score; running totals from the highest score down then give
    both curves. Tied scores form one step, which is the rank-average rule for the AUC.
    """
    counts = (
        scored.where(F.col(label).isNotNull() & F.col(score).isNotNull())
        .groupBy(group, (-F.col(score)).alias("_down"))
        .agg(
            F.count_if(F.col(label) == 1).alias("pos"),
            F.count_if(F.col(label) == 0).alias("neg"),
        )
        .where(F.col("pos") + F.col("neg") > 0)
    )
    curve = running_totals(settle(counts, "score-counts"), group, "_down", ["pos", "neg"])
    pos, neg = F.col("pos"), F.col("neg")
    # Twice the pairs won: each negative loses to the positives above it and draws with its own step.
    wins = F.sum(neg * (F.col("upto_pos") * 2 - pos))
    precision_steps = F.sum(pos * (F.col("upto_pos") / (F.col("upto_pos") + F.col("upto_neg"))))
    error = (pos * F.pow(1 + F.col("_down"), 2)) + (neg * F.pow("_down", 2))
    total = curve.groupBy(group).agg(
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
        wins.alias("wins"),
        precision_steps.alias("steps"),
        F.sum(error).alias("error"),
    )
    both = (F.col("positives") > 0) & (F.col("negatives") > 0)
    pairs = F.when(both, F.col("positives").cast("double") * F.col("negatives") * 2)
    return total.select(
        group,
        "positives",
        "negatives",
        (F.col("wins") / pairs).alias("roc_auc"),
        (F.col("steps") / F.when(F.col("positives") > 0, F.col("positives"))).alias("pr_auc"),
        (F.col("error") / (F.col("positives") + F.col("negatives"))).alias("brier"),
    )


def scoring_summary(scoring: DataFrame, score: str = "churn_score", label: str = "churn_pred") -> DataFrame:
    """Rows, positives, mean and exact 95th percentile of a scoring partition, in one pass over it.

    Every row has a score and a 0/1 label.
    """
    cells = F.array(F.struct(F.lit(score).alias("measure"), F.col(score).cast("double").alias("value")))
    long = scoring.select(F.inline(cells), F.col(label).cast("bigint").alias("label"))
    counts = settle(
        long.groupBy("measure", "value").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("positives")),
        "score-values",
    )
    p95 = quantiles_of_counts(counts.where(F.col("value").isNotNull()), "measure", "value", "n", [0.95])
    totals = counts.groupBy("measure").agg(
        F.sum("n").alias("rows"),
        F.sum("positives").alias("positives"),
        (F.sum(F.col("value") * F.col("n")) / F.sum(F.when(F.col("value").isNotNull(), F.col("n")))).alias("mean_score"),
    )
    return totals.join(F.broadcast(p95), "measure", "left").select(  # one row each
        "rows", "positives", F.round("mean_score", 6).alias("mean_score"), F.round("quantile", 6).alias("p95_score")
    )


def promotion_gate(versions: DataFrame, min_roc_auc: float = MIN_ROC_AUC, run_id: str | None = None) -> DataFrame:
    """Decision on the newest version: promote it, or keep the newest one in production.

    With `run_id`, a newest version that another run registered is refused.
    """
    facts = versions.agg(
        F.max(F.struct("version", "run_id", "roc_auc")).alias("candidate"),
        F.max(F.when(F.col("stage") == "Production", F.col("version"))).alias("serving"),
    )
    good = F.coalesce(F.col("candidate.roc_auc") >= min_roc_auc, F.lit(False))
    if run_id is not None:
        good = good & (F.col("candidate.run_id") == run_id)
    return facts.select(
        F.col("candidate.version").alias("candidate_version"),
        F.col("candidate.run_id").alias("run_id"),
        F.col("candidate.roc_auc").alias("roc_auc"),
        F.lit(min_roc_auc).alias("min_roc_auc"),
        good.cast("int").alias("promoted"),
        F.when(good, F.col("candidate.version")).otherwise(F.col("serving")).alias("production_version"),
    )


def model_gate(tests: DataFrame, drift: DataFrame, threshold: float = 0.2) -> DataFrame:
    """Rejected if a test failed or the worst PSI is above `threshold`; PSI may be missing.

    `tests` is a one-row gate (tests_total, tests_failed), `drift` a PSI report.
    """
    worst = drift.agg(F.max(F.when(~F.isnan("psi"), F.col("psi"))).alias("drift_psi"))
    bad = (F.col("tests_failed") > 0) | F.coalesce(F.col("drift_psi") > threshold, F.lit(False))
    return tests.crossJoin(F.broadcast(worst)).select(  # one row by one row
        F.lit("model").alias("scope"),
        F.when(bad, REJECTED).otherwise(APPROVED).alias("status"),
        "tests_total",
        "tests_failed",
        F.round("drift_psi", 4).alias("drift_psi"),
    )
