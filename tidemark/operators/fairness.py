"""Selection rates by sensitive group, demographic parity and disparate impact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Limits of the severities, label of the NULL group.
PARITY_LOW, PARITY_MEDIUM = 0.05, 0.10
IMPACT_LOW, IMPACT_MEDIUM = 0.80, 0.70
NO_DATA = "(sin dato)"
LOW, MEDIUM, HIGH = "baja", "media", "alta"


def prediction_of(df: DataFrame, label: str = "churn_pred", score: str = "churn_score", threshold: float = 0.5) -> Column:
    """The stored label if there is one, else the thresholded score. A NULL counts as not selected."""
    if label in df.columns:
        return F.coalesce(F.col(label).cast("int"), F.lit(0))
    if score in df.columns:
        return F.coalesce((F.col(score) >= threshold).cast("int"), F.lit(0))
    raise ValueError(f"neither {label!r} nor {score!r} is a column of the scoring frame")


def bias_groups(scoring: DataFrame, sensitive: Sequence[str], **prediction: object) -> DataFrame:
    """Rows (attribute, group, n, positives, rate) for all attributes from one scan."""
    pairs = [
        F.struct(F.lit(a).alias("attribute"), F.coalesce(F.col(a).cast("string"), F.lit(NO_DATA)).alias("group"))
        for a in sensitive
    ]
    return (
        scoring.select(prediction_of(scoring, **prediction).alias("selected"), F.inline(F.array(*pairs)))
        .groupBy("attribute", "group")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("selected").alias("positives"))
        .withColumn("rate", F.col("positives") / F.col("n"))
    )


def parity_severity(gap: Column) -> Column:
    return F.when(gap <= PARITY_LOW, LOW).when(gap <= PARITY_MEDIUM, MEDIUM).otherwise(HIGH)


def impact_severity(ratio: Column) -> Column:
    return F.when(ratio >= IMPACT_LOW, LOW).when(ratio >= IMPACT_MEDIUM, MEDIUM).otherwise(HIGH)


def bias_metrics(groups: DataFrame) -> DataFrame:
    """Two findings per attribute; ties between groups go to the alphabetically first."""
    # Both picks order by rate, then by group name ascending.
    span = groups.groupBy("attribute").agg(
        F.min(F.struct(F.col("rate"), F.col("group"))).alias("least"),
        F.min(F.struct((-F.col("rate")).alias("minus"), F.col("group"))).alias("most"),
    )
    low, high = F.col("least.rate"), -F.col("most.minus")
    gap = high - low
    ratio = F.when(high == 0, F.lit(1.0)).otherwise(low / F.when(high != 0, high))

    def finding(metric: str, value: Column, severity: Column) -> Column:
        return F.struct(
            F.lit(metric).alias("metric"), F.round(value, 4).alias("value"), severity.alias("severity")
        )

    return span.select(
        "attribute",
        F.col("least.group").alias("lowest_group"),
        F.col("most.group").alias("highest_group"),
        F.inline(
            F.array(
                finding("demographic_parity", gap, parity_severity(gap)),
                finding("disparate_impact", ratio, impact_severity(ratio)),
            )
        ),
    )
