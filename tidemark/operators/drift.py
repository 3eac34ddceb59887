"""Population stability index per feature between a reference and a current frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.ranking import quantiles_of_counts
from tidemark.session import settle

STABLE_BELOW = 0.1
FREEZE_ABOVE = 0.2
FLOOR = 1e-6  # share given to an empty bin so the logarithm exists


def unpivot(df: DataFrame, features: Sequence[str], *by: str) -> DataFrame:
    """Rows (`by`, feature, value) for every feature column, so all features run in one job."""
    pairs = [F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]
    return df.select(*by, F.inline(F.array(*pairs))).where(F.col("value").isNotNull() & ~F.isnan("value"))


def drift_state(psi: Column, threshold: float = FREEZE_ABOVE) -> Column:
    # States of the drift report.
    return (
        F.when(psi.isNull() | F.isnan(psi), "sin_datos")
        .when(psi < STABLE_BELOW, "estable")
        .when(psi <= threshold, "vigilar")
        .otherwise("congelar")
    )


def psi_report(
    reference: DataFrame,
    current: DataFrame,
    features: Sequence[str],
    bins: int = 10,
    threshold: float = FREEZE_ABOVE,
) -> DataFrame:
    """Rows (feature, psi, state, n_reference, n_current) over all rows of both frames.

    Bin edges are the exact quantiles of the reference; the outer bins are open. Each frame is read
    once: both collapse to counts per distinct value, which give the edges and the bins.
    """
    one, none = F.lit(1), F.lit(0)
    both = unpivot(reference, features).select("feature", "value", one.alias("r"), none.alias("c"))
    both = both.unionByName(unpivot(current, features).select("feature", "value", none.alias("r"), one.alias("c")))
    values = settle(both.groupBy("feature", "value").agg(F.sum("r").alias("r"), F.sum("c").alias("c")), "drift-values")
    probs = [i / bins for i in range(bins + 1)]
    edges = (
        quantiles_of_counts(values, "feature", "value", "r", probs)
        .groupBy("feature")
        .agg(F.array_sort(F.collect_set("quantile")).alias("edges"))  # at most bins + 1 values
        .select("feature", "edges", F.slice("edges", F.lit(2), F.greatest(F.size("edges") - 2, F.lit(0))).alias("inner"))
    )
    bin_no = F.size(F.filter(F.coalesce("inner", F.array().cast("array<double>")), lambda e: e <= F.col("value")))
    binned = (
        values.join(F.broadcast(edges), "feature", "left")  # one row per name in `features`
        .groupBy("feature", bin_no.alias("bin"))
        .agg(F.sum("r").alias("r"), F.sum("c").alias("c"), F.first(F.size("edges")).alias("n_edges"))
    )
    sizes = binned.groupBy("feature").agg(
        F.sum("r").alias("n_reference"),
        F.sum("c").alias("n_current"),
        F.max("n_edges").alias("n_edges"),
        F.collect_list(F.struct("r", "c")).alias("shares"),  # at most `bins` entries
    )

    def term(bucket: Column) -> Column:
        a = F.greatest(bucket["c"] / F.col("n_current"), F.lit(FLOOR))
        r = F.greatest(bucket["r"] / F.col("n_reference"), F.lit(FLOOR))
        return (a - r) * F.ln(a / r)

    total = F.aggregate(F.array_sort(F.transform("shares", term)), F.lit(0.0), lambda acc, x: acc + x)
    psi = (
        F.when((F.col("n_reference") == 0) | (F.col("n_current") == 0), F.lit(float("nan")))
        .when(F.col("n_edges") < 2, F.lit(0.0))
        .otherwise(total)
    )
    listed = reference.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    measured = F.coalesce(psi, F.lit(float("nan")))
    return listed.join(sizes, "feature", "left").select(
        "feature",
        measured.alias("psi"),
        drift_state(measured, threshold).alias("state"),
        F.coalesce("n_reference", F.lit(0)).alias("n_reference"),
        F.coalesce("n_current", F.lit(0)).alias("n_current"),
    )
