"""Why a customer got a score: additive attributions along the paths of the boosted trees.

A tree's node has a value, that of the training rows in it. Walking from the root to a row's leaf, each
step changes the value by an amount that belongs to the feature of the split; summed over trees and
their weights, these amounts and the roots' values are the model's margin. Trees come from the stored
model as a table of nodes whose size the model's parameters bound; rows are walked in batches, all rows of
a batch through a level of a tree at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.churn import FEATURES, check_signature
from tidemark.sources.files import Files

FACTORS = 3


@dataclass(frozen=True)
class Trees:
    """Nodes of all trees in a row: split feature (-1 for a leaf), threshold, children, value times the tree's weight."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    @property
    def base(self) -> float:
        return float(self.value[self.roots].sum())

    def attribute(self, x: np.ndarray) -> np.ndarray:
        """(rows, features) attributions of a matrix of feature values; a value that is not at most the threshold, NaN too, goes right."""
        total, rows = np.zeros(x.shape), np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            live = rows
            while len(live := live[self.feature[at[live]] >= 0]):
                node = at[live]
                f = self.feature[node]
                at[live] = np.where(x[live, f] <= self.threshold[node], self.left[node], self.right[node])
                total[live, f] += self.value[at[live]] - self.value[node]
        return total


def load_trees(spark: SparkSession, path: str) -> Trees:
    """The trees of a pipeline stored at `path` whose last stage is boosted trees with splits on numbers."""
    stages = Files(spark, path).names(f"{path}/stages")
    last = f"{path}/stages/{max(stages, key=lambda n: int(n.split('_')[0]))}"
    weights = {r._1: r._3 for r in spark.read.parquet(f"{last}/treesMetadata").collect()}
    nodes = spark.read.parquet(f"{last}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
    place = {(n.treeID, n.id): i for i, n in enumerate(nodes)}
    if any(n.split.featureIndex >= 0 and n.split.numCategories >= 0 for n in nodes):
        raise ValueError("splits on categories are not explained")
    leaf = [n.leftChild < 0 for n in nodes]
    return Trees(
        np.array([place[t, 0] for t in sorted(weights)], np.int64),
        np.array([-1 if end else n.split.featureIndex for n, end in zip(nodes, leaf)], np.int64),
        np.array([0.0 if end else n.split.leftCategoriesOrThreshold[0] for n, end in zip(nodes, leaf)]),
        np.array([-1 if end else place[n.treeID, n.leftChild] for n, end in zip(nodes, leaf)], np.int64),
        np.array([-1 if end else place[n.treeID, n.rightChild] for n, end in zip(nodes, leaf)], np.int64),
        np.array([n.prediction * weights[n.treeID] for n in nodes]),
    )


def _walk(trees: Trees, names: list[str], columns: list[str]):
    def run(batches):
        for batch in batches:
            x = np.column_stack([batch.column(c).cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False) for c in columns])
            found = trees.attribute(x) if len(x) else np.empty((0, len(columns)))
            cuts = pa.array(np.arange(len(x) + 1) * len(columns), pa.int32())
            lists = pa.ListArray.from_arrays(cuts, pa.array(found.ravel()))
            margin = pa.array(found.sum(1) + trees.base)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], lists, margin], [*names, "attributions", "margin"])

    return run


def attributions(frame: DataFrame, trees: Trees, columns: Sequence[str] = FEATURES) -> DataFrame:
    """`frame` with attributions (an array in the order of `columns`) and margin, their sum with the base value."""
    check_signature(frame, columns)
    schema = ", ".join([f"`{n}` {t}" for n, t in frame.dtypes] + ["attributions array<double>", "margin double"])
    return frame.mapInArrow(_walk(trees, frame.columns, list(columns)), schema)


def churn_factors(frame: DataFrame, trees: Trees, key: str = "customer_id", columns: Sequence[str] = FEATURES, factors: int = FACTORS) -> DataFrame:
    """key, rank, feature, value, attribution, margin, base: the features that move a customer's score most, either way.

    Ties go to the feature named first. A customer has at most as many factors as there are features.
    """
    cells = [
        F.struct((-F.abs(F.get("attributions", F.lit(i)))).alias("size"), F.lit(i).alias("no"), F.lit(c).alias("feature"),
                 F.col(c).cast("double").alias("value"), F.get("attributions", F.lit(i)).alias("attribution"))
        for i, c in enumerate(columns)
    ]
    told = attributions(frame.select(key, *columns), trees, columns)
    first = F.slice(F.array_sort(F.array(*cells)), 1, factors)
    spread = told.select(key, "margin", F.posexplode(first).alias("place", "f"))
    return spread.select(key, (F.col("place") + 1).alias("rank"), "f.feature", "f.value", "f.attribution", "margin", F.lit(trees.base).alias("base"))
