"""Attributions along tree paths against the model's margin and against a walk node by node."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.operators import churn, explain


@pytest.fixture(scope="module")
def frame(spark):
    columns = [(F.col("id") * (i + 3) % (17 + i)).cast("double").alias(c) for i, c in enumerate(churn.FEATURES)]
    label = ((F.col("id") * 3 % 17 > 8) != (F.col("id") % 5 == 0)).cast("int")
    return spark.range(400).select(F.col("id").cast("string").alias("customer_id"), *columns, label.alias(churn.LABEL)).cache()


@pytest.fixture(scope="module")
def fitted(frame, tmp_path_factory):
    model = churn.train(frame, 2.0, params=churn.Boosting(6, 3, 0.3, 0.9))
    path = str(tmp_path_factory.mktemp("model") / "m")
    model.save(path)
    return model, path


def test_sums_are_the_models_margin(spark, frame, fitted):
    model, path = fitted
    trees = explain.load_trees(spark, path)
    own = {r.customer_id: r.own for r in model.transform(frame).select("customer_id", vector_to_array("rawPrediction")[1].alias("own")).collect()}
    told = explain.attributions(frame, trees).collect()
    assert len(told) == len(own) and len(set(own.values())) > 5
    for r in told:
        assert abs(r.margin - own[r.customer_id]) < 1e-9
        assert abs(sum(r.attributions) + trees.base - r.margin) < 1e-9


def test_equals_a_walk_node_by_node(spark, frame, fitted):
    model, path = fitted
    trees = explain.load_trees(spark, path)
    stage = model.stages[-1]
    rows = frame.limit(60).collect()
    want = np.zeros((len(rows), len(churn.FEATURES)))
    for weight, tree in zip(stage.treeWeights, stage.trees):
        for i, r in enumerate(rows):
            node = tree._java_obj.rootNode()
            while node.getClass().getSimpleName() == "InternalNode":
                f = node.split().featureIndex()
                x = r[churn.FEATURES[f]]
                child = node.leftChild() if x is not None and x <= node.split().threshold() else node.rightChild()
                want[i, f] += weight * (child.prediction() - node.prediction())
                node = child
    x = np.array([[np.nan if r[c] is None else r[c] for c in churn.FEATURES] for r in rows])
    assert np.allclose(trees.attribute(x), want, atol=1e-12)


def test_a_feature_that_no_tree_splits_on_has_no_share():
    # One tree: x1 <= 1 ? -2 : (x0 <= 5 ? 1 : 4), root value 1, inner value 2.
    trees = explain.Trees(np.array([0]), np.array([1, -1, 0, -1, -1]), np.array([1.0, 0, 5.0, 0, 0]), np.array([1, -1, 3, -1, -1]),
                          np.array([2, -1, 4, -1, -1]), np.array([1.0, -2.0, 2.0, 1.0, 4.0]))
    found = trees.attribute(np.array([[9.0, 0.0, 3.0], [9.0, 2.0, 3.0], [5.0, np.nan, 3.0]]))
    assert found.tolist() == [[0.0, -3.0, 0.0], [2.0, 1.0, 0.0], [-1.0, 1.0, 0.0]]
    assert trees.base == 1.0


def test_three_factors_a_customer(spark, frame, fitted):
    trees = explain.load_trees(spark, fitted[1])
    rows = explain.churn_factors(frame, trees).collect()
    by = {}
    for r in rows:
        by.setdefault(r.customer_id, []).append(r)
    all_of = {r.customer_id: dict(zip(churn.FEATURES, r.attributions)) for r in explain.attributions(frame, trees).collect()}
    assert len(by) == 400 and all(len(v) == 3 for v in by.values())
    for customer, factors in by.items():
        factors.sort(key=lambda r: r["rank"])
        order = sorted(churn.FEATURES, key=lambda c: (-abs(all_of[customer][c]), churn.FEATURES.index(c)))
        assert [f.feature for f in factors] == order[:3]
    assert explain.churn_factors(frame.limit(0), trees).count() == 0
