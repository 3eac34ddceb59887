import pytest
from pyspark.sql import functions as F

from tidemark.operators import churn
from tidemark.plans import models

TINY = churn.Boosting(2, 2, 0.1)


@pytest.fixture(scope="module")
def frame(spark):
    columns = [(F.col("id") * (i + 3) % 17).cast("double").alias(c) for i, c in enumerate(churn.FEATURES)]
    return spark.range(200).select(F.col("id").cast("string").alias("customer_id"), *columns, (F.col("id") % 3 == 0).cast("int").alias(churn.LABEL))


@pytest.fixture(scope="module")
def fitted(frame):
    return churn.train(frame, 2.0, params=TINY)


def test_versions_are_promoted_by_the_gate_and_loaded_by_stage(spark, tmp_path, frame, fitted):
    home = str(tmp_path / "models")
    with pytest.raises(LookupError):
        models.load(spark, home)
    assert models.register(spark, home, fitted, "r1", 0.80) == 1
    assert models.load(spark, home, models.STAGING).version == 1
    assert models.promote(spark, home).promoted == 1
    assert models.register(spark, home, fitted, "r2", 0.60) == 2
    assert models.promote(spark, home).promoted == 0  # below the least area: version 1 stays
    assert models.load(spark, home).version == 1
    assert models.register(spark, home, fitted, "r3", 0.90) == 3
    assert models.promote(spark, home, run_id="other").promoted == 0
    assert models.promote(spark, home, run_id="r3").production_version == 3
    stages = {r.version: r.stage for r in models.versions(spark, home).collect()}
    assert stages == {1: models.ARCHIVED, 2: models.STAGING, 3: models.PRODUCTION}


def test_a_loaded_model_scores_like_the_fitted_one(spark, tmp_path, frame, fitted):
    home = str(tmp_path / "models")
    models.register(spark, home, fitted, "r", 0.9)
    stored = models.load(spark, home, models.STAGING)
    assert stored.features == churn.FEATURES
    want = {r.customer_id: r.churn_score for r in churn.score(fitted, frame).collect()}
    assert {r.customer_id: r.churn_score for r in models.score(stored, frame).collect()} == want
    with pytest.raises(ValueError):
        models.score(stored, frame.drop(churn.FEATURES[0]))
