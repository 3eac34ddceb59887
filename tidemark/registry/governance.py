"""Drift, fairness, model metrics, gates and the model itself."""

from __future__ import annotations

from datetime import timedelta

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.operators import churn, drift, evaluation, explain, fairness, ranking, sketches
from tidemark.operators.quality import quality_gate
from tidemark.plans import jobs, models
from tidemark.registry.core import query
from tidemark.registry.marts import Planned
from tidemark.registry.quality import GATE_SQL, verdicts
from tidemark.session import scratch_path, settle
from tidemark.sources import bronze
from tidemark.sources.adapter import Bronze
from tidemark.sources.bronze import write_partitions

VERSIONS = [1, 2, 3, 4]
RUN_ID = "run-churn"
LINE_FEATURES = ["quantity", "unit_price", "discount_pct", "line_total"]


def number() -> F.Column:
    return F.substring("customer_id", 5, 30).cast("bigint")


def scoring(b: Bronze) -> DataFrame:
    """Feature snapshot with a formula in place of a model's score."""
    p = Planned(b)
    score = (number() * 7919 % 1000) / F.lit(1000.0)
    scored = p.features().withColumn("churn_score", score)
    return churn.with_sensitive(scored, p.dim_customer()).withColumn("churn_pred", evaluation.predicted("churn_score"))


def version_metrics(b: Bronze) -> DataFrame:
    """Metrics of four candidate scores, each leaning more on recency."""
    v = F.col("version")
    score = (F.col("recency_days") * v + number() * 7919 % 1000) / (v * F.lit(365.0) + F.lit(1000.0))
    listed = F.explode(F.array(*[F.lit(i) for i in VERSIONS])).alias("version")
    scored = Planned(b).features().select("customer_id", "recency_days", "churn_label", listed)
    return evaluation.model_metrics(scored.withColumn("churn_score", score), "version")


@query(
    "customer_id:s recency_days:d orders_last_30d:d monetary_365d:d avg_ticket:d tickets_support_90d:d churn_label:i",
    "SELECT * FROM customer_features WHERE churn_label IS NOT NULL",
)
def training_frame(b):
    return churn.training_frame(Planned(b).features())


@query(
    "negatives:i positives:i weight:d",
    """SELECT count(*) - sum(churn_label) AS negatives, sum(churn_label) AS positives,
              (count(*) - sum(churn_label)) / greatest(sum(churn_label), 1) AS weight FROM customer_features""",
)
def class_weight(b):
    return evaluation.class_weight(Planned(b).features())


@query(
    "customer_id:s churn_label:i in_test:i",
    """SELECT customer_id, churn_label,
              CASE WHEN row_number() OVER (PARTITION BY churn_label ORDER BY md5(customer_id || '|42'), customer_id)
                        <= (count(*) OVER (PARTITION BY churn_label) * 40 + 100) // 200 THEN 1 ELSE 0 END AS in_test
       FROM customer_features""",
)
def stratified_split(b):
    frame = settle(Planned(b).features().select("customer_id", "churn_label"), "labels")
    return ranking.stratified_split(frame, "customer_id", "churn_label")


@query(
    "customer_id:s churn_label:i",
    """SELECT f.customer_id, f.churn_label FROM customer_features f JOIN b_customers c ON c.customer_id = f.customer_id
       WHERE (c.n * 7919) % 1000 < 100""",
)
def hash_sample(b):
    return ranking.hash_sample(Planned(b).features(), number(), 100)


@query(
    "version:i positives:i negatives:i roc_auc:d pr_auc:d brier:d",
    """SELECT version, positives, negatives, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc, round(brier, 6) AS brier
       FROM version_metrics""",
)
def model_metrics(b):
    rounded = [F.round(c, 6).alias(c) for c in ("roc_auc", "pr_auc", "brier")]
    return version_metrics(b).select("version", "positives", "negatives", *rounded)


@query(
    "candidate_version:i run_id:s roc_auc:d min_roc_auc:d promoted:i production_version:i",
    """SELECT version AS candidate_version, 'run-' || CAST(version AS VARCHAR) AS run_id, round(roc_auc, 6) AS roc_auc,
              0.72 AS min_roc_auc, roc_auc >= 0.72 AS promoted, CASE WHEN roc_auc >= 0.72 THEN version ELSE 1 END AS production_version
       FROM version_metrics ORDER BY version DESC LIMIT 1""",
)
def promotion_gate(b):
    """The newest of four measured versions; version 1 serves."""
    versions = version_metrics(b).select(
        "version",
        F.concat(F.lit("run-"), F.col("version").cast("string")).alias("run_id"),
        "roc_auc",
        F.when(F.col("version") == 1, "Production").otherwise("Staging").alias("stage"),
    )
    return evaluation.promotion_gate(versions).withColumn("roc_auc", F.round("roc_auc", 6))


SCORING = (
    "customer_id:s recency_days:i orders_last_30d:i monetary_365d:d avg_ticket:d tickets_support_90d:i gender:s age_band:s "
    "churn_score:d churn_pred:i scoring_dt:s"
)


@query(
    SCORING,
    """SELECT *, DATE '2001-08-02' AS scoring_dt FROM scoring
       UNION ALL SELECT *, DATE '2001-08-01' FROM scoring""",
)
def scoring_partition(b):
    """Two scoring days; the second is written twice and replaced, the first stays."""
    path = scratch_path(b.spark, "scoring")
    base = scoring(b).select("customer_id", *churn.FEATURES, "gender", "age_band", "churn_score", "churn_pred")
    yesterday = b.as_of - timedelta(days=1)
    bronze.write_partitions(base.withColumn("scoring_dt", F.lit(yesterday)), path, "scoring_dt")
    today = base.withColumn("scoring_dt", F.lit(b.as_of))
    bronze.write_partitions(today.withColumn("churn_pred", 1 - F.col("churn_pred")), path, "scoring_dt")
    bronze.write_partitions(today, path, "scoring_dt")
    return b.spark.read.parquet(path)


@query(
    "rows:i positives:i mean_score:d p95_score:d",
    """SELECT count(*) AS rows, sum(churn_pred) AS positives, round(avg(churn_score), 6) AS mean_score,
              round(quantile_cont(churn_score, 0.95), 6) AS p95_score FROM scoring""",
)
def scoring_summary(b):
    return evaluation.scoring_summary(scoring(b))


@query(
    "attribute:s group:s n:i positives:i rate:d",
    """SELECT attribute, grp AS "group", n, positives, rate FROM bias_groups""",
)
def bias_groups(b):
    return fairness.bias_groups(scoring(b), churn.SENSITIVE)


@query(
    "attribute:s lowest_group:s highest_group:s metric:s value:d severity:s",
    """WITH m AS (
         SELECT attribute, min(rate) AS lo, max(rate) AS hi FROM bias_groups GROUP BY attribute),
       f AS (
         SELECT attribute, 'demographic_parity' AS metric, hi - lo AS v FROM m
         UNION ALL SELECT attribute, 'disparate_impact', CASE WHEN hi = 0 THEN 1.0 ELSE lo / hi END FROM m)
       SELECT f.attribute, f.metric, round(v, 4) AS value,
              (SELECT min(grp) FROM bias_groups g JOIN m ON m.attribute = g.attribute WHERE g.attribute = f.attribute AND g.rate = m.lo) AS lowest_group,
              (SELECT min(grp) FROM bias_groups g JOIN m ON m.attribute = g.attribute WHERE g.attribute = f.attribute AND g.rate = m.hi) AS highest_group,
              CASE WHEN metric = 'demographic_parity'
                   THEN CASE WHEN v <= 0.05 THEN 'baja' WHEN v <= 0.10 THEN 'media' ELSE 'alta' END
                   ELSE CASE WHEN v >= 0.80 THEN 'baja' WHEN v >= 0.70 THEN 'media' ELSE 'alta' END END AS severity
       FROM f""",
)
def bias_metrics(b):
    return fairness.bias_metrics(fairness.bias_groups(scoring(b), churn.SENSITIVE))


def psi(b: Bronze) -> DataFrame:
    return drift.psi_report(*Planned(b).two_snapshots(days_ago=30), churn.FEATURES)


@query(
    "feature:s psi:d state:s n_reference:i n_current:i",
    """SELECT feature, round(psi, 6) AS psi,
              CASE WHEN psi < 0.1 THEN 'estable' WHEN psi <= 0.2 THEN 'vigilar' ELSE 'congelar' END AS state, n_reference, n_current
       FROM psi_values""",
)
def psi_features(b):
    return psi(b).withColumn("psi", F.round("psi", 6))


STATE = "CASE WHEN psi < 0.1 THEN 'estable' WHEN psi <= 0.2 THEN 'vigilar' ELSE 'congelar' END AS state"


@query(
    "feature:s psi:d state:s n_reference:i n_current:i",
    f"SELECT feature, round(psi, 6) AS psi, {STATE}, n_reference, n_current FROM psi_observed_values",
)
def psi_features_sketched(b):
    """Drift of two feature snapshots from their stored sketches; the twin is exact, as sketches of few values are."""
    snapshots = DataFrame.unionByName(*Planned(b).two_snapshots(days_ago=30))
    path = scratch_path(b.spark, "feature-sketches")
    write_partitions(sketches.day_sketches(snapshots, churn.FEATURES, "report_date"), path, "report_date")
    stored, then = b.spark.read.parquet(path), b.as_of - timedelta(days=30)
    windows = [sketches.window_sketches(stored, "report_date", day, day) for day in (then, b.as_of)]
    return sketches.psi_sketched(*windows).withColumn("psi", F.round("psi", 6))


@query(
    "feature:s psi:d state:s n_reference:i n_current:i",
    f"SELECT feature, round(psi, 6) AS psi, {STATE}, n_reference, n_current FROM line_values",
)
def psi_lines_sketched(b):
    """Drift of the order lines of the last 30 days against the 60 before, merged from sketches of single days."""
    days = sketches.day_sketches(Planned(b).sales(), LINE_FEATURES, "order_date")
    path = scratch_path(b.spark, "line-sketches")
    days.repartitionByRange("order_date").sortWithinPartitions("order_date").write.parquet(path)
    stored = b.spark.read.parquet(path)
    ago = lambda n: b.as_of - timedelta(days=n)
    windows = [sketches.window_sketches(stored, "order_date", *days) for days in ((ago(89), ago(30)), (ago(29), b.as_of))]
    return sketches.psi_sketched(*windows).withColumn("psi", F.round("psi", 6))


@query(
    "scope:s status:s tests_total:i tests_failed:i drift_psi:d",
    f"""SELECT 'model' AS scope, CASE WHEN g.tests_failed > 0 OR d.worst > 0.2 THEN 'rechazado' ELSE 'aprobado' END AS status,
               g.tests_total, g.tests_failed, round(d.worst, 4) AS drift_psi
        FROM ({GATE_SQL}) g, (SELECT max(psi) AS worst FROM psi_values) d""",
)
def model_gate(b):
    return evaluation.model_gate(quality_gate(verdicts(b)), psi(b))


def model_home(b: Bronze) -> str:
    """Fits the primary model and puts it in production; its folder, with the scored test rows in `scored`."""
    home = scratch_path(b.spark, "models")
    run = jobs.train_churn(Planned(b).features(), churn.PRIMARY)
    churn.score(run.model, run.test).write.parquet(f"{home}/scored")
    models.register(b.spark, home, run.model, RUN_ID, run.metrics.first().roc_auc)
    models.promote(b.spark, home, RUN_ID)
    return home


def scored_test(b: Bronze, home: str) -> DataFrame:
    return b.spark.read.parquet(f"{home}/scored")


TEST_ROWS = """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY churn_label ORDER BY md5(customer_id || '|42'), customer_id)
                     <= (count(*) OVER (PARTITION BY churn_label) * 40 + 100) // 200 AS in_test FROM customer_features) WHERE in_test)"""


@query(
    "part:s positives:i negatives:i recomputed:i in_range:i production_version:i",
    f"""SELECT 'test' AS part, count(*) FILTER (WHERE churn_label = 1) AS positives,
               count(*) FILTER (WHERE churn_label = 0) AS negatives, 1 AS recomputed, 1 AS in_range, 1 AS production_version
        FROM {TEST_ROWS}""",
)
def churn_train(b):
    """The primary model's metrics on held-out rows: counts, and whether Spark's own evaluator, from the
    stored scores, gives the same area."""
    home = model_home(b)
    scored = scored_test(b, home)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="churn_score", labelCol=churn.LABEL)
    other = evaluator.evaluate(scored)
    metrics = evaluation.model_metrics(scored.withColumn("part", F.lit("test")), "part")
    ranges = [F.col(c).between(0, 1) for c in ("roc_auc", "pr_auc", "brier")]
    return metrics.select(
        "part", "positives", "negatives",
        (F.abs(F.col("roc_auc") - other) < 1e-9).cast("int").alias("recomputed"),
        (ranges[0] & ranges[1] & ranges[2]).cast("int").alias("in_range"),
        F.lit(models.load(b.spark, home).version).alias("production_version"),
    )


@query(
    "customer_id:s gender:s age_band:s score_ok:i label_ok:i",
    "SELECT customer_id, gender, age_band, 1 AS score_ok, 1 AS label_ok FROM scoring",
)
def batch_scoring(b):
    """Every customer of the snapshot scored by the model in production."""
    p = Planned(b)
    stored = models.load(b.spark, model_home(b))
    base = churn.with_sensitive(p.features().select("customer_id", *churn.FEATURES), p.dim_customer())
    scored = models.score(stored, base)
    label = (F.col("churn_score") >= 0.5).cast("int")
    return scored.select(
        "customer_id", "gender", "age_band",
        F.coalesce(F.col("churn_score").between(0, 1), F.lit(False)).alias("score_ok"),
        (F.col("churn_pred") == label).alias("label_ok"),
    )


@query(
    "feature:s mean:d in_range:i sums_to_one:i",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg(CAST({c} AS DOUBLE)), 6) AS mean, 1 AS in_range, 1 AS sums_to_one FROM {TEST_ROWS}"
        for c in churn.FEATURES
    ),
)
def feature_importance(b):
    home = model_home(b)
    found = churn.feature_importance(models.load(b.spark, home).model, scored_test(b, home))
    total = F.sum("importance").over(Window.partitionBy(F.lit(1)))  # one row per feature
    return found.select(
        "feature", F.round("mean", 6).alias("mean"), F.col("importance").between(0, 1).alias("in_range"),
        (F.abs(total - 1) < 1e-9).alias("sums_to_one"),
    )


@query(
    "customer_id:s rank:i known:i value_ok:i ordered:i margin_ok:i",
    "SELECT customer_id, unnest([1, 2, 3]) AS rank, 1 AS known, 1 AS value_ok, 1 AS ordered, 1 AS margin_ok FROM customer_features",
)
def churn_factors(b):
    """Three factors of every customer's score. The flags hold each row against another source: the factor's value
    against the customer's features, the sum of all attributions against the model's own margin."""
    stored = models.load(b.spark, model_home(b))
    frame = settle(Planned(b).features().select("customer_id", *churn.FEATURES), "explained")
    trees = explain.load_trees(b.spark, stored.path)
    found = explain.churn_factors(frame, trees)
    margins = stored.model.transform(frame).select("customer_id", vector_to_array("rawPrediction").getItem(1).alias("own"))
    values = frame.select(F.col("customer_id").alias("_id"), F.create_map(*[x for c in churn.FEATURES for x in (F.lit(c), F.col(c).cast("double"))]).alias("of"))
    joined = found.join(margins, "customer_id").join(values, F.col("customer_id") == F.col("_id"))
    before = F.lag(F.abs("attribution")).over(Window.partitionBy("customer_id").orderBy("rank"))  # three rows each
    return joined.select(
        "customer_id", "rank", F.col("feature").isin(*churn.FEATURES).alias("known"),
        F.col("value").eqNullSafe(F.col("of")[F.col("feature")]).alias("value_ok"),
        F.coalesce(before >= F.abs("attribution"), F.lit(True)).alias("ordered"),
        (F.abs(F.col("margin") - F.col("own")) < 1e-9).alias("margin_ok"),
    )
