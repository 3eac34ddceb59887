from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import churn
from tidemark.operators.staging import STAGING
from tidemark.plans import jobs
from tidemark.registry.marts import Planned
from tidemark.session import checkpoint_root
from tidemark.sources.adapter import AS_OF, Bronze
from tidemark.sources.files import Files

SF = "/root/testdata/sf0.001"
START = date(1995, 1, 1)
FAILED = "fct_orders_pk_unica"
TINY = churn.Boosting(3, 2, 0.1, 0.9)


@pytest.fixture(scope="module")
def stored(spark):
    b = Bronze(spark, SF)
    spark.sql("CREATE DATABASE IF NOT EXISTS gold")
    # Line numbers repeat in the benchmark data, so its order_item_id is no key to dedup by.
    frames = jobs.store_marts(jobs.build_marts({n: b.entity(n) for n in STAGING}, AS_OF, START, dedup=False), "gold")
    return frames, jobs.quality.quality_gate(jobs.check_marts(frames, AS_OF))


def test_transform_stores_every_mart_and_gates(spark, stored):
    frames, gate = stored
    counts = {name: df.count() for name, df in frames.items()}
    assert counts["fct_orders"] == 6000 and counts["customer_features"] == 94 and counts["dim_customer"] == 300
    assert frames["customer_features"].agg(F.sum("churn_label")).first()[0] == 35
    g = gate.first()
    assert (g.status, g.tests_total) == ("rechazado", 62)  # repeated (order, product) pairs
    assert "order_month=" in frames["fct_orders"].inputFiles()[0]


def test_a_red_gate_publishes_nothing_and_a_green_one_keeps_snapshots(spark, tmp_path):
    b, home = Bronze(spark, SF), str(tmp_path)
    spark.sql("CREATE DATABASE IF NOT EXISTS gated")
    entities = {n: b.entity(n) for n in STAGING}
    with pytest.raises(jobs.GateRejected):
        jobs.transform(entities, AS_OF, START, home, "r1", "gated", dedup=False)
    assert not spark.catalog.tableExists("gated.fct_orders")
    gates = spark.read.parquet(f"{home}/quality_gates")
    assert [(r.run_id, r.status) for r in gates.collect()] == [("r1", "rechazado")]
    assert gates.first().tests_total == 62 + 46
    repeated = spark.read.parquet(f"{home}/failures/run_id=r1/marts.fct_orders/{FAILED}")
    assert repeated.columns == ["order_id", "product_id", "copies"] and repeated.count() > 0

    entities["order_items"] = entities["order_items"].dropDuplicates(["order_id", "product_id"])
    for run, day in (("r2", AS_OF), ("r3", AS_OF + timedelta(days=1))):
        live, gate = jobs.transform(entities, day, START, home, run, "gated", dedup=False)
        assert gate.first().status == "aprobado"
    assert live["fct_orders"].count() == entities["order_items"].count()
    days = {r.report_date for r in live["customer_features"].select("report_date").distinct().collect()}
    assert days == {AS_OF, AS_OF + timedelta(days=1)}
    assert spark.read.parquet(f"{home}/quality_gates").count() == 3
    root = f"{checkpoint_root(spark)}/tidemark/{spark.sparkContext.applicationId}"
    assert not [n for n in Files(spark, root).names(root) if n.startswith(("verdicts", "touched"))]


def test_dedup_takes_the_last_extract_of_each_key(spark, rows):
    b = Bronze(spark, SF)
    entities = {n: b.entity(n) for n in STAGING}
    again = entities["orders"].withColumn("status", F.lit("refunded")).withColumn("dt", F.date_add("dt", 3))
    entities["orders"] = entities["orders"].unionByName(again)
    keyed = entities["order_items"].dropDuplicates(["order_item_id"])
    entities["order_items"] = keyed.unionByName(keyed.withColumn("dt", F.date_add("dt", 1)))
    fact = jobs.build_marts(entities, AS_OF, START).fct_orders
    assert fact.count() == keyed.count()
    assert rows(fact.select("status").distinct()) == [("refunded",)]


def test_missing_table_fails_its_contract(spark, stored):
    spark.sql("CREATE DATABASE IF NOT EXISTS nothing")
    got = [(r.table, r.type, r.ok) for r in jobs.check_stored(spark, AS_OF, "nothing").collect()]
    assert len(got) == 3 and all(kind == "existe" and not ok for _, kind, ok in got)
    assert jobs.check_stored(spark, AS_OF, "gold").count() == 62


def test_views(spark, stored):
    b = Bronze(spark, SF)
    jobs.register_views({"stg_sellers_view": STAGING["sellers"](b.sellers())})
    assert spark.sql("SELECT count(*) AS n FROM stg_sellers_view").first().n == b.sellers().count()


def test_train_and_score(spark, stored, tmp_path):
    frames, _ = stored
    run = jobs.train_churn(frames["customer_features"], TINY)
    m = run.metrics.first()
    assert m.positives + m.negatives == 19 and 0.5 <= m.roc_auc <= 1
    for _ in range(2):  # a second run replaces the partition
        summary = jobs.score_partition(run.model, frames["customer_features"], frames["dim_customer"], str(tmp_path), AS_OF).first()
        assert summary["rows"] == 94
    columns = spark.read.parquet(f"{tmp_path}/silver/scoring").columns
    assert {"customer_id", *churn.FEATURES, *churn.SENSITIVE, "churn_score", "churn_pred", "scoring_dt"} == set(columns)
    weights = churn.feature_importance(run.model, run.test).agg(F.sum("importance")).first()[0]
    assert weights == pytest.approx(1.0)
    with pytest.raises(ValueError):
        churn.score(run.model, run.test.withColumn("avg_ticket", F.lit("x")))
    with pytest.raises(ValueError):
        jobs.train_churn(frames["customer_features"].limit(0), TINY)


def test_incremental_fact_equals_a_rebuild(spark, tmp_path, rows):
    p = Planned(Bronze(spark, SF))
    path, cutoff = str(tmp_path / "fact"), date(2001, 6, 1)

    def build(last):
        def upto(since):
            month = F.date_format("order_date", "yyyy-MM").alias("month")
            return p.fct_orders(since, last=last).select("order_id", "product_id", "order_date", "line_total", month)

        return upto

    steps = [jobs.refresh_fact(spark, path, build(day), ["order_id"], "month", "order_date") for day in (cutoff, AS_OF, AS_OF)]
    assert steps[0] is None and steps[1] <= cutoff < steps[2]
    columns = ["order_id", "product_id", "order_date", "line_total", "month"]
    assert rows(spark.read.parquet(path), *columns) == rows(build(AS_OF)(None), *columns)


def source(spark, *table):
    return spark.createDataFrame(list(table), "k int, v string, updated_at timestamp")


def test_ingest_is_repeatable_and_audited(spark, tmp_path, rows):
    lake = str(tmp_path)
    day, t0 = date(2024, 1, 2), datetime(1970, 1, 1)
    noon, eve = datetime(2024, 1, 2, 12), datetime(2024, 1, 2, 18)
    first = source(spark, (1, "a", noon), (2, "b", noon), (3, "late", datetime(2024, 1, 3)))
    jobs.ingest(first, "things", lake, "r1", day, t0, noon)

    def bronze_rows():
        return rows(spark.read.schema("k int, v string, updated_at timestamp, dt date").parquet(f"{lake}/bronze/things"), "k", "v", "dt")

    def audit():
        return rows(spark.read.schema("run_id string, entity string, dt date, rows_read bigint, watermark timestamp, checksum string").parquet(f"{lake}/meta/ingest_audit"), "run_id", "rows_read", "watermark")

    assert bronze_rows() == [(1, "a", day), (2, "b", day)]
    again = source(spark, (1, "a", noon), (2, "B", eve))
    jobs.ingest(again, "things", lake, "r1", day, t0, eve)
    assert bronze_rows() == [(1, "a", day), (2, "B", day)]
    assert audit() == [("r1", 2, eve)]
    jobs.ingest(source(spark, (4, "d", datetime(2024, 1, 3, 1))), "things", lake, "r2", date(2024, 1, 3), eve, datetime(2024, 1, 3, 2))
    assert len(bronze_rows()) == 3 and len(audit()) == 2
    jobs.ingest(source(spark, (1, "a", noon)), "things", lake, "r1", day, noon, eve)
    assert bronze_rows() == [(4, "d", date(2024, 1, 3))]  # an empty window empties its day only


def test_a_refresh_computes_its_batch_once(spark, tmp_path, rows, monkeypatch):
    """The upsert reads a later batch several times; it gets a settled one, which is deleted afterwards."""
    given, real, path = [], jobs.tables.upsert, str(tmp_path / "once")

    def seen(batch, *rest, **more):
        given.append(batch.inputFiles())
        real(batch, *rest, **more)

    monkeypatch.setattr(jobs.tables, "upsert", seen)
    days = [date(2024, 1, 30), date(2024, 1, 31), date(2024, 2, 1), None]
    table = [(i % 40 or None, f"v{i}", days[i % 4]) for i in range(80)]

    def build(since):
        df = spark.createDataFrame(table, "k int, v string, day date").withColumn("month", F.date_format("day", "yyyy-MM"))
        return df if since is None else df.where(F.col("day") >= F.lit(since))

    steps = [jobs.refresh_fact(spark, path, build, ["k"], "month", "day", rounds=2) for _ in range(2)]
    assert steps == [None, date(2024, 2, 1)]
    assert not given[0] and given[1] and not any(Files(spark, f).exists(f) for f in given[1])
    assert rows(spark.read.parquet(path), "k", "v", "day", "month") == rows(build(None), "k", "v", "day", "month")
