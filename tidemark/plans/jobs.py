"""Batch jobs: ingest one entity, rebuild the marts, train and score. These run actions in order."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime
from functools import partial, reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import contracts
from tidemark.operators import churn, evaluation, merge, quality
from tidemark.operators.ranking import stratified_split
from tidemark.plans import marts
from tidemark.schemas import KEYS
from tidemark.session import scratch_scope, settle
from tidemark.sources import bronze, tables
from tidemark.sources.files import Files


class GateRejected(RuntimeError):
    """A critical check failed; nothing later in the job has run."""


def ingest(
    source: DataFrame, entity: str, lake: str, run_id: str, dt: date, after: datetime | date, until: datetime | date
) -> DataFrame:
    """Window scan, partition write, count check, then the audit row that moves the watermark.

    Returns the audit row. Raises before auditing when the counts differ, so the window is read
    again by the next run. Rerunning a day replaces its partition and its audit row.
    """
    spark = source.sparkSession
    path = f"{lake}/bronze/{entity}"
    window = bronze.extract_window(source, after, until).drop("dt").withColumn("dt", F.lit(dt))
    Files(spark, path).make(path)
    bronze.write_partitions(window, path)
    if window.isEmpty():
        Files(spark, path).delete(f"{path}/dt={dt}")  # an empty window replaces what the day held
    landed = spark.read.schema(window.schema).parquet(path).where(F.col("dt") == F.lit(dt))
    differing = quality.reconcile_counts(window, landed, ["dt"])
    bad = differing.first()
    if bad is not None:
        raise GateRejected(f"{entity} dt={dt}: source {bad.source_rows} rows, bronze {bad.target_rows}")
    audit = bronze.content_checksum(landed, "dt").select(
        F.lit(run_id).alias("run_id"),
        F.lit(entity).alias("entity"),
        "dt",
        F.col("rows").alias("rows_read"),
        F.lit(until).cast("timestamp").alias("watermark"),
        F.col("checksum").cast("string").alias("checksum"),
    )
    upsert = partial(merge.delete_insert, keys=bronze.AUDIT_KEYS)
    tables.upsert(audit, f"{lake}/meta/ingest_audit", bronze.AUDIT_KEYS, "dt", upsert)
    return audit


@dataclass
class Marts:
    """Lazily planned marts of one run; each is a DataFrame."""

    dim_date: DataFrame
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_seller: DataFrame
    fct_orders: DataFrame
    fct_payments: DataFrame
    tickets: DataFrame
    as_of: date

    def customer_features(self, fact: DataFrame | None = None) -> DataFrame:
        """Features from `fact`; give the stored fact so that its joins do not run again."""
        return marts.customer_features(self.fct_orders if fact is None else fact, self.tickets, self.as_of)


def build_marts(
    entities: dict[str, DataFrame], as_of: date, start: date, categories: DataFrame | None = None, dedup: bool = True
) -> Marts:
    """Plans every mart from Bronze entities.

    `dedup` first keeps the latest version of each business key, as an entity extracted on several
    days has several; leave it off for a source that holds every row once.
    """
    spark = next(iter(entities.values())).sparkSession
    if dedup:
        entities = {name: merge.dedup_latest(df, KEYS[name]) for name, df in entities.items()}
    s = marts.silver(entities)
    calendar = marts.dim_date(spark, as_of, start)
    lookup = marts.category_map(spark) if categories is None else categories
    return Marts(
        calendar,
        marts.dim_customer(s["customers"], s["orders"]),
        marts.dim_product(s["products"], s["orders"], s["order_items"], lookup),
        marts.dim_seller(s["sellers"], s["products"], as_of),
        marts.fct_orders(s["orders"], s["order_items"], s["products"], calendar),
        marts.fct_payments(s["payments"], s["orders"], calendar),
        s["support_tickets"],
        as_of,
    )


# Sort columns of each stored mart; the facts are also partitioned by month.
LAYOUT = {
    "dim_date": ["date_key"],
    "dim_customer": ["customer_id", "valid_from"],
    "dim_product": ["product_id"],
    "dim_seller": ["seller_id"],
    "fct_orders": ["order_date", "customer_id"],
    "fct_payments": ["paid_date", "customer_id"],
    "customer_features": ["customer_id"],
}
PARTITIONS = {"fct_orders": ["order_month"], "fct_payments": ["paid_month"], "customer_features": ["report_date"]}


CANDIDATE = "candidate_"


def store_marts(planned: Marts, database: str = "default", prefix: str = "") -> dict[str, DataFrame]:
    """Rebuild of all marts as tables; returns the stored tables.

    Of `customer_features` only the snapshot's own `report_date` is replaced, earlier ones stay.
    """
    stored = {}
    for name, sort_by in LAYOUT.items():
        if name == "customer_features":
            df = planned.customer_features(stored["fct_orders"])
        else:
            df = getattr(planned, name)
        if name == "fct_orders":
            df = df.withColumn("order_month", F.date_format("order_date", "yyyy-MM"))
        if name == "fct_payments":
            df = df.withColumn("paid_month", F.date_format("paid_date", "yyyy-MM"))
        table = f"{database}.{prefix}{name}"
        tables.materialise(df, table, sort_by, PARTITIONS.get(name, ()), keep_others=name == "customer_features")
        stored[name] = df.sparkSession.table(table)
        if name == "customer_features":
            stored[name] = stored[name].where(F.col("report_date") == F.lit(planned.as_of))
    return stored


def publish(spark: SparkSession, database: str = "default") -> dict[str, DataFrame]:
    """Copies checked candidate tables over the live ones; earlier feature snapshots stay."""
    live = {}
    for name, sort_by in LAYOUT.items():
        df, table = spark.table(f"{database}.{CANDIDATE}{name}"), f"{database}.{name}"
        tables.materialise(df, table, sort_by, PARTITIONS.get(name, ()), keep_others=name == "customer_features")
        live[name] = spark.table(table)
    return live


def refresh_fact(
    spark: SparkSession,
    path: str,
    build: Callable[[date | None], DataFrame],
    keys: list[str],
    partition: str,
    business_day: str,
    moving: bool = True,
    rounds: int = 1,
) -> date | None:
    """Incremental delete+insert of a fact stored at `path`; returns the day it restarted from.

    `build(since)` gives the rows from the last loaded business day on (everything on the first
    load). That day is a literal, so it prunes the source. Changes to older rows are not seen: build
    by arrival date to catch them. `moving=False` states that a key never changes its partition. The
    first load is written in `rounds`; a later batch, which the upsert reads several times, is settled.
    """
    tables.finish_publish(spark, path)
    loaded = any(n.startswith(f"{partition}=") for n in Files(spark, path).names(path))
    since = tables.high_water(spark.read.parquet(path), business_day) if loaded else None
    batch = build(since)
    with scratch_scope(spark):
        batch = settle(batch, "batch") if loaded else batch
        tables.upsert(batch, path, keys, partition, partial(merge.delete_insert, keys=keys), moving, rounds=rounds)
    return since


def check_marts(stored: dict[str, DataFrame], as_of: datetime | date) -> DataFrame:
    """Contract verdicts of the three contracted marts."""
    parts = [quality.validate(stored[c.table.split(".")[1]], c, as_of) for c in contracts.CONTRACTS]
    return reduce(DataFrame.unionByName, parts)


def check_stored(spark: SparkSession, as_of: datetime | date, database: str = "default") -> DataFrame:
    """`check_marts` over stored tables; a table that is not there fails its contract."""
    parts = []
    for contract in contracts.CONTRACTS:
        table = f"{database}.{contract.table.split('.')[1]}"
        if spark.catalog.tableExists(table):
            parts.append(quality.validate(spark.table(table), contract, as_of))
        else:
            row = (contract.table, f"{contract.table}_existe", "existe", quality.CRITICAL, False, None)
            parts.append(spark.createDataFrame([row], quality.RESULT_SCHEMA))
    return reduce(DataFrame.unionByName, parts)


def register_views(frames: dict[str, DataFrame]) -> None:
    """Staging and intermediate frames as views for SQL users; nothing is stored."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def declared_verdicts(stored: dict[str, DataFrame], as_of: datetime | date) -> DataFrame:
    """Verdicts of all declared column tests and relationships over stored marts."""
    parts = [quality.run_checks(stored[name], name, checks, as_of) for name, checks in contracts.TESTS.items()]
    for fact, fk, dim, pk in contracts.RELATIONSHIPS:
        lost = merge.orphans(stored[fact], fk, stored[dim], pk).agg(F.coalesce(F.sum("fact_rows"), F.lit(0)).alias("violations"))
        parts.append(
            lost.select(
                F.lit(fact).alias("table"), F.lit(f"{fk}_relationships").alias("id"), F.lit("relationships").alias("type"),
                F.lit(quality.WARN).alias("severity"), (F.col("violations") == 0).alias("ok"), "violations",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def store_failures(stored: dict[str, DataFrame], verdicts: DataFrame, home: str, run_id: str) -> list[str]:
    """Writes the failing rows of each failed test under `home`; returns the folders, one per test."""
    red = {(r["table"], r["id"]) for r in verdicts.where("not ok").select("table", "id").collect()}  # one row per declared test
    contracted = {c.table: c for c in contracts.CONTRACTS}
    checks = [(name, name, c) for name, listed in contracts.TESTS.items() for c in listed]
    checks += [(t, t.split(".")[1], c) for t, k in contracted.items() for c in quality.contract_checks(k, stored[t.split(".")[1]].columns)]
    folders = []
    for table, mart, check in checks:
        if (table, check.name) in red and check.type != "freshness":
            path = f"{home}/failures/run_id={run_id}/{table}/{check.name}"
            quality.violations(stored[mart], check).write.mode("overwrite").parquet(path)
            folders.append(path)
    for fact, fk, dim, pk in contracts.RELATIONSHIPS:
        if (fact, f"{fk}_relationships") in red:
            path = f"{home}/failures/run_id={run_id}/{fact}/{fk}_relationships"
            merge.orphans(stored[fact], fk, stored[dim], pk).write.mode("overwrite").parquet(path)
            folders.append(path)
    return folders


def transform(
    entities: dict[str, DataFrame],
    as_of: date,
    start: date,
    home: str,
    run_id: str,
    database: str = "default",
    dedup: bool = True,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Builds candidate marts, checks them, records the verdict and publishes only if no critical check failed.

    The gate row is appended to `home`/quality_gates and the failing rows of every red test are stored,
    whatever the verdict. A rejected run raises `GateRejected` and leaves the live marts as they
    were. Returns the live marts and the gate row.
    """
    stored = store_marts(build_marts(entities, as_of, start, dedup=dedup), database, CANDIDATE)
    spark = next(iter(stored.values())).sparkSession
    with scratch_scope(spark):
        verdicts = settle(check_marts(stored, as_of).unionByName(declared_verdicts(stored, as_of)), "verdicts")
        planned = quality.quality_gate(verdicts)
        row = planned.first()
        gate = spark.createDataFrame([row], planned.schema)
        recorded = gate.select(F.lit(run_id).alias("run_id"), F.lit(as_of).alias("as_of"), "*")
        tables.append(recorded.coalesce(1), f"{home}/quality_gates")  # one row
        store_failures(stored, verdicts, home, run_id)
    if row.status == quality.REJECTED:
        raise GateRejected(f"{run_id}: {row.critical_failed} critical checks failed; see {home}/failures")
    return publish(spark, database), gate


@dataclass
class Trained:
    model: PipelineModel
    test: DataFrame
    metrics: DataFrame


def train_churn(features: DataFrame, params: churn.Boosting = churn.PRIMARY) -> Trained:
    """Split, weight, fit and evaluate.

    The training frame and its split are settled in the shared folder: the split and the boosting
    read them many times, and a lost executor must not recompute the marts behind them.
    """
    frame = settle(churn.training_frame(features), "training")
    split = settle(stratified_split(frame, "customer_id", churn.LABEL, seed=churn.SEED), "split")
    fit, test = (split.where(F.col("in_test") == flag).drop("in_test") for flag in (0, 1))
    balance = evaluation.class_weight(fit).first()
    if balance.negatives + balance.positives == 0:
        raise ValueError("no labelled feature rows to train on")
    model = churn.train(fit, balance.weight, params=params)
    scored = churn.score(model, test).withColumn("part", F.lit("test"))
    return Trained(model, test, evaluation.model_metrics(scored, "part"))


def score_partition(
    model: PipelineModel, features: DataFrame, customers: DataFrame, lake: str, scoring_dt: date
) -> DataFrame:
    """Scores the feature snapshot and replaces its `scoring_dt` partition; returns the summary."""
    base = churn.with_sensitive(features.select("customer_id", *churn.FEATURES), customers)
    scored = churn.score(model, base).withColumn("scoring_dt", F.lit(scoring_dt))
    path = f"{lake}/silver/scoring"
    bronze.write_partitions(scored, path, "scoring_dt")
    written = features.sparkSession.read.parquet(path).where(F.col("scoring_dt") == F.lit(scoring_dt))
    if written.isEmpty():
        raise ValueError("the feature table gave no rows to score")
    return evaluation.scoring_summary(written)
