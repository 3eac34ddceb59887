"""Declarative checks compiled to as few Spark jobs as possible.

All null, range, value and freshness checks of a table become aggregates of one pass. A uniqueness
check needs its own aggregation by key; it is reduced per key on the map side, so a key with very
many copies costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

RESULT_SCHEMA = "table string, id string, type string, severity string, ok boolean, violations bigint"
APPROVED, REJECTED = "aprobado", "rechazado"
CRITICAL, WARN = "critical", "warn"


@dataclass(frozen=True)
class Check:
    """One declared test. `id` defaults to `<columns>_<type>`."""

    type: str
    columns: tuple[str, ...]
    severity: str = CRITICAL
    id: str = ""
    min: float | None = None
    max: float | None = None
    values: tuple = ()
    minutes: int = 1440

    @property
    def name(self) -> str:
        return self.id or "_".join([*self.columns, self.type])


@dataclass(frozen=True)
class Contract:
    """Declared columns as (name, type, nullable) and the checks of one table."""

    table: str
    columns: tuple[tuple[str, str, bool], ...]
    checks: tuple[Check, ...]


def outside(check: Check) -> Column:
    """Rows that break a range or value check. NULL passes."""
    c = F.col(check.columns[0])
    if check.type == "accepted_values":
        return ~c.isin(*check.values)
    bounds = [c < F.lit(check.min)] if check.min is not None else []
    if check.max is not None:
        bounds.append(c > F.lit(check.max))
    broken = bounds[0]
    for b in bounds[1:]:
        broken = broken | b
    return broken


def minutes_late(column: str, as_of: datetime | date) -> Column:
    """Whole minutes between the newest value and `as_of`; dates count from midnight."""
    return F.timestamp_diff("MINUTE", F.max(F.col(column).cast("timestamp")), F.lit(as_of).cast("timestamp"))


def measure(check: Check, as_of: datetime | date) -> Column:
    """Aggregate giving the violations of a one-pass check (freshness: minutes late, NULL if empty)."""
    if check.type == "not_null":
        return F.count_if(F.col(check.columns[0]).isNull())
    if check.type in ("accepted_range", "accepted_values"):
        return F.count_if(outside(check))
    if check.type == "freshness":
        return minutes_late(check.columns[0], as_of)
    raise ValueError(f"unknown check type {check.type!r}")


def is_unique_check(check: Check) -> bool:
    return check.type in ("unique", "unique_combination")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Failing rows of a uniqueness check: each repeated key and its number of copies."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def duplicate_diagnosis(bronze: DataFrame, gold: DataFrame, keys: list[str], day: str = "dt") -> DataFrame:
    """Keys repeated in Bronze or Gold: copies on both sides and the days on which Bronze got them."""
    days = F.array_join(F.array_sort(F.collect_set(F.col(day).cast("string"))), ",")  # at most one entry per day
    landed = bronze.groupBy(*keys).agg(F.count(F.lit(1)).alias("bronze_copies"), days.alias("days"))
    both = landed.join(duplicate_keys(gold, keys), keys, "full").withColumnRenamed("copies", "gold_copies")
    return both.where((F.col("bronze_copies") > 1) | F.col("gold_copies").isNotNull())


def surplus_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row with `violations` = rows - distinct keys. A key with a NULL part is not distinct."""
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.when(whole, F.col("n") - 1).otherwise(F.col("n"))), F.lit(0)).alias("violations"))


def surplus_by_check(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """`surplus_rows` of several uniqueness checks from one scan and one shuffle: columns v0, v1, ..."""
    cells = []
    for i, check in enumerate(checks):
        whole = reduce(lambda a, c: a & F.col(c).isNotNull(), check.columns, F.lit(True))
        key = F.to_json(F.struct(*[F.col(c).cast("string").alias(f"k{n}") for n, c in enumerate(check.columns)]))
        cells.append(F.struct(F.lit(i).alias("check"), key.alias("key"), whole.alias("whole")))
    per_key = df.select(F.inline(F.array(*cells))).groupBy("check", "key", "whole").agg(F.count(F.lit(1)).alias("n"))
    surplus = F.when(F.col("whole"), F.col("n") - 1).otherwise(F.col("n"))
    return per_key.agg(*[F.coalesce(F.sum(F.when(F.col("check") == i, surplus)), F.lit(0)).alias(f"v{i}") for i in range(len(checks))])


def violations(df: DataFrame, check: Check) -> DataFrame:
    """The rows that fail a check, for storing next to the verdict. A late table has no failing row."""
    if is_unique_check(check):
        return duplicate_keys(df, check.columns)
    if check.type == "freshness":
        return df.where(F.lit(False))
    if check.type == "not_null":
        return df.where(F.col(check.columns[0]).isNull())
    return df.where(outside(check))


def _verdict(check: Check, table: str, measured: Column) -> Column:
    limit = check.minutes if check.type == "freshness" else 0
    ok = F.coalesce(measured <= limit, F.lit(False))
    return F.struct(
        F.lit(table).alias("table"),
        F.lit(check.name).alias("id"),
        F.lit(check.type).alias("type"),
        F.lit(check.severity).alias("severity"),
        ok.alias("ok"),
        measured.cast("bigint").alias("violations"),
    )


def run_checks(df: DataFrame, table: str, checks: Sequence[Check], as_of: datetime | date) -> DataFrame:
    """Verdict rows for `checks`: one aggregate pass plus one for all uniqueness checks."""
    single = [c for c in checks if not is_unique_check(c)]
    parts: list[DataFrame] = []
    if single:
        wide = df.agg(*[measure(c, as_of).alias(f"m{i}") for i, c in enumerate(single)])
        verdicts = F.array(*[_verdict(c, table, F.col(f"m{i}")) for i, c in enumerate(single)])
        parts.append(wide.select(F.inline(verdicts)))
    keyed = [c for c in checks if is_unique_check(c)]
    if len(keyed) == 1:
        counted = surplus_rows(df, keyed[0].columns)
        parts.append(counted.select(F.inline(F.array(_verdict(keyed[0], table, F.col("violations"))))))
    elif keyed:
        verdicts = F.array(*[_verdict(c, table, F.col(f"v{i}")) for i, c in enumerate(keyed)])
        parts.append(surplus_by_check(df, keyed).select(F.inline(verdicts)))
    return reduce(DataFrame.unionByName, parts, df.sparkSession.createDataFrame([], RESULT_SCHEMA))


def contract_checks(contract: Contract, present: Sequence[str]) -> list[Check]:
    """Checks implied by the declared columns, then the declared tests."""
    implied = [
        Check("not_null", (name,), CRITICAL, f"{contract.table}.{name}_not_null")
        for name, _, nullable in contract.columns
        if not nullable and name in present
    ]
    declared = [c for c in contract.checks if set(c.columns) <= set(present)]
    return implied + declared


def validate(df: DataFrame, contract: Contract, as_of: datetime | date) -> DataFrame:
    """All verdicts of a table contract. A missing column fails the `columnas` check and its tests."""
    declared = [name for name, _, _ in contract.columns]
    missing = sorted(set(declared) - set(df.columns))
    lost = [c for c in contract.checks if not set(c.columns) <= set(df.columns)]
    verdicts = run_checks(df, contract.table, contract_checks(contract, df.columns), as_of)
    structure = [(contract.table, f"{contract.table}_columnas", "columnas", CRITICAL, not missing, len(missing))]
    structure += [(contract.table, c.name, c.type, c.severity, False, None) for c in lost]
    fixed = df.sparkSession.createDataFrame(structure, RESULT_SCHEMA)
    return fixed.unionByName(verdicts)


def quality_gate(verdicts: DataFrame, scope: str = "marts") -> DataFrame:
    """Rejected iff a critical check failed."""
    failed = ~F.col("ok")
    critical = F.count_if(failed & (F.col("severity") == CRITICAL))
    return verdicts.agg(
        F.count(F.lit(1)).alias("tests_total"),
        F.count_if(failed).alias("tests_failed"),
        critical.alias("critical_failed"),
    ).select(
        F.lit(scope).alias("scope"),
        F.when(F.col("critical_failed") > 0, REJECTED).otherwise(APPROVED).alias("status"),
        "tests_total",
        "tests_failed",
        "critical_failed",
    )


def null_profile(df: DataFrame, table: str, limit: float = 0.001) -> DataFrame:
    """Null count and rate of every column in one pass; `ok` while the rate is below `limit`."""
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns]
    rate = F.col("nulls") / F.when(F.col("_rows") > 0, F.col("_rows"))
    return wide.select(F.lit(table).alias("table"), "_rows", F.inline(F.array(*cells))).select(
        "table",
        "column",
        F.col("_rows").alias("rows"),
        "nulls",
        F.coalesce(rate, F.lit(0.0)).alias("null_rate"),
        F.coalesce(rate < limit, F.lit(True)).alias("ok"),
    )


def schema_match(df: DataFrame, contract: Contract) -> DataFrame:
    """Per declared column: is it there, does its type agree, how many values does it hold."""
    found = {f.name: f.dataType for f in df.schema.fields}
    kept = [name for name, _, _ in contract.columns if name in found]
    wide = df.agg(*[F.count(c).alias(c) for c in kept])
    cells = []
    for name, declared, _ in contract.columns:
        expected = T._parse_datatype_string(declared).simpleString()
        actual = found[name].simpleString() if name in found else None
        cells.append(
            F.struct(
                F.lit(contract.table).alias("table"),
                F.lit(name).alias("column"),
                F.lit(expected).alias("expected"),
                F.lit(actual).cast("string").alias("actual"),
                F.lit(actual == expected).alias("ok"),
                (F.col(name) if name in found else F.lit(0)).cast("bigint").alias("filled"),
            )
        )
    return wide.select(F.inline(F.array(*cells)))


def source_freshness(
    sources: dict[str, DataFrame], as_of: datetime | date, column: str = "updated_at", warn_hours: int = 24, error_hours: int = 48
) -> DataFrame:
    """Newest row of each source against a warning and an error age."""
    ages = [
        df.agg(minutes_late(column, as_of).alias("minutes_late")).select(F.lit(name).alias("source"), "minutes_late")
        for name, df in sources.items()
    ]
    late = F.col("minutes_late")
    status = (
        F.when(late.isNull() | (late > error_hours * 60), "error").when(late > warn_hours * 60, "warn").otherwise("pass")
    )
    return reduce(DataFrame.unionByName, ages).withColumn("status", status)


def daily_orders(sales: DataFrame) -> DataFrame:
    return sales.groupBy("order_date").agg(F.count_distinct("order_id").alias("orders_count"))


def anomaly_volume(sales: DataFrame, as_of: date, days: int = 30, factor: float = 0.8) -> DataFrame:
    """Days of the window whose orders fall below `factor` times the window's daily mean."""
    today = F.lit(as_of)
    inside = (F.col("order_date") >= F.date_sub(today, days)) & (F.col("order_date") < today)
    daily = daily_orders(sales.where(inside))
    floor = daily.agg((F.avg("orders_count") * factor).alias("floor"))
    return (
        daily.crossJoin(F.broadcast(floor))  # one row
        .where((F.col("floor") > 0) & (F.col("orders_count") < F.col("floor")))
        .select(
            "order_date",
            "orders_count",
            F.round("floor", 2).alias("min_expected"),
            F.round(F.col("orders_count") / F.col("floor") * 100, 2).alias("pct_of_threshold"),
        )
    )


def volume_7d(sales: DataFrame, tolerance_percent: int = 20, days: int = 7) -> DataFrame:
    """Each day against the mean of the previous `days` days.

    The window runs in one task, over one row per calendar day.
    """
    daily = daily_orders(sales)
    before = Window.orderBy("order_date").rowsBetween(-days, -1)
    total, n = F.sum("orders_count").over(before), F.count("orders_count").over(before)
    gap = F.abs(F.col("orders_count") * F.col("n") - F.col("total")) * 100
    return daily.select("order_date", "orders_count", total.alias("total"), n.alias("n")).select(
        "order_date",
        "orders_count",
        (F.col("total") / F.when(F.col("n") > 0, F.col("n"))).alias("mean_before"),
        F.coalesce(gap > F.col("total") * tolerance_percent, F.lit(False)).cast("int").alias("flagged"),
    )


def volume_having(sales: DataFrame, factor: float = 0.8) -> DataFrame:
    """Days whose line count is below `factor` times the mean over all days."""
    daily = sales.groupBy("order_date").agg(F.count(F.lit(1)).alias("lines"))
    floor = daily.agg((F.avg("lines") * factor).alias("floor"))
    return daily.crossJoin(F.broadcast(floor)).where(F.col("lines") < F.col("floor")).select("order_date", "lines")


def reconcile_counts(source: DataFrame, target: DataFrame, by: Sequence[str]) -> DataFrame:
    """Row counts of source and target per partition, where they differ."""
    left = source.groupBy(*by).agg(F.count(F.lit(1)).alias("source_rows"))
    right = target.groupBy(*by).agg(F.count(F.lit(1)).alias("target_rows"))
    a, b = F.coalesce("source_rows", F.lit(0)), F.coalesce("target_rows", F.lit(0))
    return (
        left.join(right, list(by), "full")
        .select(*by, a.alias("source_rows"), b.alias("target_rows"), (a - b).alias("diff"))
        .where(F.col("diff") != 0)
    )


def reconcile_revenue(orders: DataFrame, sales: DataFrame, excluded: Sequence[str] = ("cancelled", "refunded")) -> DataFrame:
    """Source order totals against mart line totals per day, with the part explained by status."""
    out = F.col("status").isin(*excluded)
    source = orders.groupBy("order_date").agg(
        F.sum(F.when(~out, F.col("total_amount")).otherwise(0)).alias("source_total"),
        F.sum(F.when(out, F.col("total_amount")).otherwise(0)).alias("excluded_total"),
    )
    mart = sales.groupBy("order_date").agg(
        F.sum(F.when(~out, F.col("line_total")).otherwise(0)).alias("mart_total"),
        F.sum(F.col("total_amount")).alias("repeated_total"),
    )
    amounts = ["source_total", "excluded_total", "mart_total", "repeated_total"]
    filled = source.join(mart, "order_date", "full").select(
        "order_date", *[F.coalesce(c, F.lit(0)).alias(c) for c in amounts]
    )
    return filled.withColumn("diff", F.col("source_total") - F.col("mart_total"))


def quarantine(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """Adds `reason`: the first rule a row breaks, NULL for good rows. Tagged once, split on write."""
    reason = F.lit(None).cast("string")
    for name, broken in reversed(list(rules)):
        reason = F.when(broken, F.lit(name)).otherwise(reason)
    return df.withColumn("reason", reason)


def quarantine_split(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    tagged = quarantine(df, rules)
    return tagged.where(F.col("reason").isNull()).drop("reason"), tagged.where(F.col("reason").isNotNull())
