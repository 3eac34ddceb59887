from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import contracts
from tidemark.operators import quality
from tidemark.operators.quality import Check, Contract

AS_OF = datetime(2024, 1, 31, 12)


def verdict(df, check):
    r = quality.run_checks(df, "t", [check], AS_OF).first()
    return r.ok, r.violations


BROKEN = [
    (Check("unique", ("k",)), [(1,), (2,)], [(1,), (1,), (2,)], 1),
    (Check("unique", ("k",)), [(1,), (2,)], [(1,), (None,)], 1),
    (Check("not_null", ("k",)), [(1,)], [(1,), (None,), (None,)], 2),
    (Check("accepted_range", ("k",), min=0, max=5), [(0,), (5,), (None,)], [(-1,), (6,), (3,)], 2),
    (Check("accepted_range", ("k",), min=0), [(0,)], [(-1,)], 1),
    (Check("accepted_range", ("k",), max=0), [(0,)], [(1,)], 1),
    (Check("accepted_values", ("k",), values=(0, 1)), [(0,), (1,), (None,)], [(2,), (1,)], 1),
]


@pytest.mark.parametrize("check, good, bad, n", BROKEN)
def test_each_check_passes_and_fails(spark, check, good, bad, n):
    assert verdict(spark.createDataFrame(good, "k int"), check) == (True, 0)
    broken = spark.createDataFrame(bad, "k int")
    assert verdict(broken, check) == (False, n)
    assert quality.violations(broken, check).count() == (n if check.type != "unique" else (None,) not in bad)


def test_unique_combination(spark, rows):
    check = Check("unique_combination", ("a", "b"))
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (1, 2)], "a int, b int")
    assert verdict(df, check) == (False, 2)
    assert rows(quality.violations(df, check)) == [(1, 2, 3)]
    assert verdict(df.distinct(), check) == (True, 0)


@pytest.mark.parametrize(
    "newest, ok, minutes",
    [(datetime(2024, 1, 30, 12), True, 1440), (datetime(2024, 1, 30, 11, 59), False, 1441), (None, False, None)],
)
def test_freshness(spark, newest, ok, minutes):
    df = spark.createDataFrame([(newest,)], "ts timestamp")
    assert verdict(df, Check("freshness", ("ts",))) == (ok, minutes)


def test_freshness_of_a_date(spark):
    df = spark.createDataFrame([(date(2024, 1, 31),)], "d date")
    assert verdict(df, Check("freshness", ("d",))) == (True, 720)


def test_unknown_type_is_an_error(spark):
    with pytest.raises(ValueError):
        quality.measure(Check("mystery", ("k",)), AS_OF)


CONTRACT = Contract(
    "marts.t",
    (("k", "int", False), ("v", "decimal(18,2)", True)),
    (Check("unique", ("k",), id="t_pk"), Check("accepted_range", ("v",), quality.WARN, "t_range", min=0)),
)


def test_contract(spark, rows):
    df = spark.createDataFrame([(1, Decimal("1")), (1, Decimal("-1"))], "k int, v decimal(18,2)")
    got = rows(quality.validate(df, CONTRACT, AS_OF), "id", "ok", "violations")
    assert got == [("marts.t.k_not_null", True, 0), ("marts.t_columnas", True, 0), ("t_pk", False, 1), ("t_range", False, 1)]
    gate = quality.quality_gate(quality.validate(df, CONTRACT, AS_OF)).first()
    assert (gate.status, gate.tests_total, gate.tests_failed, gate.critical_failed) == ("rechazado", 4, 2, 1)


def test_warnings_do_not_reject(spark):
    df = spark.createDataFrame([(1, Decimal("-1"))], "k int, v decimal(18,2)")
    gate = quality.quality_gate(quality.validate(df, CONTRACT, AS_OF)).first()
    assert (gate.status, gate.tests_failed) == ("aprobado", 1)


def test_missing_column_fails_structure_and_its_tests(spark, rows):
    df = spark.createDataFrame([(1,)], "k int")
    got = {r.id: r.ok for r in quality.validate(df, CONTRACT, AS_OF).collect()}
    assert got == {"marts.t_columnas": False, "marts.t.k_not_null": True, "t_pk": True, "t_range": False}


def test_schema_match_sees_types(spark, rows):
    df = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    assert rows(quality.schema_match(df, CONTRACT), "column", "expected", "actual", "ok", "filled") == [
        ("k", "int", "int", True, 2),
        ("v", "decimal(18,2)", "string", False, 1),
    ]
    lacking = {r.column: (r.actual, r.ok, r.filled) for r in quality.schema_match(df.drop("v"), CONTRACT).collect()}
    assert lacking["v"] == (None, False, 0)


def test_declared_tests_are_complete():
    total = sum(len(c) for c in contracts.TESTS.values()) + len(contracts.RELATIONSHIPS)
    critical = sum(len(contracts.critical_tests(t)) for t in contracts.TESTS)
    assert (total, critical) == (46, 13)
    per_type = {}
    for checks in contracts.TESTS.values():
        for c in checks:
            per_type[c.type] = per_type.get(c.type, 0) + 1
    assert per_type == {"unique": 8, "not_null": 20, "accepted_range": 10, "accepted_values": 3}


def test_contracts_hold_62_checks():
    sizes = [1 + len(quality.contract_checks(c, [n for n, _, _ in c.columns])) for c in contracts.CONTRACTS]
    assert sizes == [23, 18, 21]


def test_null_profile(spark, rows):
    df = spark.createDataFrame([(1, None), (2, None), (3, 1)], "a int, b int")
    got = rows(quality.null_profile(df, "t"), "column", "rows", "nulls", "ok")
    assert got == [("a", 3, 0, True), ("b", 3, 2, False)]


def sales(spark, per_day):
    return spark.createDataFrame(
        [(d, f"{d}-{i}") for d, n in per_day.items() for i in range(n) for _ in range(2)], "order_date date, order_id string"
    )


def test_anomaly_volume_counts_orders_not_lines(spark, rows):
    days = {date(2024, 1, 10): 10, date(2024, 1, 11): 10, date(2024, 1, 12): 4, date(2023, 1, 1): 500}
    got = rows(quality.anomaly_volume(sales(spark, days), date(2024, 1, 31)))
    assert got == [(date(2024, 1, 12), 4, 6.4, 62.5)]


def test_volume_7d_is_two_sided(spark, rows):
    days = {date(2024, 1, d): 10 for d in range(1, 9)} | {date(2024, 1, 9): 13, date(2024, 1, 10): 8}
    flagged = {r.order_date.day: r.flagged for r in quality.volume_7d(sales(spark, days)).collect()}
    assert flagged[1] == 0 and flagged[8] == 0 and flagged[9] == 1 and flagged[10] == 1


def test_reconcile_counts_sees_both_sides(spark, rows):
    source = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "dt string")
    target = spark.createDataFrame([("a",), ("b",), ("d",), ("c",)], "dt string")
    assert rows(quality.reconcile_counts(source, target, ["dt"])) == [("a", 2, 1, 1), ("d", 0, 1, -1)]


def test_source_freshness_levels(spark, rows):
    def at(ts):
        return spark.createDataFrame([(ts,)], "updated_at timestamp")

    sources = {
        "now": at(AS_OF),
        "old": at(datetime(2024, 1, 30, 11)),
        "stale": at(datetime(2024, 1, 29, 11)),
        "empty": at(None),
    }
    got = rows(quality.source_freshness(sources, AS_OF), "source", "status")
    assert got == [("empty", "error"), ("now", "pass"), ("old", "warn"), ("stale", "error")]


def test_quarantine_split_loses_nothing(spark, rows):
    df = spark.createDataFrame([(1, -1), (None, 5), (None, -2), (3, 3)], "k int, v int")
    rules = [("no_key", F.col("k").isNull()), ("negative", F.col("v") < 0)]
    good, bad = quality.quarantine_split(df, rules)
    assert rows(good) == [(3, 3)]
    assert rows(bad, "v", "reason") == [(-1, "negative"), (-2, "no_key"), (5, "no_key")]


def test_reconcile_revenue_explains_the_gap(spark, rows):
    day = date(2024, 1, 1)
    orders = spark.createDataFrame(
        [(day, "paid", Decimal(10)), (day, "cancelled", Decimal(7))], "order_date date, status string, total_amount decimal(18,2)"
    )
    lines = spark.createDataFrame(
        [(day, "paid", Decimal(10), Decimal(6)), (day, "paid", Decimal(10), Decimal(3))],
        "order_date date, status string, total_amount decimal(18,2), line_total decimal(18,2)",
    )
    r = quality.reconcile_revenue(orders, lines).first()
    assert (r.source_total, r.excluded_total, r.mart_total, r.repeated_total, r["diff"]) == (10, 7, 9, 20, 1)


def test_a_late_table_has_no_failing_rows(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert quality.violations(df, quality.Check("freshness", ("x",))).count() == 0
