"""Quality queries: declared tests, contracts, gates, volume and reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark import contracts
from tidemark.functions.columns import has_text
from tidemark.operators import quality, sketches
from tidemark.operators.staging import STAGING
from tidemark.plans.jobs import check_marts
from tidemark.plans.marts import customer_features
from tidemark.registry.core import query
from tidemark.registry.ctes import AS_OF
from tidemark.registry.marts import Planned
from tidemark.schemas import KEYS
from tidemark.session import settle


def table(p: Planned, name: str) -> DataFrame:
    frames = {
        "dim_date": lambda: p.calendar,
        "dim_customer": p.dim_customer,
        "dim_product": p.dim_product,
        "dim_seller": p.dim_seller,
        "fct_orders": p.fct_orders,
        "fct_payments": p.fct_payments,
        "customer_features": p.features,
    }
    return frames[name]()


def declared(b, kind: str) -> DataFrame:
    """Verdicts of every declared test of one type, one pass per table (plus one per unique key)."""
    p, grouped = Planned(b), {}
    for name, check in contracts.tests_of_type(kind):
        grouped.setdefault(name, []).append(check)
    parts = [quality.run_checks(table(p, name), name, checks, b.as_of) for name, checks in grouped.items()]
    return reduce(DataFrame.unionByName, parts)


def _sql(kind: str, count: str) -> str:
    rows = [
        f"""SELECT '{name}' AS "table", '{c.name}' AS id, {count.format(c=c, t=name, col=c.columns[0])} AS violations FROM {name}"""
        for name, c in contracts.tests_of_type(kind)
    ]
    return "\nUNION ALL ".join(rows)


def _range_sql() -> str:
    rows = []
    for name, c in contracts.tests_of_type("accepted_range"):
        bounds = [f"{c.columns[0]} < {c.min}"] + ([f"{c.columns[0]} > {c.max}"] if c.max is not None else [])
        rows.append(
            f"""SELECT '{name}' AS "table", '{c.name}' AS id, count(*) FILTER (WHERE {' OR '.join(bounds)}) AS violations FROM {name}"""
        )
    return "\nUNION ALL ".join(rows)


def _values_sql() -> str:
    rows = []
    for name, c in contracts.tests_of_type("accepted_values"):
        listed = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in c.values)
        rows.append(
            f"""SELECT '{name}' AS "table", '{c.name}' AS id,
                count(*) FILTER (WHERE {c.columns[0]} NOT IN ({listed})) AS violations FROM {name}"""
        )
    return "\nUNION ALL ".join(rows)


@query("table:s id:s violations:i", _sql("unique", "count(*) - count(DISTINCT {col})"))
def unique_violations(b):
    return declared(b, "unique")


@query("table:s id:s violations:i", _sql("not_null", "count(*) - count({col})"))
def not_null_violations(b):
    return declared(b, "not_null")


@query("table:s id:s violations:i", _range_sql())
def range_violations(b):
    return declared(b, "accepted_range")


@query("table:s id:s violations:i", _values_sql())
def accepted_values(b):
    return declared(b, "accepted_values")


@query(
    "order_id:s product_id:s copies:i",
    "SELECT order_id, product_id, count(*) AS copies FROM fct_orders GROUP BY order_id, product_id HAVING count(*) > 1",
)
def unique_combination(b):
    return quality.duplicate_keys(Planned(b).sales(), ["order_id", "product_id"])


def _profile_sql() -> str:
    names = [name for name, _, _ in contracts.FCT_ORDERS.columns]
    rows = [
        f"""SELECT 'fct_orders' AS "table", '{c}' AS "column", count(*) AS "rows", count(*) - count({c}) AS nulls,
            (count(*) - count({c})) / count(*) AS null_rate, (count(*) - count({c})) / count(*) < 0.001 AS ok FROM fct_orders"""
        for c in names
    ]
    return "\nUNION ALL ".join(rows)


@query("table:s column:s rows:i nulls:i null_rate:d ok:i", _profile_sql())
def null_profile(b):
    return quality.null_profile(Planned(b).fct_orders(), "fct_orders")


def _schema_sql() -> str:
    rows = []
    for contract in contracts.CONTRACTS:
        name = contract.table.split(".")[1]
        rows += [
            f"""SELECT '{contract.table}' AS "table", '{c}' AS "column", '{kind}' AS expected, 1 AS ok, count({c}) AS filled FROM {name}"""
            for c, kind, _ in contract.columns
        ]
    return "\nUNION ALL ".join(rows)


@query("table:s column:s expected:s ok:i filled:i", _schema_sql())
def schema_match(b):
    p = Planned(b)
    parts = [quality.schema_match(table(p, c.table.split(".")[1]), c) for c in contracts.CONTRACTS]
    return reduce(DataFrame.unionByName, parts)


@query(
    "table:s id:s ok:i violations:i",
    "\nUNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{c}_freshness' AS id,
            date_diff('minute', CAST(max({c}) AS TIMESTAMP), CAST({AS_OF} AS TIMESTAMP)) <= 1440 AS ok,
            date_diff('minute', CAST(max({c}) AS TIMESTAMP), CAST({AS_OF} AS TIMESTAMP)) AS violations FROM {t}"""
        for t, c in (("fct_orders", "ordered_at"), ("dim_customer", "updated_at"), ("customer_features", "report_date"))
    ),
)
def freshness_minutes(b):
    p = Planned(b)
    watched = {"fct_orders": "ordered_at", "dim_customer": "updated_at", "customer_features": "report_date"}
    parts = [
        quality.run_checks(table(p, name), name, [quality.Check("freshness", (column,), quality.WARN)], b.as_of)
        for name, column in watched.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "source:s minutes_late:i status:s",
    "\nUNION ALL ".join(
        f"""SELECT '{e}' AS source, m AS minutes_late,
            CASE WHEN m > 2880 THEN 'error' WHEN m > 1440 THEN 'warn' ELSE 'pass' END AS status
            FROM (SELECT date_sub('minute', max(updated_at), CAST({AS_OF} AS TIMESTAMP)) AS m FROM b_{e})"""
        for e in KEYS
    ),
)
def source_freshness(b):
    return quality.source_freshness({n: b.entity(n) for n in KEYS}, b.as_of)


@query(
    "order_date:s orders_count:i min_expected:d pct_of_threshold:d",
    f"""WITH d AS (SELECT * FROM daily_orders WHERE order_date >= {AS_OF} - 30 AND order_date < {AS_OF}),
             t AS (SELECT avg(orders_count) * 0.8 AS floor FROM d)
        SELECT order_date, orders_count, round(floor, 2) AS min_expected,
               round(orders_count / floor * 100, 2) AS pct_of_threshold
        FROM d, t WHERE floor > 0 AND orders_count < floor""",
)
def anomaly_volume(b):
    return quality.anomaly_volume(Planned(b).sales(), b.as_of)


@query(
    "order_date:s orders_count:i mean_before:d flagged:i",
    """SELECT order_date, orders_count, t / n AS mean_before,
              coalesce(abs(orders_count * n - t) * 100 > t * 20, false) AS flagged
       FROM (SELECT order_date, orders_count, sum(orders_count) OVER w AS t, count(*) OVER w AS n FROM daily_orders
             WINDOW w AS (ORDER BY order_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))""",
)
def volume_7d(b):
    return quality.volume_7d(Planned(b).sales())


GRAINS = {"day": "dt", "week": "CAST(date_trunc('week', dt) AS DATE)", "30 days": f"{AS_OF} - 30 * CAST(floor(date_diff('day', dt, {AS_OF}) / 30.0) AS INTEGER)"}


@query(
    "grain:s period:s orders:i",
    "\nUNION ALL ".join(
        f"SELECT '{grain}' AS grain, {period} AS period, count(DISTINCT order_id) AS orders FROM b_order_items GROUP BY {period}"
        for grain, period in GRAINS.items()
    ),
)
def distinct_orders_shipped(b):
    """Orders with a line shipped in each day, week and 30 days: an order that ships on several days counts once."""
    lines = b.order_items().select("order_id", "dt")
    numbered = lines.distinct().join(sketches.key_numbers(lines, "order_id"), "order_id")
    stored = settle(sketches.day_bitmaps(numbered, "dt", "number"), "day_bitmaps")
    day, today = F.col("dt"), F.lit(b.as_of)
    block = F.floor(F.date_diff(today, day) / 30).cast("int") * 30
    periods = {"day": day, "week": F.to_date(F.date_trunc("week", day)), "30 days": F.date_sub(today, block)}
    counted = [sketches.distinct_in(stored, F.lit(grain), period) for grain, period in periods.items()]
    return reduce(DataFrame.unionByName, counted).toDF("grain", "period", "orders")


@query(
    "order_date:s lines:i",
    """SELECT order_date, count(*) AS lines FROM fct_orders GROUP BY order_date
       HAVING count(*) < 0.8 * (SELECT avg(c) FROM (SELECT count(*) AS c FROM fct_orders GROUP BY order_date))""",
)
def volume_having(b):
    return quality.volume_having(Planned(b).sales())


@query(
    "dt:s source_rows:i target_rows:i diff:i",
    """SELECT dt, count(*) AS source_rows, count(*) FILTER (WHERE n % 50 <> 0) AS target_rows,
              count(*) FILTER (WHERE n % 50 = 0) AS diff
       FROM b_orders GROUP BY dt HAVING count(*) FILTER (WHERE n % 50 = 0) > 0""",
)
def reconcile_counts(b):
    """Bronze lost every fiftieth order; the days concerned are reported."""
    orders = b.orders()
    number = F.substring("order_id", 5, 30).cast("bigint")
    return quality.reconcile_counts(orders, orders.where(number % 50 != 0), ["dt"])


@query(
    "order_date:s source_total:d excluded_total:d mart_total:d repeated_total:d diff:d",
    """SELECT s.order_date, s.source_total, s.excluded_total, coalesce(m.mart_total, 0) AS mart_total,
              coalesce(m.repeated_total, 0) AS repeated_total, s.source_total - coalesce(m.mart_total, 0) AS diff
       FROM (SELECT order_date,
                    sum(CASE WHEN status NOT IN ('cancelled', 'refunded') THEN total_amount ELSE 0 END) AS source_total,
                    sum(CASE WHEN status IN ('cancelled', 'refunded') THEN total_amount ELSE 0 END) AS excluded_total
             FROM stg_orders GROUP BY order_date) s
       LEFT JOIN (SELECT order_date,
                    sum(CASE WHEN status NOT IN ('cancelled', 'refunded') THEN line_total ELSE 0 END) AS mart_total,
                    sum(total_amount) AS repeated_total
             FROM fct_orders GROUP BY order_date) m ON m.order_date = s.order_date""",
)
def reconcile_revenue(b):
    p = Planned(b)
    return quality.reconcile_revenue(p.stg("orders"), p.sales())


def _contract_sql() -> str:
    """One row per verdict of the three contracts: critical or not, ok or not."""
    rows = []
    for contract in contracts.CONTRACTS:
        name = contract.table.split(".")[1]
        rows.append("SELECT 'critical' AS severity, true AS ok")
        rows += [
            f"SELECT 'critical', count(*) = count({c}) FROM {name}" for c, _, nullable in contract.columns if not nullable
        ]
        for check in contract.checks:
            first, keys = check.columns[0], ", ".join(check.columns)
            test = {
                "unique": f"count(*) = count(DISTINCT {first})",
                "unique_combination": f"count(*) = (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {name}))",
                "not_null": f"count(*) = count({first})",
                "accepted_range": f"count(*) FILTER (WHERE {first} < {check.min}) = 0",
                "freshness": f"date_diff('minute', CAST(max({first}) AS TIMESTAMP), CAST({AS_OF} AS TIMESTAMP)) <= {check.minutes}",
            }[check.type]
            rows.append(f"SELECT '{check.severity}', {test} FROM {name}")
    return "\nUNION ALL ".join(rows)


def verdicts(b) -> DataFrame:
    """Contract verdicts over stored marts, as the checks read them more than once."""
    p = Planned(b)
    fact = settle(p.fct_orders(), "fct_orders")
    features = customer_features(fact, p.stg("support_tickets"), b.as_of)
    stored = {
        "fct_orders": fact,
        "dim_customer": settle(p.dim_customer(), "dim_customer"),
        "customer_features": settle(features, "customer_features"),
    }
    return check_marts(stored, b.as_of)


GATE_SQL = f"""SELECT 'marts' AS scope, CASE WHEN count(*) FILTER (WHERE NOT ok AND severity = 'critical') > 0
                 THEN 'rechazado' ELSE 'aprobado' END AS status,
               count(*) AS tests_total, count(*) FILTER (WHERE NOT ok) AS tests_failed,
               count(*) FILTER (WHERE NOT ok AND severity = 'critical') AS critical_failed
        FROM ({_contract_sql()})"""


@query("scope:s status:s tests_total:i tests_failed:i critical_failed:i", GATE_SQL)
def quality_gate(b):
    return quality.quality_gate(verdicts(b))


@query(
    "order_id:s total_amount:d reason:s",
    """SELECT order_id, total_amount, CASE WHEN trim(order_id) = '' THEN 'blank_key' WHEN total_amount < 0 THEN 'negative_amount'
              WHEN status NOT IN ('pending', 'paid', 'shipped', 'delivered', 'cancelled', 'refunded') THEN 'unknown_status' END AS reason
       FROM (SELECT CASE WHEN n % 97 = 5 THEN ' ' ELSE order_id END AS order_id,
                    CASE WHEN n % 50 = 7 THEN -total_amount ELSE total_amount END AS total_amount,
                    CASE WHEN n % 41 = 3 THEN 'lost' ELSE status END AS status FROM b_orders)""",
)
def quarantine_split(b):
    """Orders with planted faults: good rows and quarantined ones, tagged with the first broken rule."""
    number = F.substring("order_id", 5, 30).cast("bigint")
    faulty = b.orders().select(
        F.when(number % 97 == 5, " ").otherwise(F.col("order_id")).alias("order_id"),
        F.when(number % 50 == 7, -F.col("total_amount")).otherwise(F.col("total_amount")).alias("total_amount"),
        F.when(number % 41 == 3, "lost").otherwise(F.col("status")).alias("status"),
    )
    rules = [
        ("blank_key", ~has_text("order_id")),
        ("negative_amount", F.col("total_amount") < 0),
        ("unknown_status", ~F.col("status").isin(*contracts.ORDER_STATUSES)),
    ]
    good, bad = quality.quarantine_split(faulty, rules)
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(bad)


@query(
    "order_id:s total_amount:d reason:s",
    """SELECT order_id, CASE WHEN n % 13 = 0 THEN NULL WHEN n % 5 = 0 THEN -total_amount ELSE total_amount END AS total_amount,
              CASE WHEN n % 13 = 0 THEN 'bad_amount' WHEN n % 5 = 0 AND total_amount > 0 THEN 'negative_amount' END AS reason
       FROM b_orders""",
)
def stg_orders_dirty(b):
    """Amounts as text with many digits, signs and garbage: cut, not rounded, and bad ones set aside."""
    number = F.substring("order_id", 5, 30).cast("bigint")
    digits = F.concat(F.col("total_amount").cast("string"), F.lit("99999996"))
    text = F.when(number % 13 == 0, "12,x").when(number % 5 == 0, F.concat(F.lit(" -"), digits)).otherwise(digits)
    staged = STAGING["orders"](b.orders().withColumn("total_amount", text))
    good, bad = quality.quarantine_split(
        staged.select("order_id", "total_amount"),
        [("bad_amount", F.col("total_amount").isNull()), ("negative_amount", F.col("total_amount") < 0)],
    )
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(bad)


@query(
    "order_id:s product_id:s bronze_copies:i days:s gold_copies:i",
    """SELECT coalesce(b.order_id, g.order_id) AS order_id, coalesce(b.product_id, g.product_id) AS product_id,
              b.bronze_copies, b.days, g.gold_copies
       FROM (SELECT order_id, product_id, count(*) AS bronze_copies,
                    string_agg(DISTINCT CAST(dt AS VARCHAR), ',' ORDER BY CAST(dt AS VARCHAR)) AS days
             FROM b_order_items GROUP BY order_id, product_id) b
       FULL JOIN (SELECT order_id, product_id, count(*) AS gold_copies FROM fct_orders
                  GROUP BY order_id, product_id HAVING count(*) > 1) g
         ON g.order_id = b.order_id AND g.product_id = b.product_id
       WHERE b.bronze_copies > 1 OR g.gold_copies IS NOT NULL""",
)
def duplicate_diagnosis(b):
    """Repeated (order, product) pairs with the days they landed on."""
    return quality.duplicate_diagnosis(b.order_items(), Planned(b).sales(), ["order_id", "product_id"])
