"""KPI and reporting queries."""

from __future__ import annotations

from tidemark.operators import kpi
from tidemark.registry.core import query
from tidemark.registry.ctes import AS_OF
from tidemark.registry.marts import Planned

DAILY = f"""SELECT order_date, count(DISTINCT order_id) AS orders, sum(line_total) AS revenue, sum(gross_margin) AS margin
            FROM fct_orders WHERE order_date >= {AS_OF} - 90 GROUP BY order_date"""


@query("order_date:s orders:i revenue:d margin:d", DAILY)
def kpi_daily(b):
    return kpi.kpi_daily(Planned(b).fct_orders(), b.as_of)


@query("order_date:s orders:i revenue:d margin:d", DAILY + " ORDER BY order_date DESC LIMIT 10")
def kpi_last_days(b):
    return kpi.last_days(kpi.kpi_daily(Planned(b).fct_orders(), b.as_of))


def _monthly(dimension: str) -> str:
    return f"""SELECT year(order_date) * 100 + month(order_date) AS month, {dimension}, sum(line_total) AS revenue
               FROM fct_orders GROUP BY 1, 2"""


@query("month:i category:s revenue:d", _monthly("category"))
def kpi_month_category(b):
    return kpi.revenue_by_month(Planned(b).fct_orders(), "category")


@query("month:i channel:s revenue:d", _monthly("channel"))
def kpi_channel(b):
    return kpi.revenue_by_month(Planned(b).sales(), "channel")


@query("month:i seller_id:s revenue:d", _monthly("seller_id"))
def kpi_seller(b):
    return kpi.revenue_by_month(Planned(b).fct_orders(), "seller_id")


@query(
    "channel:s orders:i revenue:d avg_ticket:d",
    """SELECT channel, count(DISTINCT order_id) AS orders, sum(line_total) AS revenue,
              CAST(sum(line_total) AS DOUBLE) / count(DISTINCT order_id) AS avg_ticket FROM fct_orders GROUP BY channel""",
)
def avg_ticket_channel(b):
    return kpi.avg_ticket_by(Planned(b).sales())


@query(
    "churn_label:i n:i share:d",
    """SELECT churn_label, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM customer_features GROUP BY churn_label""",
)
def label_distribution(b):
    return kpi.label_distribution(Planned(b).features())


@query(
    "month:i revenue:d margin:d churn_rate:d",
    """SELECT coalesce(m.month, c.month) AS month, m.revenue, m.margin, c.churn_rate
       FROM (SELECT year(order_date) * 100 + month(order_date) AS month, sum(line_total) AS revenue, sum(gross_margin) AS margin
             FROM fct_orders GROUP BY 1) m
       FULL JOIN (SELECT year(report_date) * 100 + month(report_date) AS month, sum(churn_label) / count(*) AS churn_rate
             FROM customer_features GROUP BY 1) c ON c.month = m.month""",
)
def monthly_report(b):
    p = Planned(b)
    return kpi.monthly_report(p.fct_orders(), p.features())


@query(
    "rows:i customers:i current_rows:i",
    """SELECT count(*) AS rows, count(DISTINCT customer_id) AS customers, sum(is_current) AS current_rows FROM dim_customer""",
)
def scd2_counts(b):
    return kpi.scd2_counts(Planned(b).dim_customer())


@query(
    "repeated_total:d order_total:d line_total:d inflation:d",
    """SELECT (SELECT sum(total_amount) FROM fct_orders) AS repeated_total,
              (SELECT sum(t) FROM (SELECT order_id, max(total_amount) AS t FROM fct_orders GROUP BY order_id)) AS order_total,
              (SELECT sum(line_total) FROM fct_orders) AS line_total,
              CAST((SELECT sum(total_amount) FROM fct_orders) AS DOUBLE)
                / CAST((SELECT sum(t) FROM (SELECT order_id, max(total_amount) AS t FROM fct_orders GROUP BY order_id)) AS DOUBLE) AS inflation""",
)
def grain_check(b):
    return kpi.grain_check(Planned(b).sales())


@query("lines:i revenue:d", "SELECT count(*) AS lines, sum(line_total) AS revenue FROM fct_orders")
def gold_totals(b):
    return kpi.gold_totals(Planned(b).sales())


@query("last_order_date:s rows:i", "SELECT max(order_date) AS last_order_date, count(*) AS rows FROM fct_orders")
def gold_freshness(b):
    return kpi.gold_freshness(Planned(b).sales())
