"""Seed generators, numbered by the benchmark tables so the row counts follow the scale."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tidemark.contracts import ORDER_STATUSES
from tidemark.registry.core import query
from tidemark.registry.ctes import CTES, pad, pick
from tidemark.sources import adapter as domains, seed
from tidemark.sources.adapter import Bronze

ANCHOR = datetime(2001, 8, 2)
NOW = "TIMESTAMP '2001-08-02'"


def ids(b: Bronze, table: str, key: str) -> DataFrame:
    return b.raw(table).select((F.col(key) + 1).alias("n"))


def numbers(table: str, key: str) -> str:
    return f"(SELECT {key} + 1 AS n FROM {table})"


def ago(days: str, hours: str = "") -> str:
    text = f"{NOW} - to_days(CAST({days} AS INTEGER))"
    return f"{text} - to_hours({hours})" if hours else text


def cycle(values: tuple[str, ...]) -> str:
    return pick(values, f"((n - 1) % {len(values)})")


PRICE = "CAST(9.90 AS DECIMAL(12,2)) + ({} % 20) * CAST(7.25 AS DECIMAL(12,2))"
CTES["seed_lines"] = f"""
  SELECT n, item, 1 + ((n * 7 + item * 11) % 50) AS product_no, 1 + ((n + item) % 4) AS quantity,
         {PRICE.format('((n * 7 + item * 11) % 50)')} AS unit_price, CAST((n % 3) * 2.5 AS DECIMAL(5,2)) AS discount_pct,
         (1 + ((n + item) % 4)) * CAST({PRICE.format('((n * 7 + item * 11) % 50)')} AS DECIMAL(12,2))
           * (CAST(1 AS DECIMAL(6,3)) - CAST((n % 3) * 0.025 AS DECIMAL(6,3))) AS net
  FROM {numbers('orders', 'o_orderkey')}, (VALUES (1), (2)) AS i(item)
  WHERE item = 1 OR n % 3 = 0"""
CTES["seed_order_rows"] = f"""
  SELECT {pad('ORD-', 'n', 6)} AS order_id, {pad('CUS-', '(1 + ((n * 37) % 200))', 5)} AS customer_id,
         {ago('n % 120', 'n % 11')} AS order_ts, {cycle(ORDER_STATUSES)} AS status,
         {cycle(domains.ORDER_CHANNELS)} AS channel, total_amount, n
  FROM (SELECT n, round(sum(net), 2) AS total_amount FROM seed_lines GROUP BY n)"""


@query(
    "seller_id:s seller_name:s region:s channel:s joined_at:s updated_at:s",
    f"""SELECT {pad('SEL-', 'n', 3)} AS seller_id, 'Vendedor ' || CAST(n AS VARCHAR) AS seller_name,
               {cycle(domains.SELLER_REGIONS)} AS region, {cycle(domains.SELLER_CHANNELS)} AS channel,
               {ago('n * 30')} AS joined_at, {ago('n * 30')} AS updated_at
        FROM {numbers('supplier', 's_suppkey')}""",
)
def seed_sellers(b):
    return seed.seed_sellers(ids(b, "supplier", "s_suppkey"), ANCHOR)


@query(
    "customer_id:s full_name:s email:s phone:s city:s region:s segment:s gender:s age_band:s created_at:s updated_at:s",
    f"""SELECT {pad('CUS-', 'n', 5)} AS customer_id, 'Cliente ' || CAST(n AS VARCHAR) AS full_name,
               'cliente' || CAST(n AS VARCHAR) || '@example.com' AS email,
               '+34 6' || lpad(CAST((n * 7919) % 100000000 AS VARCHAR), 8, '0') AS phone,
               {cycle(domains.CITIES)} AS city,
               {cycle(domains.CITY_REGIONS)} AS region, {cycle(domains.SEGMENTS)} AS segment,
               {cycle(domains.GENDERS)} AS gender, {cycle(domains.AGE_BANDS)} AS age_band,
               {ago('n % 400')} AS created_at, {ago('n % 60')} AS updated_at
        FROM {numbers('customer', 'c_custkey')}""",
)
def seed_customers(b):
    return seed.seed_customers(ids(b, "customer", "c_custkey"), ANCHOR)


@query(
    "product_id:s sku:s product_name:s category:s brand:s unit_price:d cost_amount:d seller_id:s is_active:i created_at:s updated_at:s",
    f"""SELECT {pad('PRD-', 'n', 5)} AS product_id, {pad('SKU-', 'n', 5)} AS sku, 'Producto ' || CAST(n AS VARCHAR) AS product_name,
               {cycle(tuple(domains.CATEGORY_BY_TYPE.values()))} AS category, 'Marca ' || CAST(1 + (n - 1) % 12 AS VARCHAR) AS brand,
               price AS unit_price, round(CAST(price AS DECIMAL(12,2)) * CAST(0.62 AS DECIMAL(3,2)), 2) AS cost_amount,
               {pad('SEL-', '(1 + (n - 1) % 5)', 3)} AS seller_id, n % 17 <> 0 AS is_active,
               {ago('n % 300')} AS created_at, {ago('n % 45')} AS updated_at
        FROM (SELECT n, {PRICE.format('n')} AS price FROM {numbers('part', 'p_partkey')})""",
)
def seed_products(b):
    return seed.seed_products(ids(b, "part", "p_partkey"), ANCHOR)


@query(
    "order_id:s product_id:s quantity:i unit_price:d discount_pct:d line_total:d updated_at:s",
    f"""SELECT {pad('ORD-', 'n', 6)} AS order_id, {pad('PRD-', 'product_no', 5)} AS product_id, quantity, unit_price, discount_pct,
               round(net, 2) AS line_total, {ago('n % 120')} AS updated_at FROM seed_lines""",
)
def seed_order_items(b):
    return seed.seed_order_items(ids(b, "orders", "o_orderkey"), ANCHOR)


@query(
    "order_id:s customer_id:s order_ts:s status:s channel:s total_amount:d created_at:s updated_at:s",
    "SELECT *, order_ts AS created_at, order_ts AS updated_at FROM seed_order_rows",
)
def seed_orders(b):
    return seed.seed_orders(ids(b, "orders", "o_orderkey"), ANCHOR)


@query(
    "payment_id:s order_id:s paid_at:s payment_method:s paid_amount:d payment_status:s updated_at:s",
    f"""SELECT {pad('PAY-', 'n', 6)} AS payment_id, order_id, order_ts + INTERVAL 2 HOUR AS paid_at,
               {cycle(domains.PAYMENT_METHODS)} AS payment_method,
               CASE WHEN status IN ('cancelled', 'refunded') THEN 0 ELSE total_amount END AS paid_amount,
               CASE status WHEN 'cancelled' THEN 'rejected' WHEN 'refunded' THEN 'refunded' WHEN 'pending' THEN 'pending'
                           ELSE 'approved' END AS payment_status,
               order_ts + INTERVAL 2 HOUR AS updated_at FROM seed_order_rows""",
)
def seed_payments(b):
    numbered = ids(b, "orders", "o_orderkey")
    return seed.seed_payments(numbered, seed.seed_orders(numbered, ANCHOR))


@query(
    "ticket_id:s customer_id:s order_id:s opened_at:s topic:s priority:s status:s updated_at:s",
    f"""SELECT {pad('TCK-', 'n', 5)} AS ticket_id, {pad('CUS-', '(1 + (n * 37) % 200)', 5)} AS customer_id,
               {pad('ORD-', '(1 + (n * 13) % 800)', 6)} AS order_id, {ago('n % 120', 'n % 9')} AS opened_at,
               {cycle(domains.TICKET_TOPICS)} AS topic, {cycle(domains.TICKET_PRIORITIES)} AS priority,
               {cycle(domains.TICKET_STATUSES)} AS status, {ago('n % 120')} AS updated_at
        FROM {numbers('events', 'event_id')}""",
)
def seed_support_tickets(b):
    return seed.seed_support_tickets(ids(b, "events", "event_id"), ANCHOR)
