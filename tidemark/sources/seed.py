"""Deterministic shop data from a numbered frame: column `n` = 1, 2, ... (see `numbered`).

Every attribute is a formula of `n`, so any number of rows is generated in parallel and twice the
same. `anchor` stands for the moment of generation.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.columns import pad_key, pick
from tidemark.sources.adapter import (
    AGE_BANDS,
    CITIES,
    CITY_REGIONS,
    GENDERS,
    ORDER_CHANNELS,
    PAYMENT_METHODS,
    SEGMENTS,
    SELLER_CHANNELS,
    SELLER_REGIONS,
    TICKET_PRIORITIES,
    TICKET_STATUSES,
    TICKET_TOPICS,
)

# Default row counts and domains.
ROWS = {"sellers": 5, "customers": 200, "products": 50, "orders": 800, "support_tickets": 100}
SEED_CATEGORIES = ("electronica", "hogar", "moda", "deportes", "libros")
ORDER_STATUSES = ("pending", "paid", "shipped", "delivered", "cancelled", "refunded")


def numbered(spark: SparkSession, rows: int) -> DataFrame:
    return spark.range(1, rows + 1).select(F.col("id").alias("n"))


def _cycle(values: tuple[str, ...]) -> Column:
    return pick(values, f"(n - 1) % {len(values)}")


def _ago(anchor: datetime, days: Column, hours: Column | None = None) -> Column:
    return F.lit(anchor) - F.make_dt_interval(days.cast("int"), F.lit(0) if hours is None else hours.cast("int"))


def _price_cents(step: Column) -> Column:
    """List price in cents: 9.90 plus up to 19 steps of 7.25."""
    return step % 20 * 725 + 990


def _money(value_cents: Column) -> Column:
    return (value_cents.cast("decimal(12,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(12,2)")


def _half_up(value: Column, unit: int) -> Column:
    """Non-negative integers divided by `unit`, rounded half up."""
    return F.call_function("div", value * 2 + unit, F.lit(2 * unit))


def seed_sellers(ids: DataFrame, anchor: datetime) -> DataFrame:
    n = F.col("n")
    joined = _ago(anchor, n * 30)
    return ids.select(
        pad_key("SEL-", "n", 3).alias("seller_id"),
        F.concat(F.lit("Vendedor "), n.cast("string")).alias("seller_name"),
        _cycle(SELLER_REGIONS).alias("region"),
        _cycle(SELLER_CHANNELS).alias("channel"),
        joined.alias("joined_at"),
        joined.alias("updated_at"),
    )


def seed_customers(ids: DataFrame, anchor: datetime) -> DataFrame:
    n = F.col("n")
    return ids.select(
        pad_key("CUS-", "n", 5).alias("customer_id"),
        F.concat(F.lit("Cliente "), n.cast("string")).alias("full_name"),
        F.concat(F.lit("cliente"), n.cast("string"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("+34 6"), F.lpad((n * 7919 % 100000000).cast("string"), 8, "0")).alias("phone"),
        _cycle(CITIES).alias("city"),
        _cycle(CITY_REGIONS).alias("region"),
        _cycle(SEGMENTS).alias("segment"),
        _cycle(GENDERS).alias("gender"),
        _cycle(AGE_BANDS).alias("age_band"),
        _ago(anchor, n % 400).alias("created_at"),
        _ago(anchor, n % 60).alias("updated_at"),
    )


def seed_products(ids: DataFrame, anchor: datetime, sellers: int = ROWS["sellers"]) -> DataFrame:
    n = F.col("n")
    price = _price_cents(n)
    return ids.select(
        pad_key("PRD-", "n", 5).alias("product_id"),
        pad_key("SKU-", "n", 5).alias("sku"),
        F.concat(F.lit("Producto "), n.cast("string")).alias("product_name"),
        _cycle(SEED_CATEGORIES).alias("category"),
        F.concat(F.lit("Marca "), ((n - 1) % 12 + 1).cast("string")).alias("brand"),
        _money(price).alias("unit_price"),
        _money(_half_up(price * 62, 100)).alias("cost_amount"),
        pad_key("SEL-", f"(n - 1) % {sellers} + 1", 3).alias("seller_id"),
        (n % 17 != 0).alias("is_active"),
        _ago(anchor, n % 300).alias("created_at"),
        _ago(anchor, n % 45).alias("updated_at"),
    )


def _lines(ids: DataFrame, products: int) -> DataFrame:
    """One line per order, two where `n` is a multiple of 3. Discounts are 0, 2.5 or 5 percent."""
    n, item = F.col("n"), F.col("item")
    product = (n * 7 + item * 11) % products
    items = F.sequence(F.lit(1), F.when(n % 3 == 0, 2).otherwise(1))
    return ids.select(n, F.explode(items).alias("item")).select(
        n,
        item,
        (product + 1).alias("product_no"),
        ((n + item) % 4 + 1).alias("quantity"),
        _price_cents(product).alias("price_cents"),
        (n % 3 * 25).alias("discount_mille"),
    )


def seed_order_items(ids: DataFrame, anchor: datetime, products: int = ROWS["products"]) -> DataFrame:
    net = F.col("quantity") * F.col("price_cents") * (1000 - F.col("discount_mille"))
    return _lines(ids, products).select(
        pad_key("ORD-", "n", 6).alias("order_id"),
        pad_key("PRD-", "product_no", 5).alias("product_id"),
        F.col("quantity").cast("int").alias("quantity"),
        _money(F.col("price_cents")).alias("unit_price"),
        (F.col("discount_mille").cast("decimal(5,0)") / 10).cast("decimal(5,2)").alias("discount_pct"),
        _money(_half_up(net, 1000)).alias("line_total"),
        _ago(anchor, F.col("n") % 120).alias("updated_at"),
    )


def seed_orders(
    ids: DataFrame, anchor: datetime, customers: int = ROWS["customers"], products: int = ROWS["products"]
) -> DataFrame:
    """Orders whose total is the rounded sum of their unrounded lines."""
    n = F.col("n")
    net = F.col("quantity") * F.col("price_cents") * (1000 - F.col("discount_mille"))
    totals = _lines(ids, products).groupBy("n").agg(F.sum(net).alias("net"))
    moment = _ago(anchor, n % 120, n % 11)
    return totals.select(
        pad_key("ORD-", "n", 6).alias("order_id"),
        pad_key("CUS-", f"n * 37 % {customers} + 1", 5).alias("customer_id"),
        moment.alias("order_ts"),
        _cycle(ORDER_STATUSES).alias("status"),
        _cycle(ORDER_CHANNELS).alias("channel"),
        _money(_half_up(F.col("net"), 1000)).alias("total_amount"),
        moment.alias("created_at"),
        moment.alias("updated_at"),
    )


def seed_payments(ids: DataFrame, orders: DataFrame) -> DataFrame:
    """One payment per numbered order that exists."""
    n, status = F.col("n"), F.col("status")
    paid_at = F.col("order_ts") + F.expr("interval 2 hours")
    joined = ids.withColumn("order_id", pad_key("ORD-", "n", 6)).join(
        orders.select("order_id", "order_ts", "status", "total_amount"), "order_id"
    )
    verdict = (
        F.when(status == "cancelled", "rejected")
        .when(status == "refunded", "refunded")
        .when(status == "pending", "pending")
        .otherwise("approved")
    )
    void = status.isin("cancelled", "refunded")
    return joined.select(
        pad_key("PAY-", "n", 6).alias("payment_id"),
        "order_id",
        paid_at.alias("paid_at"),
        _cycle(PAYMENT_METHODS).alias("payment_method"),
        F.when(void, F.lit(0)).otherwise(F.col("total_amount")).cast("decimal(12,2)").alias("paid_amount"),
        verdict.alias("payment_status"),
        paid_at.alias("updated_at"),
    )


def seed_support_tickets(
    ids: DataFrame, anchor: datetime, customers: int = ROWS["customers"], orders: int = ROWS["orders"]
) -> DataFrame:
    n = F.col("n")
    return ids.select(
        pad_key("TCK-", "n", 5).alias("ticket_id"),
        pad_key("CUS-", f"n * 37 % {customers} + 1", 5).alias("customer_id"),
        pad_key("ORD-", f"n * 13 % {orders} + 1", 6).alias("order_id"),
        _ago(anchor, n % 120, n % 9).alias("opened_at"),
        _cycle(TICKET_TOPICS).alias("topic"),
        _cycle(TICKET_PRIORITIES).alias("priority"),
        _cycle(TICKET_STATUSES).alias("status"),
        _ago(anchor, n % 120).alias("updated_at"),
    )
