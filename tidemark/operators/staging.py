"""Silver conformers: one projection and one filter per entity, no shuffle."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import (
    email_digest,
    has_text,
    lower_clean,
    mask_phone,
    money_of,
    timestamp_of,
    upper_clean,
)


def _text(name: str) -> Column:
    return F.trim(F.col(name).cast("string")).alias(name)


def _key(name: str) -> Column:
    return F.col(name).cast("string").alias(name)


def _low(name: str) -> Column:
    return lower_clean(name).alias(name)


def between_days(bronze: DataFrame, column: str, first: date | None, last: date | None) -> DataFrame:
    """Keeps whole days `first`..`last` of an untouched source column, so the scan can skip row groups."""
    if first is not None:
        bronze = bronze.where(F.col(column) >= F.lit(first))
    if last is not None:
        bronze = bronze.where(F.col(column) < F.lit(last + timedelta(days=1)))
    return bronze


def stg_orders(bronze: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    """`first` and `last` bound the order day on a bronze table whose timestamps are typed."""
    bronze = between_days(bronze, "order_ts", first, last)
    ordered_at = timestamp_of(bronze, "order_ts")
    return bronze.where(has_text("order_id")).select(
        _key("order_id"),
        _key("customer_id"),
        ordered_at.alias("ordered_at"),
        _low("status"),
        _low("channel"),
        money_of(bronze, "total_amount").alias("total_amount"),
        F.to_date(ordered_at).alias("order_date"),
        timestamp_of(bronze, "updated_at").alias("updated_at"),
        F.col("dt").alias("ingested_dt"),
    )


def stg_customers(bronze: DataFrame) -> DataFrame:
    """Masks e-mail and phone; the raw values do not leave this projection."""
    return bronze.where(has_text("customer_id")).select(
        _key("customer_id"),
        _text("full_name"),
        email_digest("email").alias("email_hash"),
        mask_phone("phone").alias("phone_masked"),
        *[_low(c) for c in ("city", "region", "segment", "gender")],
        _text("age_band"),
        timestamp_of(bronze, "created_at").alias("created_at"),
        timestamp_of(bronze, "updated_at").alias("updated_at"),
    )


def stg_products(bronze: DataFrame) -> DataFrame:
    return bronze.where(has_text("product_id")).select(
        _key("product_id"),
        upper_clean("sku").alias("sku"),
        _text("product_name"),
        _low("category"),
        _low("brand"),
        money_of(bronze, "unit_price").alias("unit_price"),
        money_of(bronze, "cost_amount").alias("cost_amount"),
        _key("seller_id"),
        F.col("is_active").cast("int").alias("is_active"),
        timestamp_of(bronze, "updated_at").alias("updated_at"),
    )


def stg_sellers(bronze: DataFrame) -> DataFrame:
    return bronze.where(has_text("seller_id")).select(
        _key("seller_id"),
        _text("seller_name"),
        _low("region"),
        _low("channel"),
        timestamp_of(bronze, "joined_at").alias("joined_at"),
        timestamp_of(bronze, "updated_at").alias("updated_at"),
    )


def stg_payments(bronze: DataFrame) -> DataFrame:
    return bronze.where(has_text("payment_id")).select(
        _key("payment_id"),
        _key("order_id"),
        timestamp_of(bronze, "paid_at").alias("paid_at"),
        _low("payment_method"),
        money_of(bronze, "paid_amount").alias("paid_amount"),
        _low("payment_status"),
        timestamp_of(bronze, "updated_at").alias("updated_at"),
    )


def stg_support_tickets(bronze: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    bronze = between_days(bronze, "opened_at", first, last)
    opened_at = timestamp_of(bronze, "opened_at")
    return bronze.where(has_text("ticket_id")).select(
        _key("ticket_id"),
        _key("customer_id"),
        _key("order_id"),
        opened_at.alias("opened_at"),
        F.to_date(opened_at).alias("opened_date"),
        *[_low(c) for c in ("topic", "priority", "status")],
        timestamp_of(bronze, "updated_at").alias("updated_at"),
    )


def order_lines(bronze: DataFrame) -> DataFrame:
    return bronze.where(F.col("order_id").isNotNull() & F.col("product_id").isNotNull()).select(
        _key("order_id"),
        _key("product_id"),
        F.col("quantity").try_cast("int").alias("quantity"),
        *[money_of(bronze, c).alias(c) for c in ("unit_price", "discount_pct", "line_total")],
    )


STAGING = {
    "orders": stg_orders,
    "customers": stg_customers,
    "products": stg_products,
    "sellers": stg_sellers,
    "payments": stg_payments,
    "support_tickets": stg_support_tickets,
    "order_items": order_lines,
}
