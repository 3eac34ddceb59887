"""Column types of the Bronze entities."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(text: str) -> T.StructType:
    return T._parse_datatype_string(text)  # DDL text, no job


DDL = {
    "customers": "customer_id string, full_name string, email string, phone string, city string, region string, "
    "segment string, gender string, age_band string, created_at timestamp, updated_at timestamp",
    "sellers": "seller_id string, seller_name string, region string, channel string, joined_at timestamp, "
    "updated_at timestamp",
    "products": "product_id string, sku string, product_name string, category string, brand string, "
    "unit_price decimal(12,2), cost_amount decimal(12,2), seller_id string, is_active boolean, "
    "created_at timestamp, updated_at timestamp",
    "orders": "order_id string, customer_id string, order_ts timestamp, status string, channel string, "
    "total_amount decimal(12,2), created_at timestamp, updated_at timestamp",
    "order_items": "order_item_id bigint, order_id string, product_id string, quantity int, "
    "unit_price decimal(12,2), discount_pct decimal(5,2), line_total decimal(12,2), updated_at timestamp",
    "payments": "payment_id string, order_id string, paid_at timestamp, payment_method string, "
    "paid_amount decimal(12,2), payment_status string, updated_at timestamp",
    "support_tickets": "ticket_id string, customer_id string, order_id string, opened_at timestamp, topic string, "
    "priority string, status string, updated_at timestamp",
}

KEYS = {
    "customers": ["customer_id"],
    "sellers": ["seller_id"],
    "products": ["product_id"],
    "orders": ["order_id"],
    "order_items": ["order_item_id"],
    "payments": ["payment_id"],
    "support_tickets": ["ticket_id"],
}


def bronze_schema(entity: str, with_dt: bool = True) -> T.StructType:
    return _schema(DDL[entity] + (", dt date" if with_dt else ""))
