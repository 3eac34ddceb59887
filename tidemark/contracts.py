"""Data contracts and declared tests of the Gold tables."""

from __future__ import annotations

from tidemark.operators.quality import CRITICAL, WARN, Check, Contract

MONEY = "decimal(18,2)"
DAY_MINUTES = 1440

# Columns, test ids and limits agreed with the consumers of the tables.
FCT_ORDERS = Contract(
    "marts.fct_orders",
    (
        ("order_id", "string", False),
        ("product_id", "string", False),
        ("customer_id", "string", False),
        ("date_key", "int", False),
        ("order_date", "date", False),
        ("ordered_at", "timestamp", False),
        ("status", "string", False),
        ("channel", "string", False),
        ("seller_id", "string", True),
        ("product_sk", "string", True),
        ("category", "string", True),
        ("brand", "string", True),
        ("quantity", "int", False),
        ("unit_price", MONEY, False),
        ("discount_pct", MONEY, False),
        ("line_total", MONEY, False),
        ("total_amount", MONEY, False),
        ("gross_margin", MONEY, True),
        ("margin_rate", "double", True),
        ("updated_at", "timestamp", False),
    ),
    (
        Check("unique_combination", ("order_id", "product_id"), CRITICAL, "fct_orders_pk_unica"),
        Check("not_null", ("order_id",), CRITICAL, "fct_orders_pedido_no_nulo"),
        Check("not_null", ("product_id",), CRITICAL, "fct_orders_producto_no_nulo"),
        Check("not_null", ("customer_id",), CRITICAL, "fct_orders_fk_customer"),
        Check("not_null", ("date_key",), CRITICAL, "fct_orders_fk_date"),
        Check("accepted_range", ("total_amount",), CRITICAL, "fct_orders_rango_importe", min=0),
        Check("accepted_range", ("quantity",), WARN, "fct_orders_rango_cantidad", min=1),
        Check("freshness", ("ordered_at",), WARN, "fct_orders_frescura", minutes=DAY_MINUTES),
    ),
)

DIM_CUSTOMER = Contract(
    "marts.dim_customer",
    (
        ("customer_sk", "string", False),
        ("customer_id", "string", False),
        ("full_name", "string", False),
        ("email_hash", "string", False),
        ("phone_masked", "string", True),
        ("city", "string", False),
        ("region", "string", False),
        ("segment", "string", False),
        ("gender", "string", True),
        ("age_band", "string", True),
        ("valid_from", "date", False),
        ("valid_to", "date", False),
        ("is_current", "int", False),
        ("version", "int", False),
        ("version_days", "int", False),
        ("updated_at", "timestamp", False),
    ),
    (
        Check("unique", ("customer_sk",), CRITICAL, "dim_customer_pk_unica"),
        Check("not_null", ("customer_id",), CRITICAL, "dim_customer_natural_id"),
        Check("not_null", ("valid_from",), CRITICAL, "dim_customer_scd2_vigente"),
        Check("freshness", ("updated_at",), WARN, "dim_customer_frescura", minutes=DAY_MINUTES),
    ),
)

CUSTOMER_FEATURES = Contract(
    "marts.customer_features",
    (
        ("customer_id", "string", False),
        ("report_date", "date", False),
        ("recency_days", "int", False),
        ("orders_last_30d", "int", False),
        ("monetary_365d", MONEY, False),
        ("avg_ticket", MONEY, False),
        ("tickets_support_90d", "int", False),
        ("churn_label", "int", False),
        ("orders_total", "int", False),
        ("first_order_date", "date", False),
        ("last_order_date", "date", False),
        ("updated_at", "timestamp", False),
    ),
    (
        Check("unique", ("customer_id",), CRITICAL, "features_pk_unica"),
        Check("not_null", ("customer_id",), CRITICAL, "features_fk_customer"),
        Check("not_null", ("churn_label",), CRITICAL, "features_etiqueta_nula"),
        Check("accepted_range", ("recency_days",), CRITICAL, "features_recency_rango", min=0),
        Check("accepted_range", ("monetary_365d",), CRITICAL, "features_monetary_rango", min=0),
        Check("accepted_range", ("avg_ticket",), CRITICAL, "features_avg_ticket_rango", min=0),
        Check("accepted_range", ("avg_ticket",), WARN, "features_avg_ticket_inactivo", min=0.01),
        Check("freshness", ("updated_at",), WARN, "features_frescura", minutes=DAY_MINUTES),
    ),
)

CONTRACTS = (FCT_ORDERS, DIM_CUSTOMER, CUSTOMER_FEATURES)

ORDER_STATUSES = ("pending", "paid", "shipped", "delivered", "cancelled", "refunded")

# Column tests per mart; `critical` ones gate publication.
TESTS: dict[str, tuple[Check, ...]] = {
    "dim_date": (Check("unique", ("date_key",), WARN), Check("not_null", ("date_key",), WARN)),
    "dim_customer": (
        Check("unique", ("customer_sk",)),
        Check("not_null", ("customer_sk",)),
        Check("not_null", ("customer_id",), WARN),
        Check("not_null", ("email_hash",), WARN),
        Check("not_null", ("valid_from",), WARN),
        Check("not_null", ("updated_at",), WARN),
        Check("accepted_values", ("is_current",), WARN, values=(0, 1)),
    ),
    "dim_product": (
        Check("unique", ("product_sk",)),
        Check("not_null", ("product_sk",)),
        Check("unique", ("product_id",), WARN),
        Check("not_null", ("product_id",), WARN),
        Check("accepted_range", ("category_priority",), WARN, min=1, max=5),
        Check("accepted_range", ("unit_margin",), WARN, min=-1000000),
    ),
    "dim_seller": (
        Check("unique", ("seller_sk",), WARN),
        Check("not_null", ("seller_sk",), WARN),
        Check("unique", ("seller_id",), WARN),
        Check("not_null", ("seller_id",), WARN),
    ),
    "fct_orders": (
        Check("not_null", ("order_id",)),
        Check("not_null", ("product_id",)),
        Check("not_null", ("customer_id",)),
        Check("not_null", ("date_key",)),
        Check("accepted_range", ("total_amount",), WARN, min=0),
        Check("not_null", ("line_total",), WARN),
        Check("accepted_range", ("line_total",), WARN, min=0),
        Check("accepted_values", ("status",), WARN, values=ORDER_STATUSES),
    ),
    "fct_payments": (
        Check("unique", ("payment_id",)),
        Check("not_null", ("payment_id",)),
        Check("not_null", ("order_id",)),
        Check("not_null", ("paid_amount",), WARN),
        Check("accepted_range", ("paid_amount",), WARN, min=0),
    ),
    "customer_features": (
        Check("unique", ("customer_id",)),
        Check("not_null", ("customer_id",)),
        Check("accepted_range", ("recency_days",), WARN, min=0),
        Check("accepted_range", ("orders_last_30d",), WARN, min=0),
        Check("accepted_range", ("monetary_365d",), WARN, min=0),
        Check("accepted_range", ("avg_ticket",), WARN, min=0),
        Check("accepted_range", ("tickets_support_90d",), WARN, min=0),
        Check("not_null", ("churn_label",), WARN),
        Check("accepted_values", ("churn_label",), WARN, values=(0, 1)),
    ),
}

# Relationships (fact, foreign key, dimension, primary key).
RELATIONSHIPS = (
    ("fct_orders", "customer_id", "dim_customer", "customer_id"),
    ("fct_orders", "date_key", "dim_date", "date_key"),
    ("fct_orders", "product_sk", "dim_product", "product_sk"),
    ("fct_payments", "order_id", "fct_orders", "order_id"),
    ("fct_payments", "date_key", "dim_date", "date_key"),
)

# Days kept per kind of data.
RETENTION_DAYS = {
    "session_events": 30,
    "routing_decisions": 90,
    "ingest_audit": 365,
    "bronze": 90,
    "silver": 365,
    "gold": 365,
    "model_artifacts": 730,
}


def tests_of_type(kind: str) -> list[tuple[str, Check]]:
    return [(table, c) for table, checks in TESTS.items() for c in checks if c.type == kind]


def critical_tests(table: str) -> list[Check]:
    return [c for c in TESTS[table] if c.severity == CRITICAL]
