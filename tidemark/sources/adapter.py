"""Benchmark tables (customer, orders, lineitem, ...) read as the shop's Bronze entities.

Every column is a fixed expression of the source row, so an independent SQL engine can derive
the same entities. Only narrow projections here: no shuffle, and Catalyst prunes the scans.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.columns import pad_sql, pick_sql

AS_OF = date(2001, 8, 2)

# Domains of the enumerated columns.
CITIES = ("Madrid", "Barcelona", "Valencia", "Sevilla", "Bilbao", "Malaga", "Zaragoza", "Murcia")
CITY_REGIONS = ("centro", "noreste", "este", "sur", "norte", "sur", "noreste", "sureste")
SEGMENTS = ("retail", "pyme", "enterprise")
GENDERS = ("f", "m", "x")
AGE_BANDS = ("18-24", "25-34", "35-44", "45-54", "55+")
SELLER_REGIONS = ("norte", "sur", "centro", "este", "oeste")
SELLER_CHANNELS = ("marketplace", "directo", "partner")
ORDER_CHANNELS = ("web", "app", "phone")
PAYMENT_METHODS = ("card", "transfer", "wallet", "cash")
TICKET_TOPICS = ("envio", "facturacion", "devolucion", "producto", "cuenta")
TICKET_PRIORITIES = ("low", "medium", "high")
TICKET_STATUSES = ("open", "in_progress", "resolved", "closed")
CATEGORY_BY_TYPE = {
    "ECONOMY": "electronica",
    "SMALL": "hogar",
    "MEDIUM": "moda",
    "PROMO": "deportes",
    "STANDARD": "libros",
}
SELLER_SLOTS = 97
EVENT_SHIFT_DAYS = 8217


class Bronze:
    """The seven entities over one folder of benchmark tables."""

    def __init__(self, spark: SparkSession, base: str, as_of: date = AS_OF):
        self.spark, self.base, self.as_of = spark, base.rstrip("/"), as_of
        self._raw: dict[str, DataFrame] = {}

    def raw(self, table: str) -> DataFrame:
        """A benchmark table, scanned alike at every size."""
        if table not in self._raw:
            self._raw[table] = self.spark.read.parquet(f"{self.base}/{table}.parquet")
        return self._raw[table]

    def _ago(self, days: str) -> str:
        return f"cast(date_sub(DATE '{self.as_of}', cast({days} as int)) as timestamp)"

    def _entity(self, table: str, *columns: str, where: str = "true") -> DataFrame:
        return self.raw(table).where(where).selectExpr(*columns).selectExpr("*", "to_date(updated_at) AS dt")

    def orders(self) -> DataFrame:
        odd = "o_orderkey % 2"
        return self._entity(
            "orders",
            f"{pad_sql('ORD-', 'o_orderkey', 9)} AS order_id",
            f"{pad_sql('CUS-', 'o_custkey', 7)} AS customer_id",
            "o_orderdate AS order_ts",
            f"""CASE o_orderstatus WHEN 'O' THEN {pick_sql(('pending', 'paid'), odd)}
                WHEN 'F' THEN {pick_sql(('shipped', 'delivered'), odd)}
                ELSE {pick_sql(('cancelled', 'refunded'), odd)} END AS status""",
            f"{pick_sql(ORDER_CHANNELS, 'o_orderkey % 3')} AS channel",
            "cast(o_totalprice as decimal(12,2)) AS total_amount",
            "o_orderdate AS created_at",
            "o_orderdate AS updated_at",
        )

    def order_items(self) -> DataFrame:
        gross, quantity = "cast(l_extendedprice as decimal(12,2))", "cast(l_quantity as int)"
        unit_cents = f"(cast({gross} * 100 as bigint) * 2 + {quantity}) div ({quantity} * 2)"
        return self._entity(
            "lineitem",
            "l_orderkey * 8 + l_linenumber AS order_item_id",
            f"{pad_sql('ORD-', 'l_orderkey', 9)} AS order_id",
            f"{pad_sql('PRD-', 'l_partkey', 7)} AS product_id",
            f"{quantity} AS quantity",
            f"cast(cast({unit_cents} as decimal(10,0)) * 0.01 as decimal(12,2)) AS unit_price",
            "cast(abs(l_discount) * 100 as decimal(5,2)) AS discount_pct",
            f"cast(round({gross} * (1 - cast(abs(l_discount) as decimal(4,2))), 2) as decimal(12,2)) AS line_total",
            "l_shipdate AS updated_at",
        )

    def products(self) -> DataFrame:
        price = "cast(p_retailprice as decimal(12,2))"
        kinds = " ".join(f"WHEN '{kind}' THEN '{name}'" for kind, name in CATEGORY_BY_TYPE.items())
        return self._entity(
            "part",
            f"{pad_sql('PRD-', 'p_partkey', 7)} AS product_id",
            f"{pad_sql('sku-', 'p_partkey', 7)} AS sku",
            "p_name AS product_name",
            f"CASE p_type {kinds} ELSE 'otros' END AS category",
            "p_brand AS brand",
            f"{price} AS unit_price",
            f"cast(round({price} * 0.62, 2) as decimal(12,2)) AS cost_amount",
            f"{pad_sql('SEL-', f'p_partkey % {SELLER_SLOTS}', 5)} AS seller_id",
            "p_partkey % 17 <> 0 AS is_active",
            f"{self._ago('p_partkey % 300')} AS created_at",
            f"{self._ago('p_partkey % 45')} AS updated_at",
        )

    def sellers(self) -> DataFrame:
        joined = self._ago("(s_suppkey % 5 + 1) * 30")
        return self._entity(
            "supplier",
            f"{pad_sql('SEL-', 's_suppkey', 5)} AS seller_id",
            "s_name AS seller_name",
            f"{pick_sql(SELLER_REGIONS, 's_nationkey % 5')} AS region",
            f"{pick_sql(SELLER_CHANNELS, 's_suppkey % 3')} AS channel",
            f"{joined} AS joined_at",
            f"{joined} AS updated_at",
        )

    def customers(self) -> DataFrame:
        return self._entity(
            "customer",
            f"{pad_sql('CUS-', 'c_custkey', 7)} AS customer_id",
            "c_name AS full_name",
            "concat(' Cliente', cast(c_custkey as string), '@Example.com ') AS email",
            "concat('+34 6', lpad(cast(c_custkey * 7919 % 100000000 as string), 8, '0')) AS phone",
            f"{pick_sql(CITIES, 'c_custkey % 8')} AS city",
            f"{pick_sql(CITY_REGIONS, 'c_custkey % 8')} AS region",
            f"{pick_sql(SEGMENTS, 'c_custkey % 3')} AS segment",
            f"CASE WHEN c_custkey % 11 <> 0 THEN {pick_sql(GENDERS, 'c_custkey % 3')} END AS gender",
            f"{pick_sql(AGE_BANDS, 'c_custkey % 5')} AS age_band",
            "cast(date_add(DATE '1994-06-01', cast(c_custkey % 400 as int)) as timestamp) AS created_at",
            f"{self._ago('c_custkey % 60')} AS updated_at",
        )

    def payments(self) -> DataFrame:
        """One payment two hours after each order."""
        number = "substring(order_id, 5)"
        return self.orders().selectExpr(
            f"concat('PAY-', {number}) AS payment_id",
            "order_id",
            "order_ts + interval 2 hours AS paid_at",
            f"{pick_sql(PAYMENT_METHODS, f'cast({number} as bigint) % 4')} AS payment_method",
            "CASE WHEN status IN ('cancelled', 'refunded') THEN cast(0 as decimal(12,2)) ELSE total_amount END AS paid_amount",
            """CASE WHEN status = 'cancelled' THEN 'rejected' WHEN status IN ('refunded', 'pending') THEN status
               ELSE 'approved' END AS payment_status""",
            "order_ts + interval 2 hours AS updated_at",
            "to_date(order_ts + interval 2 hours) AS dt",
        )

    def support_tickets(self) -> DataFrame:
        opened = f"ts - make_dt_interval({EVENT_SHIFT_DAYS})"
        return self._entity(
            "events",
            f"{pad_sql('TCK-', 'event_id', 9)} AS ticket_id",
            f"{pad_sql('CUS-', 'user_id', 7)} AS customer_id",
            f"CASE WHEN event_id % 4 <> 0 THEN {pad_sql('ORD-', 'event_id', 9)} END AS order_id",
            f"{opened} AS opened_at",
            f"{pick_sql(TICKET_TOPICS, 'event_id % 5')} AS topic",
            f"{pick_sql(TICKET_PRIORITIES, 'event_id % 3')} AS priority",
            f"{pick_sql(TICKET_STATUSES, 'event_id % 4')} AS status",
            f"{opened} AS updated_at",
            where="event_type = 'error'",
        )

    def entity(self, name: str) -> DataFrame:
        return getattr(self, name)()
