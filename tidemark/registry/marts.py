"""Staging, intermediate and mart queries."""

from __future__ import annotations

from contextlib import ExitStack
from datetime import date, timedelta
from functools import cached_property, reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.contracts import RELATIONSHIPS
from tidemark.functions.columns import pick
from tidemark.operators import history, merge
from tidemark.operators.staging import STAGING
from tidemark.plans import jobs, marts
from tidemark.registry.core import query
from tidemark.registry.ctes import AS_OF
from tidemark.session import LEAN, scratch_path, scratch_scope, settings, settle
from tidemark.sources import adapter, layout, tables
from tidemark.sources.bronze import write_partitions
from tidemark.sources.adapter import Bronze

CAL_START = date(1995, 1, 1)
ROUNDS = 8  # a stored fact is written in so many parts, so that shuffles of a part of it are on disk at once


class Planned:
    """Conformed entities and marts over one bronze source, planned on first use."""

    def __init__(self, b: Bronze):
        self.b, self.as_of = b, b.as_of
        self._stg: dict[tuple, DataFrame] = {}

    def stg(self, entity: str, **bounds) -> DataFrame:
        key = (entity, *sorted(bounds.items()))
        if key not in self._stg:
            self._stg[key] = STAGING[entity](self.b.entity(entity), **bounds)
        return self._stg[key]

    @cached_property
    def calendar(self) -> DataFrame:
        return marts.dim_date(self.b.spark, self.as_of, CAL_START)

    def sales(self, **bounds) -> DataFrame:
        return marts.sales_lines(self.stg("orders", **bounds), self.stg("order_items"), self.calendar)

    def fct_orders(self, since: date | None = None, keep=None, **bounds) -> DataFrame:
        return marts.fct_orders(
            self.stg("orders", **bounds), self.stg("order_items"), self.stg("products"), self.calendar, since, keep=keep
        )

    def fct_payments(self, since: date | None = None) -> DataFrame:
        return marts.fct_payments(self.stg("payments"), self.stg("orders"), self.calendar, since)

    def dim_customer(self, **options) -> DataFrame:
        return marts.dim_customer(self.stg("customers"), self.stg("orders"), **options)

    def dim_product(self) -> DataFrame:
        return marts.dim_product(
            self.stg("products"), self.stg("orders"), self.stg("order_items"), marts.category_map(self.b.spark)
        )

    def dim_seller(self) -> DataFrame:
        return marts.dim_seller(self.stg("sellers"), self.stg("products"), self.as_of)

    def features(self, days_ago: int = 0, **options) -> DataFrame:
        day = self.as_of - timedelta(days=days_ago)
        return marts.customer_features(
            self.sales(first=day - timedelta(days=365), last=day),
            self.stg("support_tickets", first=day - timedelta(days=90), last=day),
            day,
            **options,
        )

    def two_snapshots(self, days_ago: int) -> tuple[DataFrame, DataFrame]:
        """Features `days_ago` and today over one settled pass of the orders."""
        then = self.as_of - timedelta(days=days_ago)
        first = then - timedelta(days=365)
        values = settle(marts.order_values(self.sales(first=first, last=self.as_of)), "order-values")
        tickets = self.stg("support_tickets", first=then - timedelta(days=90), last=self.as_of)
        return tuple(marts.features_of_orders(values, tickets, day) for day in (then, self.as_of))


STG_ORDERS = (
    "order_id:s customer_id:s ordered_at:s status:s channel:s total_amount:d order_date:s updated_at:s ingested_dt:s"
)


@query(STG_ORDERS, "SELECT * FROM stg_orders")
def stg_orders(b):
    return Planned(b).stg("orders")


@query(
    "customer_id:s full_name:s email_hash:s phone_masked:s city:s region:s segment:s gender:s age_band:s created_at:s updated_at:s",
    "SELECT * FROM stg_customers",
)
def stg_customers(b):
    return Planned(b).stg("customers")


@query(
    "product_id:s sku:s product_name:s category:s brand:s unit_price:d cost_amount:d seller_id:s is_active:i updated_at:s",
    "SELECT * FROM stg_products",
)
def stg_products(b):
    return Planned(b).stg("products")


@query("seller_id:s seller_name:s region:s channel:s joined_at:s updated_at:s", "SELECT * FROM stg_sellers")
def stg_sellers(b):
    return Planned(b).stg("sellers")


@query(
    "payment_id:s order_id:s paid_at:s payment_method:s paid_amount:d payment_status:s updated_at:s",
    "SELECT * FROM stg_payments",
)
def stg_payments(b):
    return Planned(b).stg("payments")


@query(
    "ticket_id:s customer_id:s order_id:s opened_at:s opened_date:s topic:s priority:s status:s updated_at:s",
    "SELECT * FROM stg_support_tickets",
)
def stg_support_tickets(b):
    return Planned(b).stg("support_tickets")


@query(
    "order_id:s product_id:s quantity:i unit_price:d discount_pct:d line_total:d", "SELECT * FROM order_lines"
)
def order_lines(b):
    return Planned(b).stg("order_items")


@query(
    "order_id:s product_id:s customer_id:s ordered_at:s order_date:s status:s channel:s order_total_amount:d quantity:i "
    "unit_price:d discount_pct:d line_total:d product_name:s sku:s category:s brand:s cost_amount:d seller_id:s "
    "seller_name:s seller_region:s seller_channel:s updated_at:s ingested_dt:s",
    "SELECT * FROM int_orders_enriched",
)
def int_orders_enriched(b):
    p = Planned(b)
    return marts.int_orders_enriched(p.stg("orders"), p.stg("order_items"), p.stg("products"), p.stg("sellers"))


@query(
    "category:s segment:s priority:i products:i",
    """SELECT p.category, c.segment, c.priority, count(*) AS products
       FROM stg_products p LEFT JOIN category_lookup c ON c.category = p.category
       GROUP BY p.category, c.segment, c.priority""",
)
def category_map(b):
    """The seed lookup over the whole catalogue: a category without a line keeps NULLs."""
    counts = Planned(b).stg("products").groupBy("category").agg(F.count(F.lit(1)).alias("products"))
    return counts.join(F.broadcast(marts.category_map(b.spark)), "category", "left")


@query(
    "date_key:i date_day:s year:i quarter:i year_quarter:s month:i year_month:s day_of_month:i day_of_week:i day_name:s "
    "iso_week:i day_of_year:i is_weekend:i",
    """SELECT * FROM dim_date
       WHERE date_day BETWEEN (SELECT CAST(date_trunc('year', min(o_orderdate)) AS DATE) FROM orders)
         AND (SELECT CAST(max(o_orderdate) AS DATE) + 1 + INTERVAL 2 YEAR FROM orders)""",
)
def dim_date(b):
    """Calendar from the year of the first order to two years after the last."""
    bounds = Planned(b).stg("orders").agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi")).first()
    return marts.dim_date(b.spark, bounds.hi + timedelta(days=1), bounds.lo.replace(month=1, day=1))


@query(
    "customer_id:s first_order_at:s last_order_at:s orders_count:i", "SELECT * FROM customer_activity"
)
def customer_activity(b):
    return marts.customer_activity(Planned(b).stg("orders"))


DIM_CUSTOMER = (
    "customer_sk:s customer_id:s full_name:s email_hash:s phone_masked:s city:s region:s segment:s gender:s age_band:s "
    "valid_from:s valid_to:s is_current:i version:i updated_at:s version_days:i"
)


@query(DIM_CUSTOMER, "SELECT * FROM dim_customer")
def dim_customer(b):
    return Planned(b).dim_customer()


@query(DIM_CUSTOMER, "SELECT * FROM dim_customer WHERE valid_to >= valid_from")
def dim_customer_fixed(b):
    return Planned(b).dim_customer(drop_empty=True)


@query(
    "product_sk:s product_id:s sku:s product_name:s category:s category_segment:s category_priority:i brand:s "
    "list_price:d cost_amount:d unit_margin:d margin_rate:d seller_id:s updated_at:s last_ingested_dt:s",
    "SELECT * FROM dim_product",
)
def dim_product(b):
    return Planned(b).dim_product()


@query(
    "seller_sk:s seller_id:s seller_name:s region:s channel:s joined_at:s tenure_days:i products_count:i "
    "last_product_update:s",
    "SELECT * FROM dim_seller",
)
def dim_seller(b):
    return Planned(b).dim_seller()


FCT_ORDERS = (
    "order_id:s product_id:s customer_id:s date_key:i order_date:s ordered_at:s status:s channel:s seller_id:s "
    "product_sk:s category:s brand:s quantity:i unit_price:d discount_pct:d line_total:d total_amount:d gross_margin:d "
    "margin_rate:d updated_at:s"
)


@query(FCT_ORDERS, "SELECT * FROM fct_orders")
def fct_orders(b):
    return Planned(b).fct_orders()


@query(
    "payment_id:s order_id:s customer_id:s date_key:i paid_date:s paid_at:s payment_method:s payment_status:s "
    "paid_amount:d order_status:s amount_gap:d is_approved:i updated_at:s",
    "SELECT * FROM fct_payments",
)
def fct_payments(b):
    return Planned(b).fct_payments()


FEATURES = (
    "customer_id:s report_date:s recency_days:i orders_last_30d:i monetary_365d:d avg_ticket:d tickets_support_90d:i "
    "churn_label:i orders_total:i first_order_date:s last_order_date:s updated_at:s"
)


@query(FEATURES, "SELECT * FROM customer_features")
def customer_features(b):
    return Planned(b).features()


@query(
    "customer_id:s orders_last_30d:i",
    "SELECT customer_id, orders_in_30d AS orders_last_30d FROM customer_features",
)
def customer_features_by_order(b):
    """The documented meaning of the 30-day count: orders instead of lines."""
    return Planned(b).features(grain="order")


@query(
    "customer_id:s recency_days:i orders_total:i churn_label:i",
    f"""SELECT f.customer_id, f.recency_days, f.orders_total,
               CASE WHEN EXISTS (SELECT 1 FROM stg_orders o WHERE o.customer_id = f.customer_id
                      AND o.status NOT IN ('cancelled', 'refunded') AND o.order_id IN (SELECT order_id FROM order_lines)
                      AND o.order_date > {AS_OF} - 180 AND o.order_date <= {AS_OF}) THEN 0 ELSE 1 END AS churn_label
        FROM features_halfyear f""",
)
def features_point_in_time(b):
    """Features half a year ago, labelled by the orders since then."""
    p = Planned(b)
    cutoff = b.as_of - timedelta(days=180)
    sales = p.sales(first=cutoff - timedelta(days=365), last=b.as_of)
    return marts.point_in_time_features(sales, p.stg("support_tickets", last=cutoff), cutoff)


@query(
    "order_id:s product_id:s customer_id:s order_date:s line_total:d customer_sk:s",
    """SELECT f.order_id, f.product_id, f.customer_id, f.order_date, f.line_total, c.customer_sk
       FROM fct_orders f LEFT JOIN dim_customer c
         ON c.customer_id = f.customer_id AND f.order_date BETWEEN c.valid_from AND c.valid_to""",
)
def fct_orders_customer_sk(b):
    p = Planned(b)
    return marts.customer_versions(p.sales(), p.dim_customer())


def customer_days(b: Bronze) -> DataFrame:
    """Customers as extracted when created and on every day they order, with the city and segment of that day."""
    customers = b.customers()
    number = F.substring("customer_id", 5, 30).cast("bigint")
    orders = b.orders().select("customer_id", F.substring("order_id", 5, 30).cast("bigint").alias("extract_no"), "updated_at", "dt")
    fixed = customers.select("customer_id", "full_name", "gender", "age_band", number.alias("n"))
    place, kind = ("cast((n + if(extract_no % {} = 0, 1, 0)) % {} as int)".format(*x) for x in ((3, 8), (5, 3)))
    moved = fixed.join(orders, "customer_id").select(
        "customer_id", "full_name", "gender", "age_band", pick(adapter.CITIES, place).alias("city"),
        pick(adapter.CITY_REGIONS, place).alias("region"), pick(adapter.SEGMENTS, kind).alias("segment"),
        F.col("updated_at").cast("timestamp").alias("updated_at"), "extract_no", "dt",
    )
    first = customers.select(
        "customer_id", "full_name", "gender", "age_band", "city", "region", "segment",
        F.col("created_at").alias("updated_at"), F.lit(-1).cast("bigint").alias("extract_no"), F.to_date("created_at").alias("dt"),
    )
    return moved.unionByName(first)


def customer_history(b: Bronze) -> DataFrame:
    tracked, fixed = ["city", "region", "segment"], ["full_name", "gender", "age_band"]
    return history.versions(customer_days(b), "customer_id", tracked, order=["updated_at", "extract_no"], kept=fixed)


@query(
    "version_sk:s customer_id:s full_name:s city:s region:s segment:s gender:s age_band:s valid_from:s valid_to:s version:i is_current:i",
    "SELECT * FROM dim_customer_history",
)
def dim_customer_history(b):
    """A version for each run of days with the same city, region and segment."""
    return customer_history(b)


@query(
    "order_id:s product_id:s customer_id:s order_date:s city:s segment:s version:i",
    """SELECT f.order_id, f.product_id, f.customer_id, f.order_date, h.city, h.segment, h.version
       FROM fct_orders f LEFT JOIN dim_customer_history h
         ON h.customer_id = f.customer_id AND f.order_date BETWEEN h.valid_from AND h.valid_to""",
)
def fct_orders_history(b):
    """Order lines with the customer's attributes as they were on the order date."""
    versions = customer_history(b).withColumnRenamed("version_sk", "customer_sk")
    found = marts.customer_versions(Planned(b).sales(), versions)
    at = versions.select("customer_sk", "city", "segment", "version")
    return found.join(at, "customer_sk", "left")


@query(
    "order_id:s product_id:s customer_id:s order_date:s line_total:d",
    """SELECT order_id, product_id, customer_id, order_date, line_total FROM fct_orders
       WHERE customer_id BETWEEN 'CUS-0000400' AND 'CUS-0000480'""",
)
def fct_orders_z_ordered(b):
    """A range of customers, the second key, from a fact in Z-order: other files are skipped by their bounds."""
    path, keys = scratch_path(b.spark, "z-ordered"), ["order_date", "customer_id"]
    with settings(b.spark, LEAN):
        with ExitStack() as lines, ExitStack() as facts:  # each is deleted when it was read for the last time
            lines.enter_context(scratch_scope(b.spark))
            planned = Planned(b).fct_orders(keep=lambda sales: settle(sales, "sales"))
            facts.enter_context(scratch_scope(b.spark))
            fact = settle(planned, "fact", "order_id", ROUNDS // 2)
            lines.close()
            layout.write_z_ordered(fact, path, keys, files=32, rounds=ROUNDS, read=facts.close)
        bounds = settle(layout.file_bounds(b.spark, path, keys), "file_bounds")
    return layout.read_within(b.spark, path, bounds, {"customer_id": ("CUS-0000400", "CUS-0000480")})


LOADED = f"{AS_OF} - 10"


@query(
    "order_id:s product_id:s order_date:s line_total:d gross_margin:d",
    f"""SELECT order_id, product_id, order_date, line_total, gross_margin FROM fct_orders
        WHERE order_date < {LOADED}
          AND order_id NOT IN (SELECT order_id FROM fct_orders WHERE order_date >=
                               (SELECT max(order_date) FROM fct_orders WHERE order_date < {LOADED}))
        UNION ALL
        SELECT order_id, product_id, order_date, line_total, gross_margin FROM fct_orders
        WHERE order_date >= (SELECT max(order_date) FROM fct_orders WHERE order_date < {LOADED})""",
)
def fct_orders_incremental(b):
    """A fact loaded up to ten days ago, brought up to date from its last business day on."""
    p = Planned(b)
    cutoff = b.as_of - timedelta(days=10)
    loaded = p.fct_orders(last=cutoff - timedelta(days=1))
    since = tables.high_water(p.sales(last=cutoff - timedelta(days=1)), "order_date")
    return merge.delete_insert(loaded, p.fct_orders(since=since, first=since), ["order_id"])


def refreshed(b: Bronze, name: str, build, keys: list[str], day: str, rounds: int = 1) -> DataFrame:
    """A fact stored by month: loaded up to ten days ago, in `rounds`, then refreshed from its own last business day.

    What `build` settles is deleted after each of the two.
    """
    path, cutoff = scratch_path(b.spark, name), b.as_of - timedelta(days=10)

    def monthly(until):
        return lambda since: build(since).where(F.col(day) <= F.lit(until)).withColumn("month", F.date_format(day, "yyyy-MM"))

    with scratch_scope(b.spark):
        jobs.refresh_fact(b.spark, path, monthly(cutoff), keys, "month", day, rounds=rounds)
    with scratch_scope(b.spark):
        jobs.refresh_fact(b.spark, path, monthly(b.as_of), keys, "month", day, moving=False, rounds=rounds)
    return b.spark.read.parquet(path)


@query(
    "order_id:s product_id:s order_date:s quantity:i line_total:d gross_margin:d month:s",
    f"""SELECT order_id, product_id, order_date, quantity, line_total, gross_margin, strftime(order_date, '%Y-%m') AS month
        FROM fct_orders WHERE order_date <= {AS_OF}""",
)
def fct_orders_stored_refresh(b):
    """The order-line fact; its rounds read the joined lines from a settled table."""
    p = Planned(b)

    def build(since):
        return p.fct_orders(since, keep=None if since else lambda sales: settle(sales, "sales"))

    with settings(b.spark, LEAN):
        return refreshed(b, "fact-orders", build, ["order_id"], "order_date", ROUNDS)


@query(
    "payment_id:s order_id:s paid_date:s paid_amount:d amount_gap:d month:s",
    f"""SELECT payment_id, order_id, paid_date, paid_amount, amount_gap, strftime(paid_date, '%Y-%m') AS month
        FROM fct_payments WHERE paid_date <= {AS_OF}""",
)
def fct_payments_incremental(b):
    return refreshed(b, "fact-payments", Planned(b).fct_payments, ["payment_id"], "paid_date")


@query(
    "customer_id:s report_date:s recency_days:i monetary_365d:d churn_label:i",
    """SELECT customer_id, report_date, recency_days, monetary_365d, churn_label FROM features_before
       UNION ALL SELECT customer_id, report_date, recency_days, monetary_365d, churn_label FROM customer_features""",
)
def features_snapshots(b):
    """Two snapshots stored by report date; the second is stored twice and replaces only itself."""
    p, path = Planned(b), scratch_path(b.spark, "snapshots")
    for days in (30, 0, 0):
        write_partitions(p.features(days_ago=days), path, "report_date")
    return b.spark.read.parquet(path)


@query(
    "customer_id:s report_date:s recency_days:i monetary_365d:d churn_label:i",
    """SELECT customer_id, report_date, recency_days, monetary_365d, churn_label FROM features_before
       WHERE customer_id NOT IN (SELECT customer_id FROM customer_features)
       UNION ALL
       SELECT customer_id, report_date, recency_days, monetary_365d, churn_label FROM customer_features
       WHERE report_date > (SELECT max(report_date) FROM features_before)""",
)
def features_incremental(b):
    """A snapshot 30 days old, replaced customer by customer by today's."""
    p = Planned(b)
    loaded = p.features(days_ago=30)
    fresh = marts.new_snapshot(p.features(), b.as_of - timedelta(days=30))
    return merge.delete_insert(loaded, fresh, ["customer_id"])


def related(p: Planned, name: str, column: str) -> DataFrame:
    """A side of a relationship, with no more work than its key needs."""
    frames = {
        "fct_orders": lambda: p.fct_orders() if column == "product_sk" else p.sales(),
        "fct_payments": p.fct_payments,
        "dim_customer": lambda: p.stg("customers"),  # every staged customer has a version
        "dim_product": p.dim_product,
        "dim_date": lambda: p.calendar,
    }
    return frames[name]()


for _fk, _key in (
    (("fct_orders", "customer_id", "dim_customer", "customer_id"), "fk_orphans_customer"),
    (("fct_orders", "date_key", "dim_date", "date_key"), "fk_orphans_date"),
    (("fct_orders", "product_sk", "dim_product", "product_sk"), "fk_orphans_product"),
    (("fct_payments", "order_id", "fct_orders", "order_id"), "fk_orphans_payment_order"),
    (("fct_payments", "date_key", "dim_date", "date_key"), "fk_orphans_payment_date"),
):

    def _orphans(b, fk=_fk):
        fact, column, dim, pk = fk
        p = Planned(b)
        return merge.orphans(related(p, fact, column), column, related(p, dim, pk), pk)

    query(
        f"{_fk[1]}:{'i' if _fk[1] == 'date_key' else 's'} fact_rows:i",
        f"""SELECT {_fk[1]}, count(*) AS fact_rows FROM {_fk[0]} f
            WHERE {_fk[1]} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {_fk[2]} d WHERE d.{_fk[3]} = f.{_fk[1]})
            GROUP BY {_fk[1]}""",
        key=_key,
    )(_orphans)


KEPT = "substr(md5(CAST({} AS {})), 1, 1) >= '4'"


@query(
    "fact:s fk:s key:s fact_rows:i",
    "\nUNION ALL ".join(
        f"""SELECT '{fact}' AS fact, '{fk}' AS fk, CAST({fk} AS VARCHAR) AS key, count(*) AS fact_rows FROM {fact} f
            WHERE {fk} IS NOT NULL AND NOT EXISTS (
              SELECT 1 FROM {dim} d WHERE d.{pk} = f.{fk} AND {KEPT.format(f'd.{pk}', 'VARCHAR')})
            GROUP BY {fk}"""
        for fact, fk, dim, pk in RELATIONSHIPS
    ),
)
def fk_orphans_planted(b):
    """All relationships against parents of which a quarter was lost."""
    p, parts = Planned(b), []
    for fact, fk, dim, pk in RELATIONSHIPS:
        parents = related(p, dim, pk).where(KEPT.format(pk, "STRING"))
        lost = merge.orphans(related(p, fact, fk), fk, parents, pk)
        parts.append(lost.select(F.lit(fact).alias("fact"), F.lit(fk).alias("fk"), F.col(fk).cast("string").alias("key"), "fact_rows"))
    return reduce(DataFrame.unionByName, parts)
