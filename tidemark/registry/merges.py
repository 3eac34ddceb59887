"""Upserts, existence joins and deduplication over the shop's entities."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tidemark.operators import key_tree, merge
from tidemark.registry.core import query
from tidemark.registry.ctes import AS_OF
from tidemark.registry.ingest import audit
from tidemark.registry.marts import Planned
from tidemark.schemas import bronze_schema
from tidemark.session import scratch_path
from tidemark.sources import tables
from tidemark.sources.bronze import AUDIT_KEYS, as_declared, write_partitions


@query(
    "customer_id:s full_name:s segment:s",
    """SELECT c.customer_id, c.full_name, c.segment FROM stg_customers c
       WHERE EXISTS (SELECT 1 FROM stg_orders o WHERE o.customer_id = c.customer_id AND o.status = 'refunded')""",
)
def customers_with_orders(b):
    """Customers with at least one refunded order."""
    p = Planned(b)
    return merge.with_match(p.stg("customers"), p.stg("orders").where(F.col("status") == "refunded"), ["customer_id"])


@query(
    "customer_id:s full_name:s segment:s",
    """SELECT c.customer_id, c.full_name, c.segment FROM stg_customers c
       WHERE NOT EXISTS (SELECT 1 FROM stg_orders o WHERE o.customer_id = c.customer_id AND o.status = 'refunded')""",
)
def customers_without_orders(b):
    """Customers without any refunded order."""
    p = Planned(b)
    return merge.without_match(p.stg("customers"), p.stg("orders").where(F.col("status") == "refunded"), ["customer_id"])


@query(
    "customer_id:s recency_days:i churn_label:i gender:s age_band:s",
    """SELECT f.customer_id, f.recency_days, f.churn_label, c.gender, c.age_band
       FROM customer_features f LEFT JOIN (SELECT * FROM dim_customer WHERE is_current = 1) c ON c.customer_id = f.customer_id""",
)
def left_any_join(b):
    p = Planned(b)
    versions = p.dim_customer().select("customer_id", "is_current", "version", "gender", "age_band")
    return merge.left_any_join(p.features(), versions, "customer_id", ["is_current", "version"])


def twice_extracted(orders):
    """Bronze orders in which every fifth order came again two days later with a new status."""
    number = F.substring("order_id", 5, 30).cast("bigint")
    again = orders.where(number % 5 == 0).select(
        *[c for c in orders.columns if c not in ("status", "updated_at", "dt")],
        F.lit("delivered").alias("status"),
        F.date_add("dt", 2).cast("timestamp").alias("updated_at"),
        F.date_add("dt", 2).alias("dt"),
    )
    first = orders.withColumn("updated_at", F.col("updated_at").cast("timestamp"))
    return first.unionByName(again)


@query(
    "order_id:s status:s updated_at:s dt:s",
    """SELECT order_id, status, updated_at, dt FROM (
         SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC, dt DESC) AS rn FROM (
           SELECT order_id, status, CAST(updated_at AS TIMESTAMP) AS updated_at, dt FROM b_orders
           UNION ALL
           SELECT order_id, 'delivered', CAST(dt + 2 AS TIMESTAMP), dt + 2 FROM b_orders WHERE n % 5 = 0))
       WHERE rn = 1""",
)
def dedup_latest(b):
    return merge.dedup_latest(twice_extracted(b.orders()), ["order_id"])


@query(
    "order_id:s status:s order_date:s",
    f"""SELECT order_id, status, order_date FROM stg_orders WHERE order_date < {AS_OF} - 90
        UNION ALL
        SELECT order_id, 'delivered', order_date FROM stg_orders WHERE order_date >= {AS_OF} - 90""",
)
def merge_delete_insert(b):
    """The last 90 days arrive again as delivered and replace what was loaded."""
    orders = Planned(b).stg("orders").select("order_id", "status", "order_date")
    batch = orders.where(F.col("order_date") >= F.lit(b.as_of - timedelta(days=90))).withColumn("status", F.lit("delivered"))
    return merge.delete_insert(orders, batch, ["order_id"])


@query(
    "customer_id:s full_name:s",
    """SELECT customer_id, CASE WHEN n % 3 = 0 THEN 'new ' || full_name ELSE full_name END AS full_name FROM b_customers""",
)
def insert_ignore(b):
    """Two thirds of the customers are loaded; a batch of all adds the rest and changes nothing else."""
    customers = b.customers().select("customer_id", "full_name")
    number = F.substring("customer_id", 5, 30).cast("bigint")
    batch = customers.withColumn("full_name", F.concat(F.lit("new "), F.col("full_name")))
    return merge.insert_ignore(customers.where(number % 3 != 0), batch, ["customer_id"])


@query(
    "run_id:s entity:s dt:s rows_read:i",
    f"""SELECT run_id, entity, dt, CASE WHEN dt >= {AS_OF} - 30 THEN rows_read + 1 ELSE rows_read END AS rows_read
        FROM ingest_audit""",
)
def audit_upsert(b):
    """Audit rows of the last 30 days are written again with a corrected count."""
    rows = audit(b).select("run_id", "entity", "dt", "rows_read")
    batch = rows.where(F.col("dt") >= F.lit(b.as_of - timedelta(days=30))).withColumn("rows_read", F.col("rows_read") + 1)
    return merge.delete_insert(rows, batch, AUDIT_KEYS)


@query(
    "order_id:s",
    """SELECT order_id FROM b_orders t
       WHERE NOT EXISTS (SELECT 1 FROM b_orders s WHERE s.order_id = t.order_id AND s.n % 1009 <> 7)""",
)
def deleted_keys(b):
    """The source lost a few orders; Bronze still has them."""
    bronze, number = b.orders(), F.substring("order_id", 5, 30).cast("bigint")
    return key_tree.deleted_keys(bronze.where(number % 1009 != 7), bronze, ["order_id"])


@query(
    "category:s products:i price_sum:d",
    """SELECT category, count(*) AS products, sum(unit_price) AS price_sum FROM b_products t
       WHERE EXISTS (SELECT 1 FROM b_products s WHERE s.product_id = t.product_id AND s.n % 41 <> 7) GROUP BY category""",
)
def bronze_after_deletes(b):
    """Products that the source lost go from the stored table; only partitions that hold one are written again."""
    stored = as_declared(b.products(), "products")
    path, number = scratch_path(b.spark, "deletes"), F.substring("product_id", 5, 30).cast("bigint")
    write_partitions(stored, path, "category")
    schema = bronze_schema("products")
    held = b.spark.read.schema(schema).parquet(path)
    gone = key_tree.deleted_keys(b.products().where(number % 41 != 7), held, ["product_id"])
    key_tree.apply_deletes(path, gone, ["product_id"], "category", schema)
    left = b.spark.read.schema(schema).parquet(path)
    return left.groupBy("category").agg(F.count(F.lit(1)).alias("products"), F.sum("unit_price").alias("price_sum"))


@query(
    "dt:s products:i price_sum:d",
    f"""SELECT dt, count(*) AS products, sum(unit_price) AS price_sum
        FROM (SELECT CASE WHEN n % 90 = 7 THEN {AS_OF} + 1 ELSE dt END AS dt,
                     CASE WHEN n % 90 = 7 THEN unit_price + 1 ELSE unit_price END AS unit_price FROM b_products)
        GROUP BY dt""",
)
def upsert_moved_keys(b):
    """Half of one day's products come again a day after the last: the table's key filters name the partition to look in."""
    path, number = scratch_path(b.spark, "moved"), F.substring("product_id", 5, 30).cast("bigint")
    merged = lambda held, batch: merge.delete_insert(held, batch, ["product_id"])
    stored = as_declared(b.products(), "products")
    tables.upsert(stored, path, ["product_id"], "dt", merged, indexed=True)
    raised = stored.where(number % 90 == 7).withColumn("unit_price", (F.col("unit_price") + 1).cast("decimal(12,2)"))
    batch = raised.withColumn("dt", F.date_add(F.lit(b.as_of), 1))
    tables.upsert(batch.select(*stored.columns), path, ["product_id"], "dt", merged, indexed=True)
    held = b.spark.read.schema(stored.schema).parquet(path)
    return held.groupBy("dt").agg(F.count(F.lit(1)).alias("products"), F.sum("unit_price").alias("price_sum"))
