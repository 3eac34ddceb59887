"""Ingestion queries: windows, watermarks, Bronze partitions, checksums, the stream."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.contracts import RETENTION_DAYS
from tidemark.functions.columns import pick
from tidemark.operators import messages
from tidemark.operators.merge import keep_recent
from tidemark.registry.core import query
from tidemark.registry.ctes import AS_OF, pick as sql_pick, quoted
from tidemark.schemas import KEYS, bronze_schema
from tidemark.session import scratch_path, settle
from tidemark.sources import bronze
from tidemark.sources.adapter import Bronze
from tidemark.streaming.bronze_stream import stream_upsert

# `returns` has no Bronze data and so falls back to the epoch.
ENTITIES = [*KEYS, "returns"]


def audit(b: Bronze) -> DataFrame:
    parts = [bronze.audit_of(b.entity(name), name) for name in KEYS]
    return reduce(DataFrame.unionByName, parts)


def landed(b: Bronze, entity: str, name: str) -> str:
    """Writes a Bronze entity by `dt` to the shared scratch folder; returns its path."""
    path = scratch_path(b.spark, name)
    bronze.write_partitions(bronze.as_declared(b.entity(entity), entity), path)
    return path


@query(
    "order_id:s customer_id:s status:s total_amount:d updated_at:s",
    f"""SELECT order_id, customer_id, status, total_amount, updated_at FROM b_orders
        WHERE updated_at > {AS_OF} - 365 AND updated_at <= {AS_OF}""",
)
def ingest_incremental(b):
    return bronze.extract_window(b.orders(), b.as_of - timedelta(days=365), b.as_of)


@query(
    "entity:s watermark:s",
    f"""SELECT e.entity, coalesce(max(a.watermark), TIMESTAMP '1970-01-01') AS watermark
        FROM (SELECT unnest([{quoted(*ENTITIES)}]) AS entity) e
        LEFT JOIN ingest_audit a ON a.entity = e.entity GROUP BY e.entity""",
)
def watermark_lookup(b):
    return bronze.watermark_lookup(audit(b), ENTITIES)


@query(
    "entity:s last_dt:s rows_read:i",
    "SELECT entity, max(dt) AS last_dt, sum(rows_read) AS rows_read FROM ingest_audit GROUP BY entity",
)
def audit_rollup(b):
    return bronze.audit_rollup(audit(b))


@query(
    "run_id:s entity:s dt:s rows_read:i",
    "SELECT run_id, entity, dt, rows_read FROM ingest_audit ORDER BY dt DESC, entity LIMIT 5",
)
def audit_latest(b):
    return bronze.audit_latest(audit(b))


BY_DAY = "SELECT dt, count(*) AS products, sum(unit_price) AS price_sum FROM b_products GROUP BY dt"


@query("dt:s products:i price_sum:d", BY_DAY)
def bronze_roundtrip(b):
    """Written twice: the second write replaces the partitions of the first."""
    path = landed(b, "products", "roundtrip")
    bronze.write_partitions(b.products(), path)
    return by_day(bronze.scan(b.spark, path, "products"))


def by_day(df: DataFrame) -> DataFrame:
    return df.groupBy("dt").agg(F.count(F.lit(1)).alias("products"), F.sum("unit_price").alias("price_sum"))


@query(
    "product_id:s sku:s unit_price:d dt:s",
    f"SELECT product_id, sku, unit_price, dt FROM b_products WHERE dt BETWEEN {AS_OF} - 20 AND {AS_OF} - 10",
)
def bronze_scan_dt(b):
    path = landed(b, "products", "scan")
    return bronze.scan(b.spark, path, "products", b.as_of - timedelta(days=20), b.as_of - timedelta(days=10))


@query("customer_id:s ingested_dt:s", "SELECT customer_id, dt AS ingested_dt FROM b_customers")
def ingested_dt(b):
    """The date comes from the file path, not from a column."""
    path = landed(b, "customers", "lineage")
    files = b.spark.read.schema(bronze_schema("customers", with_dt=False)).parquet(path)
    return bronze.with_path_date(files)


@query("dt:s rows:i sampled_dt:s", "SELECT dt, count(*) AS rows, dt AS sampled_dt FROM b_customers GROUP BY dt")
def bronze_file_stats(b):
    path = landed(b, "customers", "stats")
    stats = bronze.file_stats(b.spark.read.parquet(path), "dt")
    return stats.withColumn("sampled_dt", F.regexp_extract("sample_path", "dt=([0-9-]{10})", 1))


@query(
    "dt:s rows:i checksum:i",
    """SELECT dt, count(*) AS rows,
              sum(CAST('0x' || substr(md5(concat_ws('|', customer_id, opened_at, order_id, priority, status,
                  ticket_id, topic, updated_at)), 1, 8) AS BIGINT)) AS checksum
       FROM (SELECT dt, customer_id, coalesce(order_id, '~') AS order_id, CAST(epoch_us(opened_at) AS VARCHAR) AS opened_at,
                    priority, status, ticket_id, topic, CAST(epoch_us(updated_at) AS VARCHAR) AS updated_at
             FROM b_support_tickets)
       GROUP BY dt""",
)
def content_checksum(b):
    return bronze.content_checksum(b.support_tickets(), "dt")


@query(
    "dt:s landed:i intact:i",
    "SELECT DISTINCT dt, 1 AS landed, CASE WHEN day(dt) % 2 = 0 THEN 0 ELSE 1 END AS intact FROM b_sellers",
)
def file_checksum(b):
    """Digests of all landed files against those of a manifest taken before even days were rewritten.

    A day is intact if every file of its manifest is still there with the same digest; a day may have any
    number of files.
    """
    path = landed(b, "sellers", "checksum")
    manifest = settle(bronze.file_checksums(b.spark, path), "manifest")
    rewritten = b.sellers().where(F.day("dt") % 2 == 0).withColumn("seller_name", F.upper("seller_name"))
    bronze.write_partitions(bronze.as_declared(rewritten, "sellers"), path)
    now = bronze.file_checksums(b.spark, path).withColumnRenamed("checksum", "now").drop("length")
    day = F.regexp_extract("path", "dt=([0-9-]{10})", 1)
    same = F.col("checksum").eqNullSafe(F.col("now")).cast("int")
    checked = manifest.join(now, "path", "left").groupBy(day.alias("dt"))
    return checked.agg(F.max((F.col("length") > 0).cast("int")).alias("landed"), F.min(same).alias("intact"))


@query("dt:s products:i price_sum:d", BY_DAY)
def backfill_day(b):
    """One day was loaded at double price; its window is read and replaced, other days stay."""
    day = b.as_of - timedelta(days=7)
    path = scratch_path(b.spark, "backfill")
    wrong = F.when(F.col("dt") == F.lit(day), F.col("unit_price") * 2).otherwise(F.col("unit_price"))
    source = b.products()
    bronze.write_partitions(source.withColumn("unit_price", wrong.cast("decimal(12,2)")), path)
    window = bronze.extract_window(source, day - timedelta(days=1), day)
    bronze.write_partitions(window, path)
    return by_day(bronze.scan(b.spark, path, "products"))


@query(
    "order_id:s status:s dt:s",
    f"SELECT order_id, status, dt FROM b_orders WHERE dt >= {AS_OF} - 90",
)
def retention_keep(b):
    return keep_recent(b.orders(), "dt", b.as_of, RETENTION_DAYS["bronze"])


@query(
    "product_id:s category:s unit_price:d dt:s",
    """SELECT product_id, category, CASE WHEN n % 3 = 0 THEN unit_price + 1 ELSE unit_price END AS unit_price,
              CASE WHEN n % 3 = 0 THEN DATE '2001-08-03' ELSE dt END AS dt
       FROM b_products""",
)
def bronze_stream_upsert(b):
    """Two runs of the stream: the first load, then a day on which every third product changed."""
    source, target, state = (scratch_path(b.spark, f"stream-{part}") for part in ("source", "target", "state"))
    first = bronze.as_declared(b.products(), "products")
    schema = bronze_schema("products")

    def run() -> None:
        stream_upsert(
            b.spark, source, schema, target, state, ["product_id"], ["updated_at", "dt"], "category"
        )

    bronze.write_partitions(first, source)
    run()
    later = b.as_of + timedelta(days=1)
    number = F.substring("product_id", 5, 30).cast("bigint")
    changed = first.where(number % 3 == 0).select(
        *[c for c in first.columns if c not in ("unit_price", "updated_at", "dt")],
        (F.col("unit_price") + 1).cast("decimal(12,2)").alias("unit_price"),
        F.lit(later).cast("timestamp").alias("updated_at"),
        F.lit(later).alias("dt"),
    )
    bronze.write_partitions(changed, source)
    run()
    return b.spark.read.schema(schema).parquet(target)


@query(
    "tests_total:i tests_failed:i",
    "SELECT count(*) AS tests_total, count(*) FILTER (WHERE event_type IN ('error', 'signup')) AS tests_failed FROM events",
)
def run_results_summary(b):
    """Result documents of 50 tests each, written as JSON and read back whole."""
    status = (
        F.when(F.col("event_type") == "error", "Error").when(F.col("event_type") == "signup", "fail").otherwise("pass")
    )
    docs = (
        b.raw("events")
        .groupBy(F.expr("event_id div 50").alias("run"))
        .agg(F.collect_list(F.struct(F.col("event_id").alias("unique_id"), status.alias("status"))).alias("results"))
    )
    path = scratch_path(b.spark, "run-results")
    docs.write.json(path)
    schema = "run bigint, results array<struct<unique_id: bigint, status: string>>"
    return messages.run_results_summary(b.spark.read.schema(schema).json(path))


def handoff_messages(b: Bronze) -> DataFrame:
    """One handoff message per event; the event number decides what is wrong with it."""
    n = F.col("event_id")
    fields = F.create_map(
        *[
            x
            for key, value in {
                "run_id": F.when(n % 11 == 0, "run_1").otherwise(F.concat(F.lit("run_2001_"), n.cast("string"))),
                "from": F.when(n % 13 == 0, "nobody").otherwise(pick(messages.AGENTS, "event_id % 7")),
                "to": pick(messages.AGENTS, "(event_id + 1) % 7"),
                "intent": pick(messages.INTENTS, "event_id % 7"),
                "status": F.when(n % 17 == 0, "done").otherwise(pick(messages.STATUSES, "event_id % 3")),
                "next_agent": pick(messages.NEXT_AGENTS, "event_id % 8"),
                "ts": F.when(n % 19 == 0, "yesterday").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
            }.items()
            for x in (F.lit(key), value)
        ]
    )
    kept = F.map_filter(fields, lambda k, v: (k != "to") | (n % 23 != 0))
    with_extra = F.when(n % 29 == 0, F.map_concat(kept, F.create_map(F.lit("note"), F.lit("x")))).otherwise(kept)
    head = F.to_json(with_extra)
    item = F.when(n % 31 == 0, "").otherwise("s3://lake/part-000.parquet")
    tail = F.concat(
        F.lit(',"artifacts":["'), item, F.lit('"],"contracts":{"rows":1},"preconditions_met":["tests_passed"],"metrics":{}}')
    )
    joined = b.raw("events").select("event_id", head.alias("h"), tail.alias("t"))
    return joined.select("event_id", F.concat(F.expr("substr(h, 1, length(h) - 1)"), F.col("t")).alias("message"))


@query(
    "event_id:i valid:i errors:s",
    """SELECT event_id, CASE WHEN errors = '' THEN 1 ELSE 0 END AS valid, errors
       FROM (SELECT event_id, concat_ws(' ',
               CASE WHEN event_id % 29 = 0 THEN 'extra' END,
               CASE WHEN event_id % 31 = 0 THEN 'empty:artifacts' END,
               CASE WHEN event_id % 13 = 0 THEN 'enum:from' END,
               CASE WHEN event_id % 17 = 0 THEN 'enum:status' END,
               CASE WHEN event_id % 19 = 0 THEN 'format:ts' END,
               CASE WHEN event_id % 23 = 0 THEN 'missing:to' END,
               CASE WHEN event_id % 11 = 0 THEN 'short:run_id' END) AS errors FROM events)""",
)
def validate_handoffs(b):
    checked = messages.validate_handoffs(handoff_messages(b))
    order = ["extra", "empty:artifacts", "enum:from", "enum:status", "format:ts", "missing:to", "short:run_id"]
    listed = F.concat_ws(" ", *[F.when(F.array_contains("errors", e), F.lit(e)) for e in order])
    others = F.size(F.array_except("errors", F.array(*[F.lit(e) for e in order]))) > 0
    return checked.withColumn("errors", F.when(others, F.array_join("errors", " ")).otherwise(listed))


@query(
    "intent:s decisions:i success_rate:d mean_retries:d agents:i p95_duration_s:d drifting:i",
    f"""SELECT intent, count(*) AS decisions,
               count(*) FILTER (WHERE status = 'ok') / count(*) AS success_rate, sum(retries) / count(*) AS mean_retries,
               count(DISTINCT agent) AS agents, quantile_cont(duration_s, 0.95) AS p95_duration_s,
               count(DISTINCT agent) > 1 AS drifting
        FROM (SELECT {sql_pick(messages.INTENTS, 'event_id % 7')} AS intent,
                     CASE WHEN event_id % 70 = 3 THEN 'platform' ELSE {sql_pick(messages.AGENTS, 'event_id % 7')} END AS agent,
                     CASE WHEN event_type = 'error' THEN 'fallido' ELSE 'ok' END AS status,
                     user_id % 4 AS retries, CAST(value AS DOUBLE) AS duration_s FROM events)
        GROUP BY intent""",
)
def routing_metrics(b):
    n = F.col("event_id")
    log = b.raw("events").select(
        pick(messages.INTENTS, "event_id % 7").alias("intent"),
        F.when(n % 70 == 3, "platform").otherwise(pick(messages.AGENTS, "event_id % 7")).alias("agent"),
        F.when(F.col("event_type") == "error", "fallido").otherwise("ok").alias("status"),
        (F.col("user_id") % 4).alias("retries"),
        F.col("value").cast("double").alias("duration_s"),
    )
    return messages.routing_metrics(log)
