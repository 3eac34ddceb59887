"""One key holds a third of the rows: same results, and the big join is split at run time."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import merge, quality
from tidemark.plans import marts

N = 60000


def value(i):
    """Cents of line `i`, irregular so that shuffled blocks do not compress to nothing."""
    return i * i * 7919 % 999983


DAY = date(2024, 6, 1)


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Lines of which a third belong to one order, one customer and one product."""
    base = tmp_path_factory.mktemp("hot")
    third = F.col("id") % 3 == 0
    spread = F.col("id") % 5003 + 1
    lines = spark.range(N).select(
        F.concat(F.lit("o"), F.when(third, 0).otherwise(spread).cast("string")).alias("order_id"),
        F.concat(F.lit("p"), F.when(F.col("id") % 3 == 1, 0).otherwise(F.col("id") % 997 + 1).cast("string")).alias("product_id"),
        F.lit(1).alias("quantity"),
        F.lit(Decimal("2.00")).cast("decimal(18,2)").alias("unit_price"),
        F.lit(Decimal("0.00")).cast("decimal(18,2)").alias("discount_pct"),
        (value(F.col("id")).cast("decimal(18,0)") / 100).cast("decimal(18,2)").alias("line_total"),
    )
    n = F.col("id")
    orders = spark.range(5004).select(
        F.concat(F.lit("o"), n.cast("string")).alias("order_id"),
        F.concat(F.lit("c"), F.when(n % 3 == 0, 0).otherwise(n).cast("string")).alias("customer_id"),
        F.lit(datetime(2024, 6, 1)).alias("ordered_at"),
        F.lit("paid").alias("status"),
        F.lit("web").alias("channel"),
        F.lit(Decimal("9.00")).cast("decimal(18,2)").alias("total_amount"),
        F.lit(DAY).alias("order_date"),
        F.lit(datetime(2024, 6, 1)).alias("updated_at"),
        F.lit(DAY).alias("ingested_dt"),
    )
    products = spark.range(998).select(
        F.concat(F.lit("p"), n.cast("string")).alias("product_id"),
        F.lit("hogar").alias("category"),
        F.lit("b").alias("brand"),
        F.lit(Decimal("1.00")).cast("decimal(18,2)").alias("cost_amount"),
        F.lit("s").alias("seller_id"),
        F.lit(datetime(2024, 5, 1)).alias("updated_at"),
    )
    out = {}
    for name, df in {"lines": lines, "orders": orders, "products": products}.items():
        df.repartition(8).write.parquet(f"{base}/{name}")
        out[name] = spark.read.parquet(f"{base}/{name}")
    return out


@pytest.fixture
def no_broadcast(spark):
    """Joins as they run when no side is small; thresholds scaled down to the fixture."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k in conf:
        spark.conf.unset(k)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_joins_split_the_hot_key(spark, hot, no_broadcast):
    calendar = marts.dim_date(spark, DAY, date(2024, 1, 1))
    fact = marts.fct_orders(hot["orders"], hot["lines"], hot["products"], calendar)
    plan = final_plan(fact.select("order_id", "product_id", "line_total", "gross_margin"))
    assert plan.count("skew=true") >= 1
    total = fact.agg(F.count("*"), F.sum("line_total"), F.count("product_sk")).first()
    assert tuple(total) == (N, Decimal(sum(value(i) for i in range(N))) / 100, N)


def test_hot_customer_features(spark, hot, no_broadcast):
    calendar = marts.dim_date(spark, DAY, date(2024, 1, 1))
    tickets = spark.createDataFrame([("c0", DAY)] * 500, "customer_id string, opened_date date")
    f = marts.customer_features(marts.sales_lines(hot["orders"], hot["lines"], calendar), tickets, DAY)
    got = {r.customer_id: r for r in f.collect()}
    mine = [i for i in range(N) if i % 3 == 0 or (i % 5003 + 1) % 3 == 0]
    assert got["c0"].orders_last_30d == len(mine)
    assert got["c0"].monetary_365d == Decimal(sum(value(i) for i in mine)) / 100
    assert got["c0"].tickets_support_90d == 500
    assert sum(r.orders_last_30d for r in got.values()) == N


def test_hot_duplicates(spark, hot):
    copies = {r.order_id: r.copies for r in quality.duplicate_keys(hot["lines"], ["order_id"]).collect()}
    assert copies["o0"] == N // 3
    assert quality.surplus_rows(hot["lines"], ["order_id"]).first().violations == N - hot["lines"].select("order_id").distinct().count()


def test_hot_key_upsert_and_dedup(spark, hot):
    lines = hot["lines"].select("order_id", "product_id", "line_total")
    batch = spark.createDataFrame([("o0", "new", Decimal("1.00"))], lines.schema)
    merged = merge.delete_insert(lines, batch, ["order_id"])
    assert merged.count() == N - N // 3 + 1
    assert merge.pick_one(lines, ["order_id"], ["line_total"]).count() == lines.select("order_id").distinct().count()
    back = merge.delete_insert(merged, lines, ["order_id"])
    assert back.count() == N
