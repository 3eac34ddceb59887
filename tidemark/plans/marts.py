"""Gold marts: calendar, dimensions, facts and the churn feature table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.columns import cents, date_key, iso_weekday, money, ratio4, surrogate
from tidemark.operators.staging import STAGING

OPEN_END = date(2099, 12, 31)
EXCLUDED_STATUSES = ("cancelled", "refunded")
CHURN_DAYS = 180
CATEGORY_MAP_SCHEMA = "category string, segment string, priority int"


def add_years(day: date, years: int) -> date:
    try:
        return day.replace(year=day.year + years)
    except ValueError:  # 29 February
        return day.replace(year=day.year + years, day=28)


def silver(entities: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Conformed entities from Bronze ones."""
    return {name: STAGING[name](df) for name, df in entities.items()}


def category_map(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Typed scan of the category lookup; without a path, the lines shipped with the package (fixed values)."""
    if path:
        return spark.read.csv(path, header=True, schema=CATEGORY_MAP_SCHEMA)
    header, *lines = (files("tidemark") / "data" / "product_category_map.csv").read_text().split()
    rows = [line.split(",") for line in lines]
    return spark.createDataFrame([(c, s, int(p)) for c, s, p in rows], CATEGORY_MAP_SCHEMA)


def dim_date(spark: SparkSession, as_of: date, start: date = date(2023, 1, 1), years_ahead: int = 2) -> DataFrame:
    end = add_years(as_of, years_ahead)
    if end < start:
        raise ValueError(f"the calendar ends on {end}, before its start on {start}")
    day = F.col("date_day")
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date_day"))
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string")).alias("year_quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.dayofmonth(day).alias("day_of_month"),
        iso_weekday(day).alias("day_of_week"),
        F.date_format(day, "EEE").alias("day_name"),
        F.weekofyear(day).alias("iso_week"),
        F.dayofyear(day).alias("day_of_year"),
        (iso_weekday(day) >= 6).cast("int").alias("is_weekend"),
    )


def customer_activity(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customer_id").agg(
        F.min("ordered_at").alias("first_order_at"),
        F.max("ordered_at").alias("last_order_at"),
        F.count(F.lit(1)).alias("orders_count"),
    )


def dim_customer(customers: DataFrame, orders: DataFrame, drop_empty: bool = False) -> DataFrame:
    """Two versions per customer, before and after the first order.

    Both versions come from one scan and one join. A customer who ordered before being created gets
    a first version that ends before it starts; `drop_empty` leaves such versions out.
    """
    first = customer_activity(orders).select("customer_id", "first_order_at")
    born = F.to_date("created_at")
    turned = F.to_date(F.coalesce("first_order_at", "created_at"))

    def version(number: int, start: Column, end: Column) -> Column:
        return F.struct(
            start.alias("valid_from"),
            end.alias("valid_to"),
            F.lit(number - 1).alias("is_current"),
            F.lit(number).alias("version"),
        )

    versions = F.array(
        version(1, born, turned),
        version(2, F.greatest(F.date_add(turned, 1), born), F.lit(OPEN_END)),
    )
    out = customers.join(first, "customer_id", "left").select("*", F.inline(versions))
    if drop_empty:
        out = out.where(F.col("valid_to") >= F.col("valid_from"))
    return out.select(
        surrogate("customer_id", "valid_from").alias("customer_sk"),
        "customer_id",
        "full_name",
        "email_hash",
        "phone_masked",
        "city",
        "region",
        "segment",
        "gender",
        "age_band",
        "valid_from",
        "valid_to",
        "is_current",
        "version",
        "updated_at",
        F.date_diff("valid_to", "valid_from").alias("version_days"),
    )


def int_orders_enriched(orders: DataFrame, lines: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    """Order lines with order, product and seller attributes; one row per line.

    Products and sellers carry one row per key. Whether they are broadcast is left to Spark, which
    checks their size.
    """
    o = orders.where(F.col("order_id").isNotNull()).withColumnRenamed("updated_at", "order_updated_at")
    p = products.select(
        "product_id", "product_name", "sku", "category", "brand", "cost_amount", "seller_id",
        F.col("updated_at").alias("product_updated_at"),
    )
    s = sellers.select(
        "seller_id",
        "seller_name",
        F.col("region").alias("seller_region"),
        F.col("channel").alias("seller_channel"),
    )
    joined = lines.join(o, "order_id").join(p, "product_id", "left").join(s, "seller_id", "left")
    return joined.select(
        "order_id", "product_id", "customer_id", "ordered_at", "order_date", "status", "channel",
        F.col("total_amount").alias("order_total_amount"),
        "quantity", "unit_price", "discount_pct", "line_total",
        "product_name", "sku", "category", "brand", "cost_amount",
        "seller_id", "seller_name", "seller_region", "seller_channel",
        F.greatest("order_updated_at", "product_updated_at").alias("updated_at"),
        "ingested_dt",
    )


def dim_product(products: DataFrame, orders: DataFrame, lines: DataFrame, categories: DataFrame) -> DataFrame:
    """Product attributes, commercial segment and the last `dt` the product was sold on."""
    sold = (
        lines.select("order_id", "product_id")
        .join(orders.select("order_id", "ingested_dt"), "order_id")
        .groupBy("product_id")
        .agg(F.max("ingested_dt").alias("last_ingested_dt"))
    )
    lookup = categories.select(
        "category",
        F.col("segment").alias("category_segment"),
        F.col("priority").alias("category_priority"),
    )
    margin = F.col("unit_price") - F.col("cost_amount")
    rate = F.when(F.col("unit_price") > 0, ratio4(cents(margin), cents("unit_price"))).otherwise(F.lit(0.0))
    return (
        products.join(sold, "product_id", "left")
        .join(lookup, "category", "left")
        .select(
            surrogate("product_id").alias("product_sk"),
            "product_id",
            "sku",
            "product_name",
            "category",
            "category_segment",
            "category_priority",
            "brand",
            F.col("unit_price").alias("list_price"),
            "cost_amount",
            margin.cast("decimal(18,2)").alias("unit_margin"),
            rate.alias("margin_rate"),
            "seller_id",
            "updated_at",
            "last_ingested_dt",
        )
    )


def dim_seller(sellers: DataFrame, products: DataFrame, as_of: date) -> DataFrame:
    """Sellers with catalogue counts; products are reduced to one row per seller before the join."""
    catalogue = products.groupBy("seller_id").agg(
        F.count("product_id").alias("products_count"), F.max("updated_at").alias("last_product_update")
    )
    return sellers.join(catalogue, "seller_id", "left").select(
        surrogate("seller_id").alias("seller_sk"),
        "seller_id",
        "seller_name",
        "region",
        "channel",
        "joined_at",
        F.date_diff(F.lit(as_of), F.to_date("joined_at")).alias("tenure_days"),
        F.coalesce("products_count", F.lit(0)).alias("products_count"),
        "last_product_update",
    )


def sales_lines(orders: DataFrame, lines: DataFrame, calendar: DataFrame) -> DataFrame:
    """The fact's rows without product attributes: one shuffle join and the calendar.

    Marts that need no product column start here instead of from `fct_orders`, since an unused left
    join cannot be dropped by the optimizer.
    """
    days = calendar.select("date_key", F.col("date_day").alias("order_date"))
    dated = orders.withColumnRenamed("updated_at", "order_updated_at").join(days, "order_date")
    return lines.join(dated, "order_id")  # the longer side is streamed, one order is buffered


def fct_orders(
    orders: DataFrame,
    lines: DataFrame,
    products: DataFrame,
    calendar: DataFrame,
    since: date | None = None,
    by: str = "order_date",
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Order-line fact.

    `since` keeps lines whose `by` column reaches it: `order_date` re-reads from the last loaded
    business day, `ingested_dt` also picks up late changes to older orders. The filter is on the
    order side, so it is pushed into the scan. `keep` stores the lines before products are joined to
    them (e.g. `settle`), for a fact that is written in rounds.
    """
    if since is not None:
        orders = orders.where(F.col(by) >= F.lit(since))
    sales = sales_lines(orders, lines, calendar)
    if keep is not None:
        sales = keep(sales)
    p = products.select(
        "product_id", "category", "brand", "cost_amount", "seller_id",
        surrogate("product_id").alias("product_sk"),
        F.col("updated_at").alias("product_updated_at"),
    )
    margin = F.col("line_total") - F.col("quantity") * F.col("cost_amount")
    margin_cents = cents("line_total") - F.col("quantity") * cents("cost_amount")
    rate = F.when(F.col("line_total") > 0, ratio4(margin_cents, cents("line_total"))).otherwise(F.lit(0.0))
    return sales.join(p, "product_id", "left").select(
        "order_id", "product_id", "customer_id", "date_key", "order_date", "ordered_at", "status", "channel",
        "seller_id", "product_sk", "category", "brand", "quantity", "unit_price", "discount_pct", "line_total",
        "total_amount",
        margin.cast("decimal(18,2)").alias("gross_margin"),
        rate.alias("margin_rate"),
        F.greatest("order_updated_at", "product_updated_at").alias("updated_at"),
    )


def fct_payments(
    payments: DataFrame, orders: DataFrame, calendar: DataFrame, since: date | None = None
) -> DataFrame:
    """Payment fact with the gap between order total and amount paid."""
    paid = payments.withColumn("paid_date", F.to_date("paid_at"))
    if since is not None:
        paid = paid.where(F.col("paid_date") >= F.lit(since))
    o = orders.select(
        "order_id", "customer_id", F.col("status").alias("order_status"),
        F.col("total_amount").alias("order_total_amount"),
    )
    days = calendar.select("date_key", F.col("date_day").alias("paid_date"))
    return (
        paid.join(o, "order_id", "left")
        .join(days, "paid_date", "left")
        .select(
            "payment_id", "order_id", "customer_id", "date_key", "paid_date", "paid_at", "payment_method",
            "payment_status", "paid_amount", "order_status",
            (F.col("order_total_amount") - F.col("paid_amount")).cast("decimal(18,2)").alias("amount_gap"),
            (F.col("payment_status") == "approved").cast("int").alias("is_approved"),
            "updated_at",
        )
    )


def order_values(sales: DataFrame) -> DataFrame:
    """Lines folded into orders: the grain the features are counted from."""
    return sales.groupBy("customer_id", "order_id", "order_date", "status").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("line_total").alias("order_value")
    )


def customer_features(
    sales: DataFrame,
    tickets: DataFrame,
    as_of: date,
    churn_days: int = CHURN_DAYS,
    grain: str = "line",
) -> DataFrame:
    """Churn features per customer at `as_of`, from the order-line fact (or `sales_lines`)."""
    return features_of_orders(order_values(sales), tickets, as_of, churn_days, grain)


def features_of_orders(
    values: DataFrame,
    tickets: DataFrame,
    as_of: date,
    churn_days: int = CHURN_DAYS,
    grain: str = "line",
    look_ahead: bool = False,
) -> DataFrame:
    """`customer_features` from `order_values`, which several snapshots can share.

    `grain="line"` counts lines of the last 30 days, `grain="order"` counts orders. Lines are
    reduced per order, then per customer, so a customer with very many orders is spread over tasks.
    With `look_ahead` the label is whether no order came in the `churn_days` after `as_of`, from the
    same pass.
    """
    if grain not in ("line", "order"):
        raise ValueError(f"grain must be 'line' or 'order', not {grain!r}")
    today = F.lit(as_of)
    per_order = values.where(~F.col("status").isin(*EXCLUDED_STATUSES)).where(
        (F.col("order_date") >= F.date_sub(today, 365))
        & (F.col("order_date") <= (F.date_add(today, churn_days) if look_ahead else today))
    )
    recent = F.col("order_date") >= F.date_sub(today, 30)
    counted = F.col("line_count") if grain == "line" else F.lit(1)
    known = (lambda c: F.when(F.col("order_date") <= today, c)) if look_ahead else (lambda c: c)
    later = F.max((F.col("order_date") > today).cast("int"))
    orders = per_order.groupBy("customer_id").agg(
        F.max(known(F.col("order_date"))).alias("last_order_date"),
        F.min(known(F.col("order_date"))).alias("first_order_date"),
        F.count(known(F.lit(1))).alias("orders_total"),
        F.sum(known(F.when(recent, counted).otherwise(0))).alias("orders_last_30d"),
        F.sum(known(F.col("order_value"))).alias("value"),
        F.sum(known(F.col("line_count"))).alias("value_lines"),
        *([later.alias("ordered_later")] if look_ahead else []),
    )
    if look_ahead:
        orders = orders.where(F.col("orders_total") > 0)
    churned = 1 - F.col("ordered_later") if look_ahead else (F.col("last_order_date") < F.date_sub(today, churn_days)).cast("int")
    opened = (
        tickets.where(F.col("customer_id").isNotNull())
        .where((F.col("opened_date") >= F.date_sub(today, 90)) & (F.col("opened_date") <= today))
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("tickets_support_90d"))
    )
    mean_cents = F.call_function("div", cents("value"), F.col("value_lines"))
    return orders.join(opened, "customer_id", "left").select(
        "customer_id",
        today.alias("report_date"),
        F.date_diff(today, "last_order_date").alias("recency_days"),
        F.col("orders_last_30d").cast("int").alias("orders_last_30d"),
        money(F.col("value")).alias("monetary_365d"),
        (mean_cents.cast("decimal(18,0)") / 100).cast("decimal(18,2)").alias("avg_ticket"),
        F.coalesce("tickets_support_90d", F.lit(0)).cast("int").alias("tickets_support_90d"),
        churned.alias("churn_label"),
        F.col("orders_total").cast("int").alias("orders_total"),
        "first_order_date",
        "last_order_date",
        today.cast("timestamp").alias("updated_at"),
    )


def point_in_time_features(
    sales: DataFrame, tickets: DataFrame, cutoff: date, churn_days: int = CHURN_DAYS
) -> DataFrame:
    """Features known at `cutoff`, labelled by what came after: no order in the next `churn_days` days.

    The snapshot's own label follows from `recency_days`; this one does not leak.
    """
    return features_of_orders(order_values(sales), tickets, cutoff, churn_days, look_ahead=True)


def new_snapshot(features: DataFrame, loaded_until: date | None) -> DataFrame:
    """Feature rows to add: only a snapshot later than the last one loaded."""
    return features if loaded_until is None else features.where(F.col("report_date") > F.lit(loaded_until))


def customer_versions(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Adds the `customer_sk` valid on the order date; NULL where no version covers it."""
    v = customers.select("customer_id", "customer_sk", "valid_from", "valid_to")
    covers = F.col("order_date").between(F.col("valid_from"), F.col("valid_to"))
    return (
        sales.alias("s")
        .join(v.alias("v"), (F.col("s.customer_id") == F.col("v.customer_id")) & covers, "left")
        .select("s.*", "v.customer_sk")
    )
