from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators.staging import stg_customers, stg_orders
from tidemark.plans import marts

DAY = date(2024, 6, 30)


def orders(spark, table):
    """(order, customer, day, status) rows as conformed orders."""
    full = [(o, c, datetime(d.year, d.month, d.day, 9), s, "web", Decimal(100), d, datetime(2024, 1, 1), d) for o, c, d, s in table]
    return spark.createDataFrame(
        full,
        "order_id string, customer_id string, ordered_at timestamp, status string, channel string, "
        "total_amount decimal(18,2), order_date date, updated_at timestamp, ingested_dt date",
    )


def lines(spark, table):
    full = [(o, p, 1, Decimal(v), Decimal(0), Decimal(v)) for o, p, v in table]
    return spark.createDataFrame(
        full,
        "order_id string, product_id string, quantity int, unit_price decimal(18,2), discount_pct decimal(18,2), "
        "line_total decimal(18,2)",
    )


def tickets(spark, table):
    return spark.createDataFrame(table, "customer_id string, opened_date date")


def customers(spark, table):
    full = [(c, c, "h", "p", "madrid", "centro", "retail", None, None, datetime(d.year, d.month, d.day), datetime(2024, 1, 1)) for c, d in table]
    return spark.createDataFrame(
        full,
        "customer_id string, full_name string, email_hash string, phone_masked string, city string, region string, "
        "segment string, gender string, age_band string, created_at timestamp, updated_at timestamp",
    )


def calendar(spark):
    return marts.dim_date(spark, DAY, date(2023, 1, 1))


def test_calendar(spark):
    days = {r.date_day: r for r in marts.dim_date(spark, date(2024, 2, 29), date(2020, 12, 31)).collect()}
    assert max(days) == date(2026, 2, 28) and len(days) == (max(days) - min(days)).days + 1
    last = days[date(2020, 12, 31)]
    assert (last.date_key, last.iso_week, last.day_of_year, last.year_quarter, last.year_month) == (20201231, 53, 366, "2020-Q4", "2020-12")
    assert (days[date(2024, 1, 1)].day_of_week, days[date(2024, 1, 1)].day_name, days[date(2024, 1, 1)].is_weekend) == (1, "Mon", 0)
    assert (days[date(2024, 1, 7)].day_of_week, days[date(2024, 1, 7)].is_weekend) == (7, 1)


def test_calendar_must_not_end_before_its_start(spark):
    with pytest.raises(ValueError):
        marts.dim_date(spark, date(2024, 1, 1), date(2030, 1, 1))
    assert marts.dim_date(spark, date(2600, 1, 1), date(1900, 1, 1)).count() > 250_000


def test_scd2_versions(spark, rows):
    c = customers(spark, [("new", date(2024, 1, 5)), ("early", date(2024, 3, 1)), ("idle", date(2024, 2, 1))])
    o = orders(spark, [("1", "new", date(2024, 1, 20), "paid"), ("2", "new", date(2024, 2, 20), "paid"), ("3", "early", date(2024, 1, 1), "paid")])
    dim = marts.dim_customer(c, o)
    end = date(2099, 12, 31)
    assert rows(dim, "customer_id", "version", "valid_from", "valid_to", "is_current") == [
        ("early", 1, date(2024, 3, 1), date(2024, 1, 1), 0),
        ("early", 2, date(2024, 3, 1), end, 1),
        ("idle", 1, date(2024, 2, 1), date(2024, 2, 1), 0),
        ("idle", 2, date(2024, 2, 2), end, 1),
        ("new", 1, date(2024, 1, 5), date(2024, 1, 20), 0),
        ("new", 2, date(2024, 1, 21), end, 1),
    ]
    assert dim.select("customer_sk").distinct().count() == 5  # "early" repeats its key
    fixed = marts.dim_customer(c, o, drop_empty=True)
    assert fixed.count() == fixed.select("customer_sk").distinct().count() == 5
    assert fixed.where("version_days < 0").count() == 0


def features(spark, **options):
    o = orders(
        spark,
        [
            ("1", "a", date(2024, 6, 20), "paid"),
            ("2", "a", date(2024, 2, 1), "paid"),
            ("3", "a", date(2024, 6, 29), "cancelled"),
            ("4", "b", date(2024, 1, 1), "shipped"),
            ("5", "c", date(2023, 6, 1), "paid"),
            ("6", "a", date(2024, 7, 4), "paid"),
            ("7", "d", date(2024, 6, 30), "paid"),
        ],
    )
    li = lines(spark, [("1", "x", "10.00"), ("1", "y", "20.01"), ("2", "x", "5.00"), ("3", "x", "9"), ("4", "x", "1"), ("5", "x", "1"), ("6", "x", "1"), ("7", "x", "3")])
    t = tickets(spark, [("a", date(2024, 6, 1)), ("a", date(2024, 1, 1)), (None, date(2024, 6, 1)), ("zzz", date(2024, 6, 1))])
    return marts.customer_features(marts.sales_lines(o, li, calendar(spark)), t, DAY, **options)


def test_features(spark, rows):
    got = rows(features(spark), "customer_id", "recency_days", "orders_last_30d", "monetary_365d", "avg_ticket", "tickets_support_90d", "churn_label", "orders_total")
    assert got == [
        ("a", 10, 2, Decimal("35.01"), Decimal("11.67"), 1, 0, 2),
        ("b", 181, 0, Decimal("1.00"), Decimal("1.00"), 0, 1, 1),
        ("d", 0, 1, Decimal("3.00"), Decimal("3.00"), 0, 0, 1),
    ]


def test_features_can_count_orders(spark, rows):
    assert rows(features(spark, grain="order"), "customer_id", "orders_last_30d") == [("a", 1), ("b", 0), ("d", 1)]
    with pytest.raises(ValueError):
        features(spark, grain="week")


def test_point_in_time_label_looks_forward(spark, rows):
    o = orders(
        spark,
        [
            ("1", "stays", date(2024, 1, 1), "paid"),
            ("2", "stays", date(2024, 3, 1), "paid"),
            ("3", "leaves", date(2024, 1, 1), "paid"),
            ("4", "leaves", date(2024, 3, 1), "refunded"),
            ("5", "late", date(2024, 3, 1), "paid"),
        ],
    )
    li = lines(spark, [(str(i), "x", "1") for i in range(1, 6)])
    sales = marts.sales_lines(o, li, calendar(spark))
    got = marts.point_in_time_features(sales, tickets(spark, [("x", DAY)]), date(2024, 1, 31))
    assert rows(got, "customer_id", "churn_label", "recency_days") == [("leaves", 1, 30), ("stays", 0, 30)]


def products(spark, table):
    full = [(p, p, p, c, "b", Decimal(price), Decimal(cost), s, 1, datetime(2024, 5, 1)) for p, c, price, cost, s in table]
    return spark.createDataFrame(
        full,
        "product_id string, sku string, product_name string, category string, brand string, unit_price decimal(18,2), "
        "cost_amount decimal(18,2), seller_id string, is_active int, updated_at timestamp",
    )


def test_fact_margin_and_missing_product(spark, rows):
    o = orders(spark, [("1", "a", date(2024, 6, 20), "paid"), ("2", "a", date(2022, 6, 20), "paid")])
    li = lines(spark, [("1", "x", "3"), ("1", "gone", "4"), ("1", "x", "0"), ("2", "x", "1")])
    fact = marts.fct_orders(o, li, products(spark, [("x", "hogar", "3", "2", None)]), calendar(spark))
    got = rows(fact, "product_id", "line_total", "gross_margin", "margin_rate", "product_sk", "updated_at")
    assert [r[:4] for r in got] == [
        ("gone", Decimal("4.00"), None, None),
        ("x", Decimal("0.00"), Decimal("-2.00"), 0.0),
        ("x", Decimal("3.00"), Decimal("1.00"), 0.3333),
    ]
    assert got[0][4] is None and got[0][5] == datetime(2024, 1, 1) and got[1][5] == datetime(2024, 5, 1)


def test_incremental_fact_by_business_day_or_by_arrival(spark, rows):
    o = orders(spark, [("old", "a", date(2024, 1, 1), "paid"), ("new", "a", date(2024, 6, 1), "paid")])
    late = F.when(F.col("order_id") == "old", F.lit(DAY)).otherwise(F.col("ingested_dt"))
    o = o.withColumn("ingested_dt", late)
    li, p = lines(spark, [("old", "x", "1"), ("new", "x", "1")]), products(spark, [("x", "hogar", "3", "2", None)])
    since = date(2024, 6, 1)
    assert rows(marts.fct_orders(o, li, p, calendar(spark), since), "order_id") == [("new",)]
    both = marts.fct_orders(o, li, p, calendar(spark), since, by="ingested_dt")
    assert rows(both, "order_id") == [("new",), ("old",)]


def test_dim_product_null_semantics(spark):
    o, li = orders(spark, [("1", "a", DAY, "paid")]), lines(spark, [("1", "x", "3")])
    p = products(spark, [("x", "hogar", "3", "2", None), ("y", "otros", "0", "2", None)])
    got = {r.product_id: r for r in marts.dim_product(p, o, li, marts.category_map(spark)).collect()}
    assert (got["x"].category_segment, got["x"].category_priority, got["x"].last_ingested_dt) == ("core", 2, DAY)
    assert (got["y"].category_priority, got["y"].last_ingested_dt, got["y"].margin_rate) == (None, None, 0.0)


def test_category_map_from_csv(spark, tmp_path, rows):
    path = tmp_path / "map.csv"
    path.write_text("category,segment,priority\nhogar,core,2\n")
    assert rows(marts.category_map(spark, str(path))) == [("hogar", "core", 2)]
    assert marts.category_map(spark).count() == 7


def test_dim_seller_counts_nothing_for_idle_sellers(spark, rows):
    s = spark.createDataFrame(
        [("s1", "A", "norte", "partner", datetime(2024, 6, 1), None), ("s2", "B", "sur", "partner", datetime(2024, 6, 30), None)],
        "seller_id string, seller_name string, region string, channel string, joined_at timestamp, updated_at timestamp",
    )
    p = products(spark, [("x", "hogar", "3", "2", "s1"), ("y", "hogar", "3", "2", "s1"), ("z", "hogar", "3", "2", None)])
    assert rows(marts.dim_seller(s, p, DAY), "seller_id", "tenure_days", "products_count", "last_product_update") == [
        ("s1", 29, 2, datetime(2024, 5, 1)),
        ("s2", 0, 0, None),
    ]


def test_fact_takes_the_version_valid_on_the_day(spark, rows):
    c = customers(spark, [("a", date(2024, 1, 1))])
    o = orders(spark, [("1", "a", date(2024, 1, 20), "paid"), ("2", "a", date(2024, 2, 20), "paid"), ("0", "ghost", DAY, "paid")])
    dim = marts.dim_customer(c, o)
    sales = marts.sales_lines(o, lines(spark, [("0", "x", "1"), ("1", "x", "1"), ("2", "x", "1")]), calendar(spark))
    v = {r.version: r.customer_sk for r in dim.collect()}
    assert rows(marts.customer_versions(sales, dim), "order_id", "customer_sk") == [("0", None), ("1", v[1]), ("2", v[2])]


def test_payments(spark, rows):
    o = orders(spark, [("1", "a", DAY, "cancelled")])
    pay = spark.createDataFrame(
        [("p1", "1", datetime(2024, 6, 30, 23, 59), "card", Decimal(30), "approved", None), ("p2", "none", datetime(2020, 1, 1), "card", Decimal(1), "pending", None)],
        "payment_id string, order_id string, paid_at timestamp, payment_method string, paid_amount decimal(18,2), payment_status string, updated_at timestamp",
    )
    got = rows(marts.fct_payments(pay, o, calendar(spark)), "payment_id", "customer_id", "date_key", "amount_gap", "is_approved")
    assert got == [("p1", "a", 20240630, Decimal("70.00"), 1), ("p2", None, None, None, 0)]
    assert rows(marts.fct_payments(pay, o, calendar(spark), date(2024, 1, 1)), "payment_id") == [("p1",)]


def test_staging_of_text_sources(spark, rows):
    bronze = spark.createDataFrame(
        [(" ", "c", "2024-01-01", " PAID ", "Web", "1.999", "2024-01-01", DAY), ("o1", "c", "2024-01-01T10:00:00Z", " PAID ", "Web", "1.999", "bad", DAY)],
        "order_id string, customer_id string, order_ts string, status string, channel string, total_amount string, updated_at string, dt date",
    )
    got = rows(stg_orders(bronze), "order_id", "ordered_at", "status", "channel", "total_amount", "updated_at", "ingested_dt")
    assert got == [("o1", datetime(2024, 1, 1, 10), "paid", "web", Decimal("1.99"), None, DAY)]


def test_staging_hides_personal_data(spark):
    bronze = spark.createDataFrame(
        [("c1", " Ana ", "ana@x.org", "+34 612345678", "Madrid", "Centro", "Retail", None, "18-24", DAY, DAY)],
        "customer_id string, full_name string, email string, phone string, city string, region string, segment string, gender string, age_band string, created_at date, updated_at date",
    )
    r = stg_customers(bronze).first()
    assert "email" not in r and "phone" not in r
    assert (r.full_name, r.phone_masked, r.gender) == ("Ana", "+34 61****78", None)


def test_add_years():
    assert marts.add_years(date(2024, 2, 29), 2) == date(2026, 2, 28)
    assert marts.add_years(date(2023, 3, 1), 2) == date(2025, 3, 1)
