from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

from tidemark.sources import seed

NOW = datetime(2024, 6, 30, 12)
CENT = Decimal("0.01")


def price(step):
    return Decimal("9.90") + step % 20 * Decimal("7.25")


def lines_by_hand(n):
    for item in (1, 2) if n % 3 == 0 else (1,):
        product = (n * 7 + item * 11) % 50
        yield product + 1, 1 + (n + item) % 4, price(product), n % 3 * Decimal("2.5")


def net(quantity, unit, discount):
    return quantity * unit * (1 - discount / 100)


def cents(value):
    return value.quantize(CENT, ROUND_HALF_UP)


def test_order_items_and_totals(spark):
    ids = seed.numbered(spark, 800)
    items = {}
    for r in seed.seed_order_items(ids, NOW).collect():
        items.setdefault(r.order_id, []).append((r.product_id, r.quantity, r.unit_price, r.discount_pct, r.line_total))
    orders = {r.order_id: r for r in seed.seed_orders(ids, NOW).collect()}
    assert len(orders) == 800 and set(items) == set(orders)
    for n in range(1, 801):
        key, mine = f"ORD-{n:06d}", list(lines_by_hand(n))
        want = [(f"PRD-{p:05d}", q, u, d, cents(net(q, u, d))) for p, q, u, d in mine]
        assert sorted(items[key]) == sorted(want)
        order = orders[key]
        assert order.total_amount == cents(sum(net(q, u, d) for _, q, u, d in mine))
        assert order.customer_id == f"CUS-{1 + n * 37 % 200:05d}"
        assert order.order_ts == NOW - timedelta(days=n % 120, hours=n % 11)
        assert order.status == seed.ORDER_STATUSES[(n - 1) % 6]


def test_products(spark):
    got = {r.product_id: r for r in seed.seed_products(seed.numbered(spark, 50), NOW).collect()}
    assert len(got) == 50
    for n in range(1, 51):
        r = got[f"PRD-{n:05d}"]
        assert (r.unit_price, r.cost_amount) == (price(n), cents(price(n) * Decimal("0.62")))
        assert (r.seller_id, r.is_active, r.brand) == (f"SEL-{1 + (n - 1) % 5:03d}", n % 17 != 0, f"Marca {1 + (n - 1) % 12}")


def test_payments_follow_the_order(spark):
    ids = seed.numbered(spark, 12)
    orders = {r.order_id: r for r in seed.seed_orders(ids, NOW).collect()}
    verdict = {"cancelled": "rejected", "refunded": "refunded", "pending": "pending"}
    for r in seed.seed_payments(seed.numbered(spark, 20), seed.seed_orders(ids, NOW)).collect():
        order = orders.pop(r.order_id)
        assert r.paid_at == order.order_ts + timedelta(hours=2)
        assert r.paid_amount == (0 if order.status in ("cancelled", "refunded") else order.total_amount)
        assert r.payment_status == verdict.get(order.status, "approved")
    assert not orders


def test_people_and_tickets(spark, rows):
    people = {r.customer_id: r for r in seed.seed_customers(seed.numbered(spark, 200), NOW).collect()}
    r = people["CUS-00009"]
    assert (r.city, r.region, r.segment, r.gender, r.age_band) == ("Madrid", "centro", "enterprise", "x", "45-54")
    assert (r.email, r.phone, r.created_at) == ("cliente9@example.com", "+34 600071271", NOW - timedelta(days=9))
    assert rows(seed.seed_sellers(seed.numbered(spark, 5), NOW), "seller_id", "channel")[3] == ("SEL-004", "marketplace")
    t = {r.ticket_id: r for r in seed.seed_support_tickets(seed.numbered(spark, 100), NOW).collect()}["TCK-00010"]
    assert (t.customer_id, t.order_id, t.topic) == ("CUS-00171", "ORD-000131", "cuenta")
    assert t.opened_at == NOW - timedelta(days=10, hours=1)


def test_numbers_past_the_padding_stay_distinct(spark):
    ids = spark.createDataFrame([(100,), (1000,), (10000,)], "n bigint")
    assert seed.seed_sellers(ids, NOW).select("seller_id").distinct().count() == 3
