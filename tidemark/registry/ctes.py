"""Shared SQL subqueries of the oracles, written for DuckDB over the benchmark tables.

They are an independent statement of the same figures: plain joins and windows, no shared code with
the Spark builders.
"""

from __future__ import annotations

from tidemark.sources import adapter as domains

AS_OF = "DATE '2001-08-02'"
CAL_START = "DATE '1995-01-01'"


def pad(prefix: str, n: str, width: int) -> str:
    digits = f"CAST({n} AS VARCHAR)"
    return f"'{prefix}' || lpad({digits}, CAST(greatest({width}, length({digits})) AS INTEGER), '0')"


def pick(values: tuple[str, ...], index: str) -> str:
    items = ", ".join(f"'{v}'" for v in values)
    return f"([{items}])[CAST(1 + {index} AS INTEGER)]"


def ratio4(num: str, den: str) -> str:
    """num / den rounded half up to 4 digits, in whole cents."""
    n, d = f"CAST(({num}) * 100 AS BIGINT)", f"CAST(({den}) * 100 AS BIGINT)"
    magnitude = f"((abs({n}) * 20000 + abs({d})) // (2 * abs({d})))"
    return f"(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -{magnitude} ELSE {magnitude} END / 10000.0)"


def features(as_of: str) -> str:
    return f"""
  SELECT o.customer_id, {as_of} AS report_date,
         date_diff('day', o.last_order_date, {as_of}) AS recency_days,
         o.orders_last_30d, o.orders_in_30d, o.monetary_365d,
         CAST(o.value_cents // o.n AS BIGINT) / 100.0 AS avg_ticket,
         coalesce(t.n, 0) AS tickets_support_90d,
         CASE WHEN o.last_order_date < {as_of} - 180 THEN 1 ELSE 0 END AS churn_label,
         o.orders_total, o.first_order_date, o.last_order_date, CAST({as_of} AS TIMESTAMP) AS updated_at
  FROM (SELECT customer_id, max(order_date) AS last_order_date, min(order_date) AS first_order_date,
               count(DISTINCT order_id) AS orders_total,
               count(*) FILTER (WHERE order_date >= {as_of} - 30) AS orders_last_30d,
               count(DISTINCT order_id) FILTER (WHERE order_date >= {as_of} - 30) AS orders_in_30d,
               sum(line_total) AS monetary_365d,
               CAST(sum(line_total) * 100 AS BIGINT) AS value_cents, count(*) AS n
        FROM fct_orders
        WHERE status NOT IN ('cancelled', 'refunded') AND order_date >= {as_of} - 365 AND order_date <= {as_of}
        GROUP BY customer_id) o
  LEFT JOIN (SELECT customer_id, count(*) AS n FROM stg_support_tickets
             WHERE opened_date >= {as_of} - 90 AND opened_date <= {as_of} GROUP BY customer_id) t
    ON t.customer_id = o.customer_id"""


def quoted(*names: str) -> str:
    return ", ".join(f"'{n}'" for n in names)


def psi_cuts(long: str, quantile: str) -> str:
    return f"""
  SELECT feature, list_sort(list_distinct({quantile}(v, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS cuts
  FROM {long} WHERE is_current = 0 GROUP BY feature"""


def psi_values(long: str, cuts: str) -> str:
    return f"""
  SELECT feature, sum((a - r) * ln(a / r)) AS psi, max(nr) AS n_reference, max(nc) AS n_current
  FROM (SELECT feature, greatest(c / nc, 0.000001) AS a, greatest(r / nr, 0.000001) AS r, nr, nc
        FROM (SELECT feature, bin, CAST(sum(is_current) AS DOUBLE) AS c, CAST(sum(1 - is_current) AS DOUBLE) AS r,
                     sum(sum(is_current)) OVER (PARTITION BY feature) AS nc,
                     sum(sum(1 - is_current)) OVER (PARTITION BY feature) AS nr
              FROM (SELECT l.feature, l.is_current,
                           len(list_filter(k.cuts[2:len(k.cuts) - 1], lambda e: e <= l.v)) AS bin
                    FROM {long} l JOIN {cuts} k ON k.feature = l.feature)
              GROUP BY feature, bin))
  GROUP BY feature"""


CTES: dict[str, str] = {
    "b_orders": f"""
  SELECT o_orderkey AS n, {pad('ORD-', 'o_orderkey', 9)} AS order_id, {pad('CUS-', 'o_custkey', 7)} AS customer_id,
         o_orderdate AS order_ts,
         CASE o_orderstatus WHEN 'O' THEN {pick(('pending', 'paid'), 'o_orderkey % 2')}
                            WHEN 'F' THEN {pick(('shipped', 'delivered'), 'o_orderkey % 2')}
                            ELSE {pick(('cancelled', 'refunded'), 'o_orderkey % 2')} END AS status,
         {pick(domains.ORDER_CHANNELS, 'o_orderkey % 3')} AS channel,
         CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount,
         o_orderdate AS updated_at, CAST(o_orderdate AS DATE) AS dt
  FROM orders""",
    "b_order_items": f"""
  SELECT {pad('ORD-', 'l_orderkey', 9)} AS order_id, {pad('PRD-', 'l_partkey', 7)} AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST((2 * CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT) + CAST(l_quantity AS INTEGER))
              // (2 * CAST(l_quantity AS INTEGER)) AS DECIMAL(16,0)) * CAST(0.01 AS DECIMAL(3,2)) AS unit_price,
         CAST(abs(l_discount) * 100 AS DECIMAL(5,2)) AS discount_pct,
         round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(abs(l_discount) AS DECIMAL(4,2))), 2) AS line_total,
         l_shipdate AS updated_at, CAST(l_shipdate AS DATE) AS dt
  FROM lineitem""",
    "b_products": f"""
  SELECT p_partkey AS n, {pad('PRD-', 'p_partkey', 7)} AS product_id, {pad('sku-', 'p_partkey', 7)} AS sku,
         p_name AS product_name,
         CASE p_type WHEN 'ECONOMY' THEN 'electronica' WHEN 'SMALL' THEN 'hogar' WHEN 'MEDIUM' THEN 'moda'
                     WHEN 'PROMO' THEN 'deportes' WHEN 'STANDARD' THEN 'libros' ELSE 'otros' END AS category,
         p_brand AS brand, CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price,
         CAST(round(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(0.62 AS DECIMAL(3,2)), 2) AS DECIMAL(12,2)) AS cost_amount,
         {pad('SEL-', 'p_partkey % 97', 5)} AS seller_id, p_partkey % 17 <> 0 AS is_active,
         CAST({AS_OF} - CAST(p_partkey % 45 AS INTEGER) AS TIMESTAMP) AS updated_at,
         {AS_OF} - CAST(p_partkey % 45 AS INTEGER) AS dt
  FROM part""",
    "b_sellers": f"""
  SELECT {pad('SEL-', 's_suppkey', 5)} AS seller_id, s_name AS seller_name,
         {pick(domains.SELLER_REGIONS, 's_nationkey % 5')} AS region,
         {pick(domains.SELLER_CHANNELS, 's_suppkey % 3')} AS channel,
         CAST({AS_OF} - CAST(30 * (1 + s_suppkey % 5) AS INTEGER) AS TIMESTAMP) AS joined_at,
         CAST({AS_OF} - CAST(30 * (1 + s_suppkey % 5) AS INTEGER) AS TIMESTAMP) AS updated_at,
         {AS_OF} - CAST(30 * (1 + s_suppkey % 5) AS INTEGER) AS dt
  FROM supplier""",
    "b_customers": f"""
  SELECT c_custkey AS n, {pad('CUS-', 'c_custkey', 7)} AS customer_id, c_name AS full_name,
         ' Cliente' || CAST(c_custkey AS VARCHAR) || '@Example.com ' AS email,
         '+34 6' || lpad(CAST((c_custkey * 7919) % 100000000 AS VARCHAR), 8, '0') AS phone,
         {pick(domains.CITIES, 'c_custkey % 8')} AS city,
         {pick(domains.CITY_REGIONS, 'c_custkey % 8')} AS region,
         {pick(domains.SEGMENTS, 'c_custkey % 3')} AS segment,
         CASE WHEN c_custkey % 11 <> 0 THEN {pick(domains.GENDERS, 'c_custkey % 3')} END AS gender,
         {pick(domains.AGE_BANDS, 'c_custkey % 5')} AS age_band,
         CAST(DATE '1994-06-01' + CAST(c_custkey % 400 AS INTEGER) AS TIMESTAMP) AS created_at,
         CAST({AS_OF} - CAST(c_custkey % 60 AS INTEGER) AS TIMESTAMP) AS updated_at,
         {AS_OF} - CAST(c_custkey % 60 AS INTEGER) AS dt
  FROM customer""",
    "b_payments": f"""
  SELECT {pad('PAY-', 'n', 9)} AS payment_id, order_id, order_ts + INTERVAL 2 HOUR AS paid_at,
         {pick(domains.PAYMENT_METHODS, 'n % 4')} AS payment_method,
         CASE WHEN status IN ('cancelled', 'refunded') THEN CAST(0 AS DECIMAL(12,2)) ELSE total_amount END AS paid_amount,
         CASE status WHEN 'cancelled' THEN 'rejected' WHEN 'refunded' THEN 'refunded' WHEN 'pending' THEN 'pending'
                     ELSE 'approved' END AS payment_status,
         order_ts + INTERVAL 2 HOUR AS updated_at, CAST(order_ts + INTERVAL 2 HOUR AS DATE) AS dt
  FROM b_orders""",
    "b_support_tickets": f"""
  SELECT {pad('TCK-', 'event_id', 9)} AS ticket_id, {pad('CUS-', 'user_id', 7)} AS customer_id,
         CASE WHEN event_id % 4 <> 0 THEN {pad('ORD-', 'event_id', 9)} END AS order_id,
         ts - INTERVAL 8217 DAY AS opened_at,
         {pick(domains.TICKET_TOPICS, 'event_id % 5')} AS topic,
         {pick(domains.TICKET_PRIORITIES, 'event_id % 3')} AS priority,
         {pick(domains.TICKET_STATUSES, 'event_id % 4')} AS status,
         ts - INTERVAL 8217 DAY AS updated_at, CAST(ts - INTERVAL 8217 DAY AS DATE) AS dt
  FROM events WHERE event_type = 'error'""",
    "stg_orders": """
  SELECT order_id, customer_id, date_trunc('second', order_ts) AS ordered_at, lower(trim(status)) AS status,
         lower(trim(channel)) AS channel, CAST(total_amount AS DECIMAL(18,2)) AS total_amount,
         CAST(order_ts AS DATE) AS order_date, date_trunc('second', updated_at) AS updated_at, dt AS ingested_dt
  FROM b_orders WHERE order_id IS NOT NULL AND trim(order_id) <> ''""",
    "stg_customers": """
  SELECT customer_id, trim(full_name) AS full_name, sha256(lower(trim(email))) AS email_hash,
         substr(phone, 1, 6) || '****' || substr(phone, greatest(length(phone) - 1, 1), 2) AS phone_masked,
         lower(trim(city)) AS city, lower(trim(region)) AS region, lower(trim(segment)) AS segment,
         lower(trim(gender)) AS gender, trim(age_band) AS age_band, created_at, updated_at
  FROM b_customers WHERE customer_id IS NOT NULL AND trim(customer_id) <> ''""",
    "stg_products": """
  SELECT product_id, upper(trim(sku)) AS sku, trim(product_name) AS product_name, lower(trim(category)) AS category,
         lower(trim(brand)) AS brand, CAST(unit_price AS DECIMAL(18,2)) AS unit_price,
         CAST(cost_amount AS DECIMAL(18,2)) AS cost_amount, seller_id, CAST(is_active AS INTEGER) AS is_active, updated_at
  FROM b_products WHERE product_id IS NOT NULL AND trim(product_id) <> ''""",
    "stg_sellers": """
  SELECT seller_id, trim(seller_name) AS seller_name, lower(trim(region)) AS region, lower(trim(channel)) AS channel,
         joined_at, updated_at
  FROM b_sellers WHERE seller_id IS NOT NULL AND trim(seller_id) <> ''""",
    "stg_payments": """
  SELECT payment_id, order_id, date_trunc('second', paid_at) AS paid_at, lower(trim(payment_method)) AS payment_method,
         CAST(paid_amount AS DECIMAL(18,2)) AS paid_amount, lower(trim(payment_status)) AS payment_status,
         date_trunc('second', updated_at) AS updated_at
  FROM b_payments WHERE payment_id IS NOT NULL AND trim(payment_id) <> ''""",
    "stg_support_tickets": """
  SELECT ticket_id, customer_id, order_id, date_trunc('second', opened_at) AS opened_at,
         CAST(opened_at AS DATE) AS opened_date, lower(trim(topic)) AS topic, lower(trim(priority)) AS priority,
         lower(trim(status)) AS status, date_trunc('second', updated_at) AS updated_at
  FROM b_support_tickets WHERE ticket_id IS NOT NULL AND trim(ticket_id) <> ''""",
    "order_lines": """
  SELECT order_id, product_id, quantity, CAST(unit_price AS DECIMAL(18,2)) AS unit_price,
         CAST(discount_pct AS DECIMAL(18,2)) AS discount_pct, CAST(line_total AS DECIMAL(18,2)) AS line_total
  FROM b_order_items WHERE order_id IS NOT NULL AND product_id IS NOT NULL""",
    "category_lookup": """
  SELECT * FROM (VALUES ('electronica', 'premium', 1), ('hogar', 'core', 2), ('moda', 'tactico', 3),
    ('deportes', 'tactico', 2), ('libros', 'core', 3), ('outlet', 'long_tail', 3), ('servicios', 'long_tail', 3)
  ) AS t(category, segment, priority)""",
    "int_orders_enriched": """
  SELECT o.order_id, li.product_id, o.customer_id, o.ordered_at, o.order_date, o.status, o.channel,
         o.total_amount AS order_total_amount, li.quantity, li.unit_price, li.discount_pct, li.line_total,
         p.product_name, p.sku, p.category, p.brand, p.cost_amount, p.seller_id, s.seller_name,
         s.region AS seller_region, s.channel AS seller_channel,
         greatest(o.updated_at, p.updated_at) AS updated_at, o.ingested_dt
  FROM stg_orders o JOIN order_lines li ON li.order_id = o.order_id
  LEFT JOIN stg_products p ON p.product_id = li.product_id
  LEFT JOIN stg_sellers s ON s.seller_id = p.seller_id""",
    "dim_date": f"""
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date_day, year(d) AS year, quarter(d) AS quarter,
         CAST(year(d) AS VARCHAR) || '-Q' || CAST(quarter(d) AS VARCHAR) AS year_quarter, month(d) AS month,
         strftime(d, '%Y-%m') AS year_month, day(d) AS day_of_month, isodow(d) AS day_of_week,
         strftime(d, '%a') AS day_name, week(d) AS iso_week, dayofyear(d) AS day_of_year,
         CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend
  FROM (SELECT CAST(x AS DATE) AS d FROM generate_series({CAL_START}, {AS_OF} + INTERVAL 2 YEAR, INTERVAL 1 DAY) g(x))""",
    "customer_activity": """
  SELECT customer_id, min(ordered_at) AS first_order_at, max(ordered_at) AS last_order_at, count(*) AS orders_count
  FROM stg_orders GROUP BY customer_id""",
    "customer_versions": """
  SELECT c.*, CAST(c.created_at AS DATE) AS valid_from, CAST(coalesce(a.first_order_at, c.created_at) AS DATE) AS valid_to,
         0 AS is_current, 1 AS version
  FROM stg_customers c LEFT JOIN customer_activity a ON a.customer_id = c.customer_id
  UNION ALL
  SELECT c.*, greatest(CAST(coalesce(a.first_order_at, c.created_at) AS DATE) + 1, CAST(c.created_at AS DATE)),
         DATE '2099-12-31', 1, 2
  FROM stg_customers c LEFT JOIN customer_activity a ON a.customer_id = c.customer_id""",
    "dim_customer": """
  SELECT md5(customer_id || '|' || CAST(valid_from AS VARCHAR)) AS customer_sk, customer_id, full_name, email_hash,
         phone_masked, city, region, segment, gender, age_band, valid_from, valid_to, is_current, version, updated_at,
         date_diff('day', valid_from, valid_to) AS version_days
  FROM customer_versions""",
    "customer_days": f"""
  SELECT c.customer_id, c.full_name, c.gender, c.age_band,
         {pick(domains.CITIES, '(c.n + CASE WHEN o.n % 3 = 0 THEN 1 ELSE 0 END) % 8')} AS city,
         {pick(domains.CITY_REGIONS, '(c.n + CASE WHEN o.n % 3 = 0 THEN 1 ELSE 0 END) % 8')} AS region,
         {pick(domains.SEGMENTS, '(c.n + CASE WHEN o.n % 5 = 0 THEN 1 ELSE 0 END) % 3')} AS segment,
         o.order_ts AS updated_at, o.n AS extract_no, o.dt
  FROM b_customers c JOIN b_orders o ON o.customer_id = c.customer_id
  UNION ALL
  SELECT customer_id, full_name, gender, age_band, city, region, segment, created_at, -1, CAST(created_at AS DATE)
  FROM b_customers""",
    "dim_customer_history": """
  SELECT md5(customer_id || '|' || CAST(dt AS VARCHAR)) AS version_sk, customer_id, full_name, city, region, segment, gender, age_band,
         dt AS valid_from, coalesce(lead(dt) OVER w - 1, DATE '2099-12-31') AS valid_to,
         row_number() OVER w AS version, CASE WHEN lead(dt) OVER w IS NULL THEN 1 ELSE 0 END AS is_current
  FROM (SELECT *, lag(dt) OVER d IS NOT NULL AND lag(city) OVER d IS NOT DISTINCT FROM city
                  AND lag(region) OVER d IS NOT DISTINCT FROM region AND lag(segment) OVER d IS NOT DISTINCT FROM segment AS same
        FROM (SELECT * FROM customer_days
              QUALIFY row_number() OVER (PARTITION BY customer_id, dt ORDER BY updated_at DESC, extract_no DESC) = 1)
        WINDOW d AS (PARTITION BY customer_id ORDER BY dt))
  WHERE NOT same
  WINDOW w AS (PARTITION BY customer_id ORDER BY dt)""",
    "dim_product": f"""
  SELECT md5(p.product_id) AS product_sk, p.product_id, p.sku, p.product_name, p.category,
         cm.segment AS category_segment, cm.priority AS category_priority, p.brand, p.unit_price AS list_price,
         p.cost_amount, p.unit_price - p.cost_amount AS unit_margin,
         CASE WHEN p.unit_price > 0 THEN {ratio4('p.unit_price - p.cost_amount', 'p.unit_price')} ELSE 0 END AS margin_rate,
         p.seller_id, p.updated_at, s.last_ingested_dt
  FROM stg_products p
  LEFT JOIN (SELECT product_id, max(ingested_dt) AS last_ingested_dt FROM int_orders_enriched GROUP BY product_id) s
    ON s.product_id = p.product_id
  LEFT JOIN category_lookup cm ON cm.category = p.category""",
    "dim_seller": f"""
  SELECT md5(s.seller_id) AS seller_sk, s.seller_id, s.seller_name, s.region, s.channel, s.joined_at,
         date_diff('day', CAST(s.joined_at AS DATE), {AS_OF}) AS tenure_days,
         count(p.product_id) AS products_count, max(p.updated_at) AS last_product_update
  FROM stg_sellers s LEFT JOIN stg_products p ON p.seller_id = s.seller_id
  GROUP BY s.seller_id, s.seller_name, s.region, s.channel, s.joined_at""",
    "fct_orders": f"""
  SELECT e.order_id, e.product_id, e.customer_id, d.date_key, e.order_date, e.ordered_at, e.status, e.channel,
         e.seller_id, p.product_sk, p.category, p.brand, e.quantity, e.unit_price, e.discount_pct, e.line_total,
         e.order_total_amount AS total_amount, e.line_total - e.quantity * p.cost_amount AS gross_margin,
         CASE WHEN e.line_total > 0
              THEN {ratio4('e.line_total - e.quantity * p.cost_amount', 'e.line_total')} ELSE 0 END AS margin_rate,
         e.updated_at
  FROM int_orders_enriched e JOIN dim_date d ON d.date_day = e.order_date
  LEFT JOIN dim_product p ON p.product_id = e.product_id""",
    "fct_payments": """
  SELECT pay.payment_id, pay.order_id, ord.customer_id, d.date_key, CAST(pay.paid_at AS DATE) AS paid_date, pay.paid_at,
         pay.payment_method, pay.payment_status, pay.paid_amount, ord.status AS order_status,
         ord.total_amount - pay.paid_amount AS amount_gap,
         CASE WHEN pay.payment_status = 'approved' THEN 1 ELSE 0 END AS is_approved, pay.updated_at
  FROM stg_payments pay LEFT JOIN stg_orders ord ON ord.order_id = pay.order_id
  LEFT JOIN dim_date d ON d.date_day = CAST(pay.paid_at AS DATE)""",
    "customer_features": features(AS_OF),
    "features_halfyear": features(f"({AS_OF} - 180)"),
    "features_before": features(f"({AS_OF} - 30)"),
    "ingest_audit": "\n  UNION ALL ".join(
        f"""SELECT 'run-' || strftime(dt, '%Y%m%d') AS run_id, '{e}' AS entity, dt, count(*) AS rows_read,
         max(updated_at) AS watermark FROM b_{e} GROUP BY dt"""
        for e in ("orders", "order_items", "products", "sellers", "customers", "payments", "support_tickets")
    ),
    "scoring": """
  SELECT f.customer_id, f.recency_days, f.orders_last_30d, f.monetary_365d, f.avg_ticket, f.tickets_support_90d,
         f.churn_label, c.gender, c.age_band, s.churn_score, CASE WHEN s.churn_score >= 0.5 THEN 1 ELSE 0 END AS churn_pred
  FROM customer_features f
  JOIN (SELECT customer_id, ((n * 7919) % 1000) / 1000.0 AS churn_score FROM b_customers) s ON s.customer_id = f.customer_id
  LEFT JOIN (SELECT * FROM dim_customer WHERE is_current = 1) c ON c.customer_id = f.customer_id""",
    "scored_versions": """
  SELECT v.version, f.churn_label AS y,
         (f.recency_days * v.version + (c.n * 7919) % 1000) / (365.0 * v.version + 1000.0) AS p
  FROM customer_features f JOIN b_customers c ON c.customer_id = f.customer_id,
       (VALUES (1), (2), (3), (4)) AS v(version)""",
    "version_metrics": """
  SELECT a.version, a.positives, a.negatives, a.roc_auc, b.pr_auc, a.brier
  FROM (SELECT version, sum(y) AS positives, count(*) - sum(y) AS negatives,
               (sum(CASE WHEN y = 1 THEN mid_rank ELSE 0 END) - sum(y) * (sum(y) + 1) / 2.0)
                 / (CAST(sum(y) AS DOUBLE) * (count(*) - sum(y))) AS roc_auc,
               avg((p - y) * (p - y)) AS brier
        FROM (SELECT version, y, p, rank() OVER (PARTITION BY version ORDER BY p)
                     + (count(*) OVER (PARTITION BY version, p) - 1) / 2.0 AS mid_rank FROM scored_versions)
        GROUP BY version) a
  JOIN (SELECT version, sum(CAST(pos AS DOUBLE) / total * tp / seen) AS pr_auc
        FROM (SELECT version, pos, sum(pos) OVER w AS tp, sum(n) OVER w AS seen,
                     sum(pos) OVER (PARTITION BY version) AS total
              FROM (SELECT version, p, sum(y) AS pos, count(*) AS n FROM scored_versions GROUP BY version, p)
              WINDOW w AS (PARTITION BY version ORDER BY p DESC ROWS UNBOUNDED PRECEDING))
        GROUP BY version) b ON b.version = a.version""",
    "psi_long": "\n  UNION ALL ".join(
        f"SELECT '{f}' AS feature, {w} AS is_current, CAST({f} AS DOUBLE) AS v FROM {t}"
        for f in ("recency_days", "orders_last_30d", "monetary_365d", "avg_ticket", "tickets_support_90d")
        for w, t in ((0, "features_before"), (1, "customer_features"))
    ),
    "psi_cuts": psi_cuts("psi_long", "quantile_cont"),
    "psi_values": psi_values("psi_long", "psi_cuts"),
    "psi_observed_cuts": psi_cuts("psi_long", "quantile_disc"),
    "psi_observed_values": psi_values("psi_long", "psi_observed_cuts"),
    "line_long": "\n  UNION ALL ".join(
        f"""SELECT '{f}' AS feature, CASE WHEN order_date > {AS_OF} - 30 THEN 1 ELSE 0 END AS is_current, CAST({f} AS DOUBLE) AS v
  FROM fct_orders WHERE order_date > {AS_OF} - 90 AND order_date <= {AS_OF} AND {f} IS NOT NULL"""
        for f in ("quantity", "unit_price", "discount_pct", "line_total")
    ),
    "line_cuts": psi_cuts("line_long", "quantile_disc"),
    "line_values": psi_values("line_long", "line_cuts"),
    "bias_groups": """
  SELECT attribute, grp, count(*) AS n, sum(churn_pred) AS positives, sum(churn_pred) / count(*) AS rate
  FROM (SELECT 'gender' AS attribute, coalesce(gender, '(sin dato)') AS grp, churn_pred FROM scoring
        UNION ALL SELECT 'age_band', coalesce(age_band, '(sin dato)'), churn_pred FROM scoring)
  GROUP BY attribute, grp""",
    "daily_orders": "SELECT order_date, count(DISTINCT order_id) AS orders_count FROM fct_orders GROUP BY order_date",
}
