"""DuckDB SQL for the driver's correctness check.

``PRELUDE`` restates the fixture role mapping (``mercato.plans.fixture``) as
plain SQL common table expressions over the driver tables, and builds
fact_orders, fact_items and customer_cohorts the way the study's SQL does
(ROW_NUMBER windows, grouped child tables, left joins).  Each query appends
its own SELECT.  Written independently of the DataFrame code on purpose.
"""

from __future__ import annotations

DAY_US = "CAST(86400000000 AS DOUBLE)"


def _days(a: str, b: str) -> str:
    return f"((epoch_us({b}) - epoch_us({a})) / {DAY_US})"


PRELUDE = f"""
ship AS (
  SELECT l_orderkey AS order_id, MIN(l_shipdate) AS carrier, MAX(l_shipdate) AS received
  FROM lineitem GROUP BY l_orderkey),
s_orders AS (
  SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id,
         CASE o.o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
              WHEN 'P' THEN 'canceled' END AS order_status,
         o.o_orderdate AS order_purchase_timestamp,
         o.o_orderdate + INTERVAL 1 DAY AS order_approved_at,
         s.carrier AS order_delivered_carrier_date,
         s.received AS order_delivered_customer_date,
         o.o_orderdate + to_days(365 * CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER))
           AS order_estimated_delivery_date
  FROM orders o LEFT JOIN ship s ON s.order_id = o.o_orderkey),
s_customers AS (
  SELECT c_custkey AS customer_id, c_custkey AS customer_unique_id,
         CAST(c_nationkey AS VARCHAR) AS customer_zip_code_prefix, n_name AS customer_state
  FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey),
s_sellers AS (
  SELECT s_suppkey AS seller_id, CAST(s_nationkey AS VARCHAR) AS seller_zip_code_prefix,
         n_name AS seller_state
  FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey),
s_lines AS (
  SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
         CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)), 2)
              AS DECIMAL(18,2)) AS freight
  FROM lineitem),
s_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
         l_suppkey AS seller_id, price, freight AS freight_value
  FROM s_lines),
s_payments AS (
  SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential, l_returnflag AS payment_type,
         l_linenumber AS payment_installments,
         CAST(price + freight - CASE WHEN l_discount >= 0.1 THEN 5 ELSE 0 END AS DECIMAL(18,2))
           AS payment_value
  FROM s_lines),
s_reviews AS (
  SELECT l_partkey AS review_id, l_orderkey AS order_id,
         1 + CAST(floor(l_quantity) AS INTEGER) % 5 AS review_score,
         CASE WHEN l_returnflag = 'R' THEN 'retour ' || l_linestatus
              WHEN l_returnflag = 'A' THEN '  ' END AS review_comment_message,
         l_shipdate AS review_creation_date,
         l_shipdate + to_days(l_linenumber - 3) AS review_answer_timestamp,
         l_suppkey, l_linenumber, l_extendedprice, l_quantity, l_discount, l_tax,
         l_returnflag, l_linestatus
  FROM lineitem),
s_products AS (
  SELECT p_partkey AS product_id, p_type AS product_category_name,
         1 + p_partkey % 6 AS product_photos_qty, CAST(p_size AS DOUBLE) AS product_weight_g
  FROM part),
s_translation AS (
  SELECT * FROM (VALUES ('MEDIUM', 'medium'), ('STANDARD', 'standard'), ('LARGE', 'large'),
                        ('PROMO', 'promo')) AS v(product_category_name, product_category_name_english)),
s_geo AS (
  SELECT CAST(c_nationkey AS VARCHAR) AS geolocation_zip_code_prefix,
         (c_nationkey * 120 + c_custkey % 17) / 100 - 33
           + CASE WHEN c_custkey % 29 = 0 THEN 60 ELSE 0 END AS geolocation_lat,
         (c_nationkey * 140 + c_custkey % 13) / 100 - 72 AS geolocation_lng
  FROM customer),
geo_prefix AS (
  SELECT geolocation_zip_code_prefix, MEDIAN(geolocation_lat) AS lat, MEDIAN(geolocation_lng) AS lng
  FROM s_geo
  WHERE geolocation_lat BETWEEN -34 AND 6 AND geolocation_lng BETWEEN -74 AND -34
  GROUP BY geolocation_zip_code_prefix),
item_totals AS (
  SELECT order_id, COUNT(*) AS item_count, COUNT(DISTINCT seller_id) AS seller_count,
         SUM(price) AS item_value, SUM(freight_value) AS freight_value
  FROM s_items GROUP BY order_id),
payment_totals AS (
  SELECT order_id, SUM(payment_value) AS payment_total, COUNT(*) AS payment_rows,
         COUNT(DISTINCT payment_type) AS payment_types, MAX(payment_installments) AS max_installments,
         CASE WHEN COUNT(DISTINCT payment_type) = 1 THEN MAX(payment_type) ELSE 'mixed' END AS payment_type
  FROM s_payments GROUP BY order_id),
ranked_reviews AS (
  SELECT order_id, review_score, review_answer_timestamp,
         CAST(length(regexp_replace(coalesce(review_comment_message, ''), '^\\s+|\\s+$', '', 'g')) > 0
              AS INTEGER) AS has_comment,
         ROW_NUMBER() OVER (PARTITION BY order_id
           ORDER BY review_answer_timestamp DESC NULLS LAST, review_creation_date DESC NULLS LAST,
                    review_id DESC, l_suppkey DESC, l_linenumber DESC, l_extendedprice DESC,
                    l_quantity DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                    l_linestatus DESC) AS rn
  FROM s_reviews),
fo_joined AS (
  SELECT o.*, c.customer_unique_id, c.customer_zip_code_prefix, c.customer_state,
         it.item_count, it.seller_count, it.item_value, it.freight_value,
         pt.payment_total, pt.payment_rows, pt.payment_types, pt.max_installments, pt.payment_type,
         rr.review_score, rr.has_comment, rr.review_answer_timestamp,
         {_days('o.order_purchase_timestamp', 'o.order_delivered_customer_date')} AS _dur,
         {_days('o.order_approved_at', 'o.order_delivered_carrier_date')} AS _handoff,
         {_days('o.order_delivered_carrier_date', 'o.order_delivered_customer_date')} AS _transit
  FROM s_orders o
  LEFT JOIN s_customers c ON c.customer_id = o.customer_id
  LEFT JOIN item_totals it ON it.order_id = o.order_id
  LEFT JOIN payment_totals pt ON pt.order_id = o.order_id
  LEFT JOIN ranked_reviews rr ON rr.order_id = o.order_id AND rr.rn = 1),
fo_valid AS (
  SELECT *, (order_status = 'delivered' AND _dur >= 0
             AND order_estimated_delivery_date IS NOT NULL) AS _valid
  FROM fo_joined),
fact_base AS (
  SELECT *,
    CAST(order_purchase_timestamp AS DATE) AS purchase_date,
    strftime(order_purchase_timestamp, '%Y-%m') AS purchase_month,
    item_value + freight_value AS gross_value,
    CASE WHEN item_value + freight_value > 0
         THEN CAST(freight_value AS DOUBLE) / CAST(item_value + freight_value AS DOUBLE) END AS freight_share,
    payment_total - (item_value + freight_value) AS payment_gap,
    CASE WHEN order_status = 'delivered' AND _dur >= 0 THEN _dur END AS delivery_days,
    CASE WHEN _valid THEN CAST(order_delivered_customer_date AS DATE)
                          - CAST(order_estimated_delivery_date AS DATE) END AS delay_days,
    CASE WHEN _valid THEN CAST(CAST(order_delivered_customer_date AS DATE)
                          - CAST(order_estimated_delivery_date AS DATE) > 0 AS INTEGER) END AS is_late,
    CASE WHEN _valid THEN CAST(order_delivered_customer_date > order_estimated_delivery_date AS INTEGER)
         END AS is_late_timestamp,
    CASE WHEN order_status = 'delivered' AND _handoff >= 0 THEN _handoff END AS handoff_days,
    CASE WHEN order_status = 'delivered' AND _transit >= 0 THEN _transit END AS transit_days,
    CASE WHEN review_score IS NOT NULL THEN CAST(review_score <= 2 AS INTEGER) END AS bad_review,
    CAST(order_purchase_timestamp >= TIMESTAMP '1996-01-01' AND order_purchase_timestamp < TIMESTAMP '2001-01-01'
         AS INTEGER) AS analysis_period
  FROM fo_valid),
fact_items AS (
  SELECT i.*, coalesce(tr.product_category_name_english, p.product_category_name, 'unknown') AS category,
         p.product_weight_g, p.product_photos_qty, s.seller_state, s.seller_zip_code_prefix,
         f.customer_state, f.customer_zip_code_prefix, f.order_status, f.purchase_date, f.purchase_month,
         f.analysis_period, f.delivery_days, f.is_late, f.review_score, f.item_count, f.seller_count,
         CAST(coalesce(s.seller_state = f.customer_state, false) AS INTEGER) AS same_state,
         gc.lat AS customer_lat, gc.lng AS customer_lng, gs.lat AS seller_lat, gs.lng AS seller_lng,
         6371 * 2 * asin(sqrt(least(greatest(
           pow(sin((radians(gs.lat) - radians(gc.lat)) / 2), 2)
           + cos(radians(gc.lat)) * cos(radians(gs.lat)) * pow(sin(radians(gs.lng - gc.lng) / 2), 2),
           0.0), 1.0))) AS distance_km
  FROM s_items i
  LEFT JOIN s_products p ON p.product_id = i.product_id
  LEFT JOIN s_translation tr ON tr.product_category_name = p.product_category_name
  LEFT JOIN s_sellers s ON s.seller_id = i.seller_id
  JOIN fact_base f ON f.order_id = i.order_id
  LEFT JOIN geo_prefix gc ON gc.geolocation_zip_code_prefix = f.customer_zip_code_prefix
  LEFT JOIN geo_prefix gs ON gs.geolocation_zip_code_prefix = s.seller_zip_code_prefix),
single_geo AS (
  SELECT order_id, MAX(same_state) AS same_state, MAX(distance_km) AS distance_km
  FROM fact_items WHERE seller_count = 1 GROUP BY order_id),
fact_orders AS (
  SELECT f.*, g.same_state, g.distance_km FROM fact_base f LEFT JOIN single_geo g USING (order_id)),
delivered_obs AS (
  SELECT * FROM fact_base
  WHERE order_status = 'delivered' AND order_purchase_timestamp <= TIMESTAMP '2001-08-01 00:00:00'),
first_orders AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_unique_id
                                 ORDER BY order_purchase_timestamp, order_id) AS _rn
    FROM delivered_obs) WHERE _rn = 1),
repeat_flags AS (
  SELECT fo.customer_unique_id,
    MAX(CAST(d.order_id <> fo.order_id
             AND {_days('fo.order_purchase_timestamp', 'd.order_purchase_timestamp')} > 0
             AND {_days('fo.order_purchase_timestamp', 'd.order_purchase_timestamp')} <= 90 AS INTEGER))
      AS repeat_90,
    MAX(CAST(coalesce(d.order_id <> fo.order_id
             AND {_days('fo.order_delivered_customer_date', 'd.order_purchase_timestamp')} > 0
             AND {_days('fo.order_delivered_customer_date', 'd.order_purchase_timestamp')} <= 90, false)
             AS INTEGER)) AS repeat_after_delivery_90
  FROM first_orders fo JOIN delivered_obs d ON d.customer_unique_id = fo.customer_unique_id
  GROUP BY fo.customer_unique_id),
customer_cohorts AS (
  SELECT fo.customer_unique_id, fo.order_id AS first_order_id,
         fo.order_purchase_timestamp AS first_purchase, fo.order_delivered_customer_date,
         fo.customer_state, fo.item_value, fo.is_late, rf.repeat_90, rf.repeat_after_delivery_90,
         CAST(fo.order_purchase_timestamp < date_trunc('month', TIMESTAMP '2001-08-01 00:00:00'
              - INTERVAL 90 DAY) AS INTEGER) AS eligible_90,
         CAST(coalesce(fo.order_delivered_customer_date <= TIMESTAMP '2001-08-01 00:00:00'
              - INTERVAL 90 DAY, false) AS INTEGER) AS eligible_postdelivery_90,
         strftime(fo.order_purchase_timestamp, '%Y-%m') AS cohort_month
  FROM first_orders fo LEFT JOIN repeat_flags rf USING (customer_unique_id)),
main_pop AS (
  SELECT * FROM fact_orders WHERE analysis_period = 1 AND order_status = 'delivered'),
main_items AS (
  SELECT * FROM fact_items WHERE analysis_period = 1 AND order_status = 'delivered')
"""


def q(body: str, extra_ctes: str = "") -> str:
    ctes = PRELUDE.strip()
    if extra_ctes:
        ctes += ",\n" + extra_ctes.strip()
    return f"WITH {ctes}\n{body.strip()}"
