"""Registered study aggregates, derived-column exports and top-k tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.plans import aggregates as A
from mercato.plans.model import (first_order_population, rated_population,
                                 single_seller_population)
from mercato.plans.oracle_sql import q as sql
from mercato.plans.registry import REGISTRY, cohorts, fact_base, full_model, light_model, params, register

FIRST_YEAR = int(params().period_start[:4])

register("fact_orders", sql("""
SELECT order_id, customer_unique_id, customer_state, order_status, purchase_date, purchase_month,
       item_count, seller_count, CAST(item_value AS DOUBLE) AS item_value,
       CAST(freight_value AS DOUBLE) AS freight_value, CAST(gross_value AS DOUBLE) AS gross_value,
       ROUND(freight_share, 6) AS freight_share, CAST(payment_total AS DOUBLE) AS payment_total,
       CAST(payment_gap AS DOUBLE) AS payment_gap, payment_type, max_installments, review_score,
       has_comment, bad_review, ROUND(delivery_days, 6) AS delivery_days,
       CAST(delay_days AS BIGINT) AS delay_days, is_late, is_late_timestamp,
       ROUND((epoch_us(order_estimated_delivery_date) - epoch_us(CAST(purchase_date AS TIMESTAMP)))
             / CAST(86400000000 AS DOUBLE), 6) AS promise_days,
       ROUND(handoff_days, 6) AS handoff_days, ROUND(transit_days, 6) AS transit_days,
       analysis_period, same_state, ROUND(distance_km, 6) AS distance_km
FROM fact_orders
"""))(lambda s, d: A.fact_orders_export(full_model(s, d).fact_orders))

register("fact_items", sql("""
SELECT order_id, order_item_id, product_id, seller_id, category, CAST(price AS DOUBLE) AS price,
       CAST(freight_value AS DOUBLE) AS freight_value, customer_state, seller_state, same_state,
       ROUND(customer_lat, 6) AS customer_lat, ROUND(customer_lng, 6) AS customer_lng,
       ROUND(seller_lat, 6) AS seller_lat, ROUND(seller_lng, 6) AS seller_lng,
       ROUND(distance_km, 6) AS distance_km
FROM fact_items
"""))(lambda s, d: A.fact_items_export(full_model(s, d).fact_items))

register("geo_median", sql("""
SELECT geolocation_zip_code_prefix, ROUND(lat, 6) AS geolocation_lat, ROUND(lng, 6) AS geolocation_lng
FROM geo_prefix
"""))(lambda s, d: full_model(s, d).geo.select(
    "geolocation_zip_code_prefix", F.round("geolocation_lat", 6).alias("geolocation_lat"),
    F.round("geolocation_lng", 6).alias("geolocation_lng")))

register("customer_cohorts", sql("""
SELECT customer_unique_id, first_order_id, first_purchase, repeat_90, repeat_after_delivery_90,
       eligible_90, eligible_postdelivery_90, cohort_month
FROM customer_cohorts
"""))(lambda s, d: cohorts(s, d).select(
    "customer_unique_id", "first_order_id", "first_purchase", "repeat_90", "repeat_after_delivery_90",
    "eligible_90", "eligible_postdelivery_90", "cohort_month"))

register("monthly", sql("""
SELECT purchase_month, COUNT(*) AS orders, CAST(SUM(item_value) AS DOUBLE) AS gmv,
       CAST(SUM(item_value) AS DOUBLE) / COUNT(item_value) AS aov,
       CAST(SUM(is_late) AS DOUBLE) / COUNT(is_late) AS late_rate,
       CAST(SUM(review_score) AS DOUBLE) / COUNT(review_score) AS review_score
FROM main_pop GROUP BY purchase_month
"""))(lambda s, d: A.monthly(fact_base(s, d)))

register("states", sql("""
SELECT customer_state, COUNT(*) AS orders, CAST(SUM(item_value) AS DOUBLE) AS gmv,
       ROUND(AVG(delivery_days), 6) AS delivery_days,
       CAST(SUM(is_late) AS DOUBLE) / COUNT(is_late) AS late_rate,
       CAST(SUM(review_score) AS DOUBLE) / COUNT(review_score) AS review_score
FROM main_pop GROUP BY customer_state
"""))(lambda s, d: A.states(fact_base(s, d)))

register("categories", sql("""
SELECT category, COUNT(*) AS items, COUNT(DISTINCT order_id) AS orders, CAST(SUM(price) AS DOUBLE) AS gmv
FROM main_items GROUP BY category
"""))(lambda s, d: A.categories(light_model(s, d).fact_items))

register("sellers", sql("""
SELECT i.seller_id, i.items, i.gmv, o.orders, o.late_n, o.late_rate, o.review_n, o.review_score
FROM (SELECT seller_id, COUNT(*) AS items, CAST(SUM(price) AS DOUBLE) AS gmv FROM main_items GROUP BY seller_id) i
JOIN (SELECT seller_id, COUNT(*) AS orders, COUNT(is_late) AS late_n,
             CAST(SUM(is_late) AS DOUBLE) / COUNT(is_late) AS late_rate, COUNT(review_score) AS review_n,
             CAST(SUM(review_score) AS DOUBLE) / COUNT(review_score) AS review_score
      FROM (SELECT DISTINCT seller_id, order_id, is_late, review_score FROM main_items)
      GROUP BY seller_id) o USING (seller_id)
"""))(lambda s, d: A.sellers(light_model(s, d).fact_items))

RATED_SQL = """
rated AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_unique_id
                                 ORDER BY order_purchase_timestamp, order_id) AS _r1
    FROM main_pop
    WHERE review_score IS NOT NULL AND is_late IS NOT NULL
      AND review_answer_timestamp >= order_delivered_customer_date) WHERE _r1 = 1)
"""

register("review_delay", sql("""
SELECT CASE WHEN delay_days <= 0 THEN 'A l''heure' WHEN delay_days <= 3 THEN '1-3 jours'
            WHEN delay_days <= 7 THEN '4-7 jours' WHEN delay_days <= 14 THEN '8-14 jours'
            ELSE '15 jours et plus' END AS delay_bucket,
       CASE WHEN delay_days <= 0 THEN 0 WHEN delay_days <= 3 THEN 1 WHEN delay_days <= 7 THEN 2
            WHEN delay_days <= 14 THEN 3 ELSE 4 END AS bucket_order,
       COUNT(*) AS orders, CAST(SUM(review_score) AS DOUBLE) / COUNT(review_score) AS review_score,
       CAST(SUM(bad_review) AS DOUBLE) / COUNT(bad_review) AS bad_review_rate
FROM rated GROUP BY ALL
""", RATED_SQL))(lambda s, d: A.review_delay(fact_base(s, d)))

register("review_sensitivity", sql("""
SELECT population, is_late, COUNT(*) AS n,
       CAST(SUM(review_score) AS DOUBLE) / COUNT(review_score) AS review_score,
       CAST(SUM(bad_review) AS DOUBLE) / COUNT(bad_review) AS bad_review_rate
FROM (SELECT 'Tous avis disponibles' AS population, is_late, review_score, bad_review FROM main_pop
      UNION ALL
      SELECT 'Avis apres reception, tous clients', is_late, review_score, bad_review FROM main_pop
      WHERE review_answer_timestamp >= order_delivered_customer_date
      UNION ALL
      SELECT 'Avis apres reception, un par client (H10)', is_late, review_score, bad_review FROM rated)
WHERE is_late IS NOT NULL AND review_score IS NOT NULL
GROUP BY population, is_late
""", RATED_SQL))(lambda s, d: A.review_sensitivity(fact_base(s, d)))

register("score_distribution", sql("""
SELECT review_score, COUNT(*) AS orders FROM main_pop WHERE review_score IS NOT NULL GROUP BY review_score
"""))(lambda s, d: A.score_distribution(fact_base(s, d)))

register("delivery_boxplot", sql("""
SELECT q.same_state, q.n, q.q1, q.median, q.q3, w.whisker_low, w.whisker_high
FROM (SELECT same_state, COUNT(delivery_days) AS n,
             quantile_cont(delivery_days, 0.25) AS q1, quantile_cont(delivery_days, 0.5) AS median,
             quantile_cont(delivery_days, 0.75) AS q3
      FROM main_pop WHERE seller_count = 1 AND same_state IS NOT NULL AND delivery_days IS NOT NULL
      GROUP BY same_state) q
LEFT JOIN (SELECT p.same_state, MIN(delivery_days) AS whisker_low, MAX(delivery_days) AS whisker_high
           FROM main_pop p JOIN (
             SELECT same_state, quantile_cont(delivery_days, 0.25) AS a, quantile_cont(delivery_days, 0.75) AS b
             FROM main_pop WHERE seller_count = 1 AND same_state IS NOT NULL AND delivery_days IS NOT NULL
             GROUP BY same_state) f USING (same_state)
           WHERE p.seller_count = 1 AND p.delivery_days BETWEEN f.a - 1.5 * (f.b - f.a) AND f.b + 1.5 * (f.b - f.a)
           GROUP BY p.same_state) w USING (same_state)
"""))(lambda s, d: A.delivery_boxplot(full_model(s, d).fact_orders))

register("concentration_curve", sql("""
SELECT seller_id, seller_rank, CAST(gmv AS DOUBLE) AS gmv,
       ROUND(seller_rank / n * 100.0, 6) AS seller_pct,
       ROUND(CAST(cum AS DOUBLE) / CAST(total AS DOUBLE) * 100.0, 6) AS cum_gmv_pct
FROM (SELECT seller_id, gmv, ROW_NUMBER() OVER (ORDER BY gmv DESC, seller_id) AS seller_rank,
             SUM(gmv) OVER (ORDER BY gmv DESC, seller_id ROWS UNBOUNDED PRECEDING) AS cum,
             COUNT(*) OVER () AS n, SUM(gmv) OVER () AS total
      FROM (SELECT seller_id, SUM(price) AS gmv FROM main_items GROUP BY seller_id))
"""))(lambda s, d: A.concentration_curve(light_model(s, d).fact_items))

register("weekday_weekend_rate", sql(f"""
SELECT o.weekend_orders, o.weekday_orders, c.weekend_days, c.weekday_days,
       o.weekend_orders / c.weekend_days AS weekend_per_day, o.weekday_orders / c.weekday_days AS weekday_per_day
FROM (SELECT COUNT(*) FILTER (WHERE dayofweek(order_purchase_timestamp) IN (0, 6)) AS weekend_orders,
             COUNT(*) FILTER (WHERE dayofweek(order_purchase_timestamp) NOT IN (0, 6)) AS weekday_orders
      FROM main_pop) o,
     (SELECT COUNT(*) FILTER (WHERE dayofweek(d) IN (0, 6)) AS weekend_days,
             COUNT(*) FILTER (WHERE dayofweek(d) NOT IN (0, 6)) AS weekday_days
      FROM generate_series(DATE '{params().period_start}', DATE '{params().period_end}' - INTERVAL 1 DAY,
                           INTERVAL 1 DAY) t(d)) c
"""))(lambda s, d: A.weekday_weekend_rate(fact_base(s, d), params()))

register("run_summary", sql("""
SELECT s.*, k.* FROM
 (SELECT MIN(order_purchase_timestamp) AS source_min_purchase, MAX(order_purchase_timestamp) AS source_max_purchase,
         COUNT(*) AS source_orders FROM fact_base) s,
 (SELECT COUNT(*) AS delivered_orders, CAST(SUM(item_value) AS DOUBLE) AS gmv,
         CAST(SUM(is_late) AS DOUBLE) / COUNT(is_late) AS late_rate,
         CAST(SUM(is_late_timestamp) AS DOUBLE) / COUNT(is_late_timestamp) AS late_timestamp_rate,
         CAST(SUM(review_score) AS DOUBLE) / COUNT(review_score) AS avg_review,
         ROUND(MEDIAN(delivery_days), 6) AS delivery_median FROM main_pop) k
"""))(lambda s, d: A.run_summary(fact_base(s, d)))

register("late_by_month", sql("""
SELECT purchase_month, COUNT(*) AS orders,
       CAST(SUM(CASE WHEN is_late = 1 THEN 1 ELSE 0 END) AS BIGINT) AS late_orders,
       COUNT(*) FILTER (WHERE review_score <= 2) AS bad_reviews,
       SUM(CASE WHEN is_late = 1 THEN 1 ELSE 0 END) / COUNT(*) AS late_share
FROM main_pop GROUP BY purchase_month
"""))(lambda s, d: A.late_by_month(fact_base(s, d)))

register("nonnull_by_status", sql("""
SELECT order_status, COUNT(*) AS orders, COUNT(review_score) AS scored,
       CAST(SUM(review_score) AS DOUBLE) / COUNT(review_score) AS mean_score,
       COUNT(delivery_days) AS timed, ROUND(AVG(delivery_days), 6) AS mean_delivery_days
FROM fact_base WHERE analysis_period = 1 GROUP BY order_status
"""))(lambda s, d: A.nonnull_by_status(fact_base(s, d)))

register("cohort_table_with_total", sql("""
SELECT cohort_month, COUNT(*) AS customers, CAST(SUM(repeat_90) AS BIGINT) AS repeat_customers,
       CAST(SUM(repeat_90) AS DOUBLE) / COUNT(repeat_90) AS repeat_rate_90,
       CAST(GROUPING(cohort_month) AS INTEGER) AS is_total
FROM customer_cohorts WHERE eligible_90 = 1 GROUP BY ROLLUP (cohort_month)
"""))(lambda s, d: A.cohort_table_with_total(cohorts(s, d)))

register("top10_category_share", sql("""
SELECT CAST(SUM(gmv) FILTER (WHERE rk <= 10) AS DOUBLE) / CAST(SUM(gmv) AS DOUBLE) AS top_share
FROM (SELECT category, SUM(price) AS gmv, ROW_NUMBER() OVER (ORDER BY SUM(price) DESC, category) AS rk
      FROM main_items GROUP BY category)
"""))(lambda s, d: A.top_share(light_model(s, d).fact_items, "category", 10))

register("arg_max_month", sql(f"""
SELECT purchase_month, COUNT(*) AS orders FROM main_pop WHERE year(order_purchase_timestamp) = {FIRST_YEAR}
GROUP BY purchase_month ORDER BY orders DESC, purchase_month LIMIT 1
"""))(lambda s, d: A.arg_max_month(fact_base(s, d), FIRST_YEAR))

POP_COLS = ["order_id", "customer_unique_id", "is_late", "review_score"]

register("rated_population", sql("SELECT order_id, customer_unique_id, is_late, review_score FROM rated",
                                 RATED_SQL))(
    lambda s, d: rated_population(fact_base(s, d)).select(*POP_COLS))

register("single_seller_population", sql("""
SELECT order_id, customer_unique_id, same_state, ROUND(distance_km, 6) AS distance_km FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_unique_id ORDER BY order_purchase_timestamp, order_id) AS r
  FROM main_pop WHERE seller_count = 1 AND same_state IS NOT NULL) WHERE r = 1
"""))(lambda s, d: single_seller_population(full_model(s, d).fact_orders).select(
    "order_id", "customer_unique_id", "same_state", F.round("distance_km", 6).alias("distance_km")))

register("first_order_population", sql("""
SELECT order_id, customer_unique_id, payment_type, CAST(gross_value AS DOUBLE) AS gross_value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_unique_id ORDER BY order_purchase_timestamp, order_id) AS r
  FROM main_pop) WHERE r = 1
"""))(lambda s, d: first_order_population(fact_base(s, d)).select(
    "order_id", "customer_unique_id", "payment_type", F.col("gross_value").cast("double").alias("gross_value")))


def _lattice_sql() -> str:
    """The six tables by their own statements, side by side."""
    parts = {
        "monthly": ("purchase_month", "orders, NULL AS items, gmv, aov, NULL AS late_n, late_rate, NULL AS review_n, review_score, NULL AS bad_review_rate, NULL AS delivery_days"),
        "states": ("customer_state", "orders, NULL, gmv, NULL, NULL, late_rate, NULL, review_score, NULL, delivery_days"),
        "categories": ("category", "orders, items, gmv, NULL, NULL, NULL, NULL, NULL, NULL, NULL"),
        "sellers": ("seller_id", "orders, items, gmv, NULL, late_n, late_rate, review_n, review_score, NULL, NULL"),
        "review_delay": ("delay_bucket", "orders, NULL, NULL, NULL, NULL, NULL, NULL, review_score, bad_review_rate, NULL"),
        "review_sensitivity": ("population || '|' || is_late", "n, NULL, NULL, NULL, NULL, NULL, NULL, review_score, bad_review_rate, NULL")}
    return "\nUNION ALL\n".join(f"SELECT '{name}' AS name, CAST({key} AS VARCHAR) AS key, {cols} FROM ({REGISTRY[name].oracle})"
                                for name, (key, cols) in parts.items())


register("study_aggregates", _lattice_sql())(lambda s, d: A.study_aggregates(light_model(s, d)))
