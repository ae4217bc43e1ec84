"""Registered statistical queries: Welch / Spearman / Kruskal statistics with
DuckDB oracles, the BH step on seller rates, and the full register."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.operators import stats as S
from mercato.plans import hypotheses as H
from mercato.plans.oracle_sql import q as sql
from mercato.plans.reg_study import RATED_SQL
from mercato.plans.registry import full_model, light_model, register

# Fixed values of the fixture: member names standing in for the study's
# 'credit_card', 'boleto' and 'SP'.
FIXTURE_HYPOTHESES = H.HypothesisParams(card_type="N", boleto_type="A", big_state="NATION_0", peak_month=11)

POP_SQL = RATED_SQL.strip() + """,
single AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_unique_id
                                              ORDER BY order_purchase_timestamp, order_id) AS _r2
                 FROM main_pop WHERE seller_count = 1 AND same_state IS NOT NULL) WHERE _r2 = 1),
payd AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_unique_id
                                              ORDER BY order_purchase_timestamp, order_id) AS _r3
                 FROM main_pop) WHERE _r3 = 1),
sr AS (SELECT * FROM main_items WHERE item_count = 1 AND order_id IN (SELECT order_id FROM rated)),
one_item AS (SELECT * FROM main_items WHERE item_count = 1 AND order_id IN (SELECT order_id FROM payd))
"""

hp = FIXTURE_HYPOTHESES
WELCH_SQL = [
    ("H10", "rated", "is_late = 1", "review_score"),
    ("H12", "rated", "delivery_days > 15", "review_score"),
    ("H13", "single", "same_state = 0", "delivery_days"),
    ("H15", "(SELECT * FROM rated WHERE freight_share IS NOT NULL)", "freight_share > 0.2", "review_score"),
    ("H16", "(SELECT * FROM rated WHERE seller_count IS NOT NULL)", "seller_count > 1", "review_score"),
    ("H17", "(SELECT * FROM rated WHERE item_count IS NOT NULL)", "item_count > 1", "review_score"),
    ("H18", f"(SELECT * FROM payd WHERE payment_type = '{hp.card_type}' AND max_installments >= 1)",
     "max_installments > 1", "gross_value"),
    ("H19", f"(SELECT * FROM payd WHERE payment_type IN ('{hp.card_type}', '{hp.boleto_type}'))",
     f"payment_type = '{hp.card_type}'", "gross_value"),
    ("H23", "rated", "has_comment = 1", "review_score"),
    ("H24", "(SELECT * FROM customer_cohorts WHERE eligible_postdelivery_90 = 1 AND is_late IS NOT NULL)",
     "is_late = 1", "repeat_after_delivery_90"),
]
SPEARMAN_SQL = [
    ("H11", "(SELECT * FROM rated WHERE is_late = 1)", "delay_days", "review_score"),
    ("H14", "single", "distance_km", "delivery_days"),
    ("H21", "one_item", "product_weight_g", "freight_value"),
    ("H22", "sr", "product_photos_qty", "review_score"),
    ("H26", "single", "handoff_days", "delay_days"),
]


def _welch_sql() -> str:
    parts = []
    for h, pop, flag, metric in WELCH_SQL:
        parts.append(f"""
SELECT '{h}' AS id, COUNT(*) FILTER (WHERE g) AS n_a, COUNT(*) FILTER (WHERE NOT g) AS n_b,
       AVG(x) FILTER (WHERE g) AS ma, AVG(x) FILTER (WHERE NOT g) AS mb,
       VAR_SAMP(x) FILTER (WHERE g) AS va, VAR_SAMP(x) FILTER (WHERE NOT g) AS vb
FROM (SELECT coalesce({flag}, false) AS g, CAST({metric} AS DOUBLE) AS x FROM {pop} WHERE {metric} IS NOT NULL)""")
    body = "\nUNION ALL\n".join(parts)
    return sql(f"""
SELECT id, n_a, n_b, ROUND(ma - mb, 6) AS effect, ROUND(sqrt(va / n_a + vb / n_b), 6) AS se,
       ROUND(pow(va / n_a + vb / n_b, 2) / (pow(va / n_a, 2) / (n_a - 1) + pow(vb / n_b, 2) / (n_b - 1)), 4) AS df
FROM ({body})
""", POP_SQL)


def _spearman_sql() -> str:
    parts = []
    for h, pop, x, y in SPEARMAN_SQL:
        parts.append(f"""
SELECT '{h}' AS id, COUNT(*) AS n, ROUND(corr(rx, ry), 9) AS rho FROM (
  SELECT rank() OVER (ORDER BY x) + (COUNT(*) OVER (PARTITION BY x) - 1) / 2 AS rx,
         rank() OVER (ORDER BY y) + (COUNT(*) OVER (PARTITION BY y) - 1) / 2 AS ry
  FROM (SELECT {x} AS x, {y} AS y FROM {pop} WHERE {x} IS NOT NULL AND {y} IS NOT NULL))""")
    return sql("\nUNION ALL\n".join(parts), POP_SQL)


KRUSKAL_SQL = sql("""
SELECT CAST(n AS BIGINT) AS n, k, ROUND((12.0 / (n * (n + 1)) * s - 3 * (n + 1)) / (1 - tt / (pow(n, 3) - n)), 6) AS h
FROM (SELECT CAST(SUM(ni) AS DOUBLE) AS n, COUNT(*) AS k, SUM(ri * ri / ni) AS s FROM g), t
""", POP_SQL + """,
top AS (SELECT category FROM sr WHERE review_score IS NOT NULL AND category IS NOT NULL
        GROUP BY category ORDER BY COUNT(*) DESC, category LIMIT 10),
kr AS (SELECT category, review_score AS v,
              rank() OVER (ORDER BY review_score) + (COUNT(*) OVER (PARTITION BY review_score) - 1) / 2 AS r
       FROM sr WHERE review_score IS NOT NULL AND category IN (SELECT category FROM top)),
g AS (SELECT category, COUNT(*) AS ni, SUM(r) AS ri FROM kr GROUP BY category),
t AS (SELECT SUM(pow(c, 3) - c) AS tt FROM (SELECT CAST(COUNT(*) AS DOUBLE) AS c FROM kr GROUP BY v))
""")

register("welch_tests", _welch_sql())(lambda s, d: H.welch_table(full_model(s, d), FIXTURE_HYPOTHESES))
register("spearman_tests", _spearman_sql())(lambda s, d: H.spearman_table(full_model(s, d)))
register("kruskal_test", KRUSKAL_SQL)(lambda s, d: H.kruskal_table(full_model(s, d)))


def _bh_rates(s, d):
    from mercato.plans.aggregates import sellers
    rates = sellers(light_model(s, d).fact_items).select(
        F.col("seller_id").alias("id"), F.col("late_rate").alias("p_value"))
    out = S.benjamini_hochberg(rates, "p_value", "q_bh")
    return out.select("id", F.round("p_value", 9).alias("p_value"), F.round("q_bh", 9).alias("q_bh"))


register("benjamini_hochberg_seller_rates", sql("""
SELECT id, ROUND(p_value, 9) AS p_value, ROUND(q_bh, 9) AS q_bh FROM (
  SELECT id, p_value, LEAST(GREATEST(MIN(adj) OVER (ORDER BY i DESC ROWS UNBOUNDED PRECEDING), 0.0), 1.0) AS q_bh
  FROM (SELECT id, p_value, p_value * COUNT(*) OVER () / ROW_NUMBER() OVER (ORDER BY p_value, id) AS adj,
               ROW_NUMBER() OVER (ORDER BY p_value, id) AS i
        FROM (SELECT seller_id AS id, CAST(SUM(is_late) AS DOUBLE) / COUNT(is_late) AS p_value
              FROM (SELECT DISTINCT seller_id, order_id, is_late, review_score FROM main_items)
              GROUP BY seller_id) WHERE p_value IS NOT NULL))
"""))(_bh_rates)

# Rows-only: p-values and CIs need distribution tails that the SQL oracle
# does not have; they are unit-tested against published values instead.
register("hypothesis_register")(lambda s, d: H.hypothesis_register(full_model(s, d), FIXTURE_HYPOTHESES))
