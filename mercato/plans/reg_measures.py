"""Registered BI visuals (V01-V12), BI relationships check (Q-16), filter
propagation (J11), seller labels (C21) and the calendar dimension (C23)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from mercato.operators import quality as Qy
from mercato.plans import measures as MS
from mercato.plans.model import with_written_orders
from mercato.plans.oracle_sql import q as sql
from mercato.plans.reg_study import RATED_SQL
from mercato.plans.registry import light_model, register

BI_SQL = RATED_SQL.strip() + """,
lg AS (SELECT *, analysis_period = 1 AND order_status = 'delivered' AS _lg FROM fact_orders),
bi_items AS (SELECT i.* FROM fact_items i JOIN lg ON lg.order_id = i.order_id AND lg._lg),
dim_sellers AS (SELECT seller_id, 'Vendeur ' || printf('%04d', ROW_NUMBER() OVER (ORDER BY seller_id))
                  AS Vendeur FROM s_sellers),
ra AS (SELECT order_id, review_score,
              CASE WHEN delay_days <= 0 THEN 'A l''heure' WHEN delay_days <= 3 THEN '1-3 jours'
                   WHEN delay_days <= 7 THEN '4-7 jours' WHEN delay_days <= 14 THEN '8-14 jours'
                   ELSE '15 jours et plus' END AS Retard FROM rated)
"""


def _dbl(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


def _visual(name):
    def run(s, d):
        return _dbl(MS.visual(MS.semantic_model(light_model(s, d)), name))
    return run


OD = "NULLIF(COUNT(*) FILTER (WHERE _lg), 0)"
GMV = "CAST(SUM(item_value) FILTER (WHERE _lg) AS DOUBLE)"
LATE = "CAST(SUM(is_late) FILTER (WHERE _lg) AS DOUBLE) / CAST(NULLIF(COUNT(is_late) FILTER (WHERE _lg), 0) AS DOUBLE)"
VISUAL_SQL = {
    "page_performance_cards": f"""
SELECT {OD} AS orders_delivered, {GMV} AS gmv, {GMV} / CAST({OD} AS DOUBLE) AS avg_basket,
       CAST(NULLIF(COUNT(*) FILTER (WHERE analysis_period = 1 AND order_status = 'canceled'), 0) AS DOUBLE)
       / CAST(NULLIF(COUNT(*) FILTER (WHERE analysis_period = 1), 0) AS DOUBLE) AS cancel_rate FROM lg""",
    "orders_by_month": f"SELECT purchase_month AS Mois, {OD} AS orders_delivered FROM lg GROUP BY 1 HAVING {OD} IS NOT NULL",
    "gmv_by_month": f"SELECT purchase_month AS Mois, {GMV} AS gmv FROM lg GROUP BY 1 HAVING {GMV} IS NOT NULL",
    "gmv_by_state": f"SELECT customer_state, {GMV} AS gmv FROM lg GROUP BY 1 HAVING {GMV} IS NOT NULL",
    "orders_by_status": """SELECT order_status, NULLIF(COUNT(*) FILTER (WHERE analysis_period = 1), 0) AS orders
                           FROM lg GROUP BY 1 HAVING orders IS NOT NULL""",
    "page_delivery_cards": f"""
SELECT {LATE} AS late_rate, MEDIAN(delivery_days) FILTER (WHERE _lg) AS median_delivery_days,
       CAST(SUM(review_score) FILTER (WHERE _lg) AS DOUBLE) / CAST(NULLIF(COUNT(review_score) FILTER (WHERE _lg), 0) AS DOUBLE) AS mean_score,
       CAST(SUM(bad_review) FILTER (WHERE _lg) AS DOUBLE) / CAST(NULLIF(COUNT(review_score) FILTER (WHERE _lg), 0) AS DOUBLE) AS bad_review_rate
FROM lg""",
    "late_by_month": f"SELECT purchase_month AS Mois, {LATE} AS late_rate FROM lg GROUP BY 1 HAVING late_rate IS NOT NULL",
    "late_by_state_500": f"""SELECT customer_state, CASE WHEN {OD} >= 500 THEN {LATE} END AS late_rate_500 FROM lg
                             GROUP BY 1 HAVING late_rate_500 IS NOT NULL""",
    "score_by_delay_bucket": """SELECT Retard, CAST(SUM(review_score) AS DOUBLE) / COUNT(review_score) AS mean_score_after_receipt
                                FROM ra GROUP BY 1""",
    "score_histogram": """SELECT review_score, NULLIF(COUNT(review_score) FILTER (WHERE _lg), 0) AS reviews_available
                          FROM lg GROUP BY 1 HAVING reviews_available IS NOT NULL""",
    "page_offer_cards": """SELECT CAST(SUM(price) AS DOUBLE) AS gmv_items, NULLIF(COUNT(*), 0) AS items_delivered,
                                  NULLIF(COUNT(DISTINCT order_id), 0) AS orders_with_items,
                                  NULLIF(COUNT(DISTINCT seller_id), 0) AS active_sellers FROM bi_items""",
    "top_categories_visual": """SELECT category, CASE WHEN DENSE_RANK() OVER (ORDER BY g DESC NULLS LAST) <= 10 THEN g END
                                  AS gmv_top_categories
                                FROM (SELECT category, CAST(SUM(price) AS DOUBLE) AS g FROM bi_items GROUP BY 1)""",
    "top_sellers_visual": """SELECT Vendeur, gmv_top_sellers FROM (
                               SELECT Vendeur, CASE WHEN DENSE_RANK() OVER (ORDER BY g DESC NULLS LAST) <= 10 THEN g END
                                 AS gmv_top_sellers
                               FROM (SELECT s.Vendeur, CAST(SUM(price) AS DOUBLE) AS g
                                     FROM bi_items i JOIN dim_sellers s USING (seller_id) GROUP BY 1))
                             WHERE gmv_top_sellers IS NOT NULL""",
    "offer_by_month": """SELECT purchase_month AS Mois, CAST(SUM(price) AS DOUBLE) AS gmv_items FROM bi_items GROUP BY 1""",
    "category_table": """SELECT category, CAST(SUM(price) AS DOUBLE) AS gmv_items, COUNT(DISTINCT order_id) AS orders_with_items,
                                COUNT(*) AS items_delivered FROM bi_items GROUP BY 1""",
    "page_retention_cards": """
SELECT NULLIF(COUNT(*) FILTER (WHERE eligible_90 = 1), 0) AS eligible_customers,
       CAST(SUM(repeat_90) FILTER (WHERE eligible_90 = 1) AS BIGINT) AS repeat_customers,
       CAST(SUM(repeat_90) FILTER (WHERE eligible_90 = 1) AS DOUBLE)
         / CAST(NULLIF(COUNT(*) FILTER (WHERE eligible_90 = 1), 0) AS DOUBLE) AS repeat_rate_90,
       CAST(SUM(item_value) FILTER (WHERE eligible_90 = 1) AS DOUBLE)
         / CAST(NULLIF(COUNT(item_value) FILTER (WHERE eligible_90 = 1), 0) AS DOUBLE) AS first_basket
FROM customer_cohorts""",
    "retention_by_cohort": """
SELECT cohort_month, CAST(SUM(repeat_90) FILTER (WHERE eligible_90 = 1) AS DOUBLE)
         / CAST(NULLIF(COUNT(*) FILTER (WHERE eligible_90 = 1), 0) AS DOUBLE) AS repeat_rate_90,
       NULLIF(COUNT(*) FILTER (WHERE eligible_90 = 1), 0) AS eligible_customers
FROM customer_cohorts GROUP BY 1 HAVING eligible_customers IS NOT NULL""",
    "retention_by_state_200": """
SELECT customer_state, CASE WHEN COUNT(*) FILTER (WHERE eligible_90 = 1) >= 200 THEN
         CAST(SUM(repeat_90) FILTER (WHERE eligible_90 = 1) AS DOUBLE)
         / CAST(NULLIF(COUNT(*) FILTER (WHERE eligible_90 = 1), 0) AS DOUBLE) END AS repeat_rate_200
FROM customer_cohorts GROUP BY 1 HAVING repeat_rate_200 IS NOT NULL""",
}

for _name in MS.VISUALS:
    register(f"visual_{_name}", sql(VISUAL_SQL[_name], BI_SQL))(_visual(_name))


def _filter_propagation(s, d):
    """A product-category filter changes item measures but leaves order
    measures unchanged (relationships are one-direction)."""
    sm = MS.semantic_model(light_model(s, d))
    ctx = MS.Context(filters=[("DimProducts", F.col("category") == "medium")])
    return _dbl(sm.evaluate(["gmv", "orders_delivered", "gmv_items", "items_delivered"], ctx))


register("filter_propagation", sql("""
SELECT (SELECT CAST(SUM(item_value) FILTER (WHERE _lg) AS DOUBLE) FROM lg) AS gmv,
       (SELECT NULLIF(COUNT(*) FILTER (WHERE _lg), 0) FROM lg) AS orders_delivered,
       (SELECT CAST(SUM(price) AS DOUBLE) FROM bi_items WHERE category = 'medium') AS gmv_items,
       (SELECT NULLIF(COUNT(*), 0) FROM bi_items WHERE category = 'medium') AS items_delivered
""", BI_SQL))(_filter_propagation)


def _month_filtered_cards(s, d):
    sm = MS.semantic_model(light_model(s, d))
    ctx = MS.Context(filters=[("DimDate", F.col("Annee") == 1997)])
    return _dbl(sm.evaluate(["orders_delivered", "gmv", "gmv_items", "items_delivered"], ctx))


register("filter_by_calendar_year", sql("""
SELECT (SELECT NULLIF(COUNT(*) FILTER (WHERE _lg), 0) FROM lg WHERE year(purchase_date) = 1997) AS orders_delivered,
       (SELECT CAST(SUM(item_value) FILTER (WHERE _lg) AS DOUBLE) FROM lg WHERE year(purchase_date) = 1997) AS gmv,
       (SELECT CAST(SUM(price) AS DOUBLE) FROM bi_items WHERE year(purchase_date) = 1997) AS gmv_items,
       (SELECT NULLIF(COUNT(*), 0) FROM bi_items WHERE year(purchase_date) = 1997) AS items_delivered
""", BI_SQL))(_month_filtered_cards)


def _relationships(s, d):
    t = MS.bi_tables(light_model(s, d))
    out = None
    for child, ck, parent, pk in MS.RELATIONSHIPS:
        r = Qy.dq_relationship(t[child], ck, t[parent], pk).select(
            F.lit(f"{child}.{ck} -> {parent}.{pk}").alias("relationship"), "parent_duplicates", "orphans")
        out = r if out is None else out.unionByName(r)
    return out


register("bi_relationships", sql("""
SELECT 'FactOrders.purchase_date -> DimDate.Date' AS relationship, CAST(0 AS BIGINT) AS parent_duplicates,
       CAST(0 AS BIGINT) AS orphans
UNION ALL SELECT 'FactItems.order_id -> FactOrders.order_id', 0,
       (SELECT COUNT(*) FROM fact_items WHERE order_id NOT IN (SELECT order_id FROM fact_orders))
UNION ALL SELECT 'FactItems.product_id -> DimProducts.product_id', 0, 0
UNION ALL SELECT 'FactItems.seller_id -> DimSellers.seller_id', 0, 0
UNION ALL SELECT 'ReviewAnalysis.order_id -> FactOrders.order_id', 0,
       (SELECT COUNT(*) FROM rated WHERE order_id NOT IN (SELECT order_id FROM fact_orders))
""", BI_SQL))(_relationships)

register("seller_labels", sql("SELECT seller_id, Vendeur FROM dim_sellers", BI_SQL))(
    lambda s, d: MS.seller_labels(light_model(s, d).tables["sellers"].select("seller_id")))


def _calendar(s, d):
    t = MS.bi_tables(light_model(s, d))
    return t["DimDate"]


register("calendar_dim", sql("""
SELECT CAST(d AS DATE) AS Date, strftime(d, '%Y-%m') AS Mois, CAST(year(d) AS INTEGER) AS Annee,
       CAST(year(d) * 100 + month(d) AS INTEGER) AS MoisNumero
FROM generate_series((SELECT date_trunc('month', MIN(purchase_date)) FROM fact_orders),
                     (SELECT last_day(MAX(purchase_date)) FROM fact_orders), INTERVAL 1 DAY) t(d)
"""))(_calendar)


register("visual_cohort_table", sql("""
SELECT cohort_month, NULLIF(COUNT(*) FILTER (WHERE eligible_90 = 1), 0) AS eligible_customers,
       CAST(SUM(repeat_90) FILTER (WHERE eligible_90 = 1) AS BIGINT) AS repeat_customers,
       CAST(SUM(repeat_90) FILTER (WHERE eligible_90 = 1) AS DOUBLE)
         / CAST(NULLIF(COUNT(*) FILTER (WHERE eligible_90 = 1), 0) AS DOUBLE) AS repeat_rate_90,
       CAST(GROUPING(cohort_month) AS INTEGER) AS is_total
FROM customer_cohorts GROUP BY ROLLUP (cohort_month)
HAVING eligible_customers IS NOT NULL OR GROUPING(cohort_month) = 1
"""))(lambda s, d: _dbl(MS.visual_with_total(MS.semantic_model(light_model(s, d)),
                                             ["eligible_customers", "repeat_customers", "repeat_rate_90"],
                                             ("Cohorts", "cohort_month"))))


def _all_measures(s, d):
    sm = MS.semantic_model(with_written_orders(light_model(s, d)))
    return _dbl(sm.evaluate(MS.ALL_MEASURES))


register("measures_all", sql(f"""
SELECT o.*, r.*, i.*, c.*,
       CASE WHEN o.orders_delivered >= 500 THEN o.late_rate END AS late_rate_500,
       CASE WHEN c.eligible_customers >= 200 THEN c.repeat_rate_90 END AS repeat_rate_200
FROM (SELECT NULLIF(COUNT(*) FILTER (WHERE analysis_period = 1), 0) AS orders, {OD} AS orders_delivered,
             {GMV} AS gmv, {GMV} / CAST({OD} AS DOUBLE) AS avg_basket,
             CAST(NULLIF(COUNT(*) FILTER (WHERE analysis_period = 1 AND order_status = 'canceled'), 0) AS DOUBLE)
               / CAST(NULLIF(COUNT(*) FILTER (WHERE analysis_period = 1), 0) AS DOUBLE) AS cancel_rate,
             NULLIF(COUNT(is_late) FILTER (WHERE _lg), 0) AS deliveries_assessable,
             CAST(SUM(is_late) FILTER (WHERE _lg) AS BIGINT) AS late_orders, {LATE} AS late_rate,
             MEDIAN(delivery_days) FILTER (WHERE _lg) AS median_delivery_days,
             CAST(SUM(review_score) FILTER (WHERE _lg) AS DOUBLE)
               / CAST(NULLIF(COUNT(review_score) FILTER (WHERE _lg), 0) AS DOUBLE) AS mean_score,
             NULLIF(COUNT(review_score) FILTER (WHERE _lg), 0) AS reviews_available,
             CAST(SUM(bad_review) FILTER (WHERE _lg) AS BIGINT) AS bad_reviews,
             CAST(SUM(bad_review) FILTER (WHERE _lg) AS DOUBLE)
               / CAST(NULLIF(COUNT(review_score) FILTER (WHERE _lg), 0) AS DOUBLE) AS bad_review_rate
      FROM lg) o,
     (SELECT CAST(SUM(review_score) AS DOUBLE) / COUNT(review_score) AS mean_score_after_receipt,
             NULLIF(COUNT(*), 0) AS reviews_after_receipt FROM ra) r,
     (SELECT CAST(SUM(price) AS DOUBLE) AS gmv_items, NULLIF(COUNT(*), 0) AS items_delivered,
             NULLIF(COUNT(DISTINCT order_id), 0) AS orders_with_items,
             NULLIF(COUNT(DISTINCT seller_id), 0) AS active_sellers FROM bi_items) i,
     (SELECT NULLIF(COUNT(*) FILTER (WHERE eligible_90 = 1), 0) AS eligible_customers,
             CAST(SUM(repeat_90) FILTER (WHERE eligible_90 = 1) AS BIGINT) AS repeat_customers,
             CAST(SUM(repeat_90) FILTER (WHERE eligible_90 = 1) AS DOUBLE)
               / CAST(NULLIF(COUNT(*) FILTER (WHERE eligible_90 = 1), 0) AS DOUBLE) AS repeat_rate_90,
             CAST(SUM(item_value) FILTER (WHERE eligible_90 = 1) AS DOUBLE)
               / CAST(NULLIF(COUNT(item_value) FILTER (WHERE eligible_90 = 1), 0) AS DOUBLE) AS first_basket
      FROM customer_cohorts) c
""", BI_SQL))(_all_measures)


def _labels(s, d):
    t = MS.bi_tables(light_model(s, d))
    fo = t["FactOrders"].select("order_id", "livraison_statut", "commande_type",
                                F.year("purchase_date").alias("year"), F.month("purchase_date").alias("month"),
                                F.weekday("purchase_date").alias("day_of_week"))
    return fo


register("bi_order_labels", sql("""
SELECT order_id,
       CASE WHEN is_late IS NULL THEN 'Non évaluable' WHEN is_late = 1 THEN 'En retard' ELSE 'À l''heure' END
         AS livraison_statut,
       CASE WHEN seller_count IS NULL THEN 'Sans articles' WHEN seller_count > 1 THEN 'Plusieurs vendeurs'
            ELSE 'Un vendeur' END AS commande_type,
       CAST(year(purchase_date) AS INTEGER) AS year, CAST(month(purchase_date) AS INTEGER) AS month,
       CAST(isodow(purchase_date) - 1 AS INTEGER) AS day_of_week
FROM fact_orders
"""))(_labels)

register("bi_cohort_labels", sql("""
SELECT customer_unique_id, cohort_month,
       CASE WHEN repeat_90 = 1 THEN 'Avec réachat' ELSE 'Sans réachat' END AS Reachat
FROM customer_cohorts
"""))(lambda s, d: MS.bi_tables(light_model(s, d))["Cohorts"].select("customer_unique_id", "cohort_month", "Reachat"))


# The cards of three pages under their slicers.
_SLICES = {
    "page_performance_cards": (lambda: [("DimDate", F.col("Mois").between("1997-02", "1997-09")), ("FactOrders", F.col("customer_state") >= "NATION_1")], f"""
SELECT {OD} AS orders_delivered, {GMV} AS gmv, {GMV} / CAST({OD} AS DOUBLE) AS avg_basket,
       CAST(NULLIF(COUNT(*) FILTER (WHERE analysis_period = 1 AND order_status = 'canceled'), 0) AS DOUBLE)
       / CAST(NULLIF(COUNT(*) FILTER (WHERE analysis_period = 1), 0) AS DOUBLE) AS cancel_rate
FROM lg WHERE purchase_month BETWEEN '1997-02' AND '1997-09' AND customer_state >= 'NATION_1'"""),
    "page_offer_cards": (lambda: [("DimProducts", F.col("category") >= "m"), ("DimSellers", F.col("seller_state") >= "NATION_1"),
                          ("DimDate", F.col("Mois").between("1997-02", "1997-09"))], """
SELECT CAST(SUM(i.price) AS DOUBLE) AS gmv_items, NULLIF(COUNT(*), 0) AS items_delivered, NULLIF(COUNT(DISTINCT i.order_id), 0) AS orders_with_items,
       NULLIF(COUNT(DISTINCT i.seller_id), 0) AS active_sellers
FROM bi_items i JOIN lg ON lg.order_id = i.order_id JOIN s_sellers s ON s.seller_id = i.seller_id
WHERE i.category >= 'm' AND s.seller_state >= 'NATION_1' AND lg.purchase_month BETWEEN '1997-02' AND '1997-09'"""),
    "page_retention_cards": (lambda: [("Cohorts", F.col("cohort_month").between("1996-02", "1997-09")), ("Cohorts", F.col("customer_state") >= "NATION_1")], """
SELECT NULLIF(COUNT(*) FILTER (WHERE eligible_90 = 1), 0) AS eligible_customers,
       CAST(SUM(repeat_90) FILTER (WHERE eligible_90 = 1) AS BIGINT) AS repeat_customers,
       CAST(SUM(repeat_90) FILTER (WHERE eligible_90 = 1) AS DOUBLE) / NULLIF(COUNT(*) FILTER (WHERE eligible_90 = 1), 0) AS repeat_rate_90,
       CAST(SUM(item_value) FILTER (WHERE eligible_90 = 1) AS DOUBLE)
       / CAST(NULLIF(COUNT(item_value) FILTER (WHERE eligible_90 = 1), 0) AS DOUBLE) AS first_basket
FROM customer_cohorts WHERE cohort_month BETWEEN '1996-02' AND '1997-09' AND customer_state >= 'NATION_1'"""),
}


def _sliced(name):
    return lambda s, d: _dbl(MS.visual(MS.semantic_model(light_model(s, d)), name, _SLICES[name][0]()))


for _name, (_, _sql) in _SLICES.items():
    register(f"sliced_{_name}", sql(_sql, BI_SQL))(_sliced(_name))

# Fixed values of the fixture: supports that its states reach.
MS.support_measure("late_rate_150", "late_rate", "orders_delivered", 150)
MS.support_measure("repeat_rate_20", "repeat_rate_90", "eligible_customers", 20)
register("visual_late_by_state_150", sql(f"""
SELECT customer_state, CASE WHEN {OD} >= 150 THEN {LATE} END AS late_rate_150 FROM lg GROUP BY 1 HAVING late_rate_150 IS NOT NULL
""", BI_SQL))(lambda s, d: _dbl(MS.semantic_model(light_model(s, d)).evaluate(["late_rate_150"], MS.Context([("FactOrders", "customer_state")]))))
register("visual_retention_by_state_20", sql("""
SELECT customer_state, CASE WHEN COUNT(*) FILTER (WHERE eligible_90 = 1) >= 20
       THEN CAST(SUM(repeat_90) FILTER (WHERE eligible_90 = 1) AS DOUBLE) / COUNT(*) FILTER (WHERE eligible_90 = 1) END AS repeat_rate_20
FROM customer_cohorts GROUP BY 1 HAVING repeat_rate_20 IS NOT NULL
""", BI_SQL))(lambda s, d: _dbl(MS.semantic_model(light_model(s, d)).evaluate(["repeat_rate_20"], MS.Context([("Cohorts", "customer_state")]))))
