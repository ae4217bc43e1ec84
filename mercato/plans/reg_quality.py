"""Registered data-quality, profiling, typing and catalog queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.operators import quality as Qy
from mercato.plans import queries as Q
from mercato.plans.oracle_sql import q as sql
from mercato.plans.registry import fact_base, register, tables
from mercato.session import table_path
from mercato.sources.raw import coerce_types, model_catalog, parquet_tables, profile_tables

_SQL_TABLE = {"orders": "s_orders", "customers": "s_customers", "products": "s_products",
              "sellers": "s_sellers", "order_items": "s_items", "order_payments": "s_payments",
              "order_reviews": "s_reviews"}


def _dq_report_sql() -> str:
    rows = []
    for table, key in Qy.KEY_CHECKS:
        k = ", ".join(key)
        rows.append(f"SELECT 'duplicate keys: {table}' AS check_name, CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS value "
                    f"FROM (SELECT COUNT(*) AS n FROM {_SQL_TABLE[table]} GROUP BY {k})")
        nulls = " OR ".join(f"{c} IS NULL" for c in key)
        rows.append(f"SELECT 'null keys: {table}', COUNT(*) FILTER (WHERE {nulls}) FROM {_SQL_TABLE[table]}")
    for child, col, parent, pk in Qy.REFERENCE_CHECKS:
        rows.append(f"SELECT 'missing references: {child}.{col}', COUNT(*) FROM {_SQL_TABLE[child]} c "
                    f"WHERE NOT EXISTS (SELECT 1 FROM {_SQL_TABLE[parent]} p WHERE p.{pk} = c.{col})")
    rows.append("SELECT 'orders with several reviews', COUNT(*) FROM "
                "(SELECT order_id FROM s_reviews GROUP BY order_id HAVING COUNT(*) > 1)")
    rows.append("SELECT 'repeated review_id', CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) FROM "
                "(SELECT COUNT(*) AS n FROM s_reviews GROUP BY review_id)")
    f_checks = [
        ("orders without items", "item_count IS NULL"),
        ("orders without payment", "payment_total IS NULL"),
        ("orders without review", "review_score IS NULL"),
        ("delivered without receipt date", "order_status = 'delivered' AND order_delivered_customer_date IS NULL"),
        ("receipt before purchase", "_dur < 0"),
        ("carrier before approval", "_handoff < 0"),
        ("receipt before carrier", "_transit < 0"),
        ("review answered before receipt", "review_answer_timestamp < order_delivered_customer_date"),
        ("payment gap over 0.01", "ABS(payment_gap) > 0.010001"),
    ]
    for name, cond in f_checks:
        rows.append(f"SELECT '{name}', COUNT(*) FILTER (WHERE {cond}) FROM fact_base")
    for name, a, b in [("item value preserved", "(SELECT SUM(price) FROM s_items)", "(SELECT SUM(item_value) FROM fact_base)"),
                       ("freight preserved", "(SELECT SUM(freight_value) FROM s_items)", "(SELECT SUM(freight_value) FROM fact_base)"),
                       ("payments preserved", "(SELECT SUM(payment_value) FROM s_payments)", "(SELECT SUM(payment_total) FROM fact_base)")]:
        rows.append(f"SELECT '{name}', CAST(CASE WHEN {a} IS NOT DISTINCT FROM {b} THEN 1 ELSE 0 END AS BIGINT)")
    rows.append("SELECT 'coordinates outside the box', COUNT(*) FILTER (WHERE NOT (geolocation_lat BETWEEN -34 AND 6 "
                "AND geolocation_lng BETWEEN -74 AND -34)) FROM s_geo")
    return sql("SELECT check_name, CAST(value AS BIGINT) AS value FROM (" + "\nUNION ALL\n".join(rows) + ")")


def _dq_report(s, d):
    t = tables(s, d)
    return Qy.dq_report(t, fact_base(s, d), t["geolocation"])


register("dq_report", _dq_report_sql())(_dq_report)


def _treated(s, d):
    t = tables(s, d)
    return Qy.dq_report(t, fact_base(s, d), t["geolocation"], treatments=True)


def _treated_sql() -> str:
    rules = " ".join(f"WHEN check_name = '{k}' OR check_name LIKE '{k}:%' THEN '{v}'" for k, v in Qy.TREATMENTS.items())
    return f"SELECT check_name, value, CASE {rules} ELSE '{Qy.KEEP}' END AS treatment FROM ({_dq_report_sql()})"


register("dq_report_treatments", _treated_sql())(_treated)

register("reconcile_summary_vs_fact", sql("""
SELECT COUNT(*) AS compared,
       COUNT(*) FILTER (WHERE a.item_count IS DISTINCT FROM b.item_count OR a.seller_count IS DISTINCT FROM b.seller_count
                        OR a.item_value IS DISTINCT FROM b.item_value OR a.payment_total IS DISTINCT FROM b.payment_total
                        OR a.review_score IS DISTINCT FROM b.review_score) AS mismatches
FROM (SELECT o.order_id, i.item_count, i.seller_count, i.item_value, p.payment_total, r.review_score
      FROM s_orders o LEFT JOIN item_totals i USING (order_id) LEFT JOIN payment_totals p USING (order_id)
      LEFT JOIN ranked_reviews r ON r.order_id = o.order_id AND r.rn = 1) a
FULL OUTER JOIN fact_base b USING (order_id)
"""))(lambda s, d: Qy.reconcile_summary(
    Q.v_order_summary(tables(s, d)),
    fact_base(s, d).withColumn("item_value", F.col("item_value").cast("double"))
    .withColumn("payment_total", F.col("payment_total").cast("double")),
    "order_id", ["item_count", "seller_count", "item_value", "payment_total", "review_score"]))

register("orphan_items", sql("""
SELECT COUNT(*) AS value FROM s_items i WHERE NOT EXISTS (SELECT 1 FROM s_orders o WHERE o.order_id = i.order_id)
"""))(lambda s, d: Qy.dq_orphans(tables(s, d)["order_items"], "order_id", tables(s, d)["orders"], "order_id"))

register("join_cardinality_items_products", sql("""
SELECT (SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) FROM (SELECT COUNT(*) n FROM s_products GROUP BY product_id))
         AS right_duplicates,
       (SELECT COUNT(*) FROM s_items i LEFT JOIN s_products p USING (product_id)) - (SELECT COUNT(*) FROM s_items)
         AS extra_rows
"""))(lambda s, d: Qy.dq_join_cardinality(tables(s, d)["order_items"], tables(s, d)["products"], "product_id"))

register("grain_fact_orders", sql("""
SELECT COUNT(*) AS rows, COUNT(DISTINCT order_id) AS unique_keys FROM fact_base
"""))(lambda s, d: Qy.dq_grain(fact_base(s, d), "order_id"))

# Column profiles of the raw driver tables.
PROFILE_COLUMNS = {
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
}


def _profile_sql() -> str:
    parts = []
    for t, cols in PROFILE_COLUMNS.items():
        for c in cols:
            parts.append(f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", COUNT(*) AS rows, "
                         f"COUNT(*) - COUNT({c}) AS missing, (COUNT(*) - COUNT({c})) / COUNT(*) AS missing_rate, "
                         f"COUNT(DISTINCT {c}) AS unique_non_null FROM {t}")
    return "\nUNION ALL\n".join(parts)


def _profile(s, d):
    return profile_tables({t: s.read.parquet(table_path(d, t)).select(*columns) for t, columns in PROFILE_COLUMNS.items()})


register("column_profile", _profile_sql())(_profile)

# The profile of every table and column of the folder; the oracle names the driver's tables.
DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
                 "conversations").split()


def _profile_all_sql() -> str:
    parts = []
    for t in DRIVER_TABLES:
        counts = " JOIN ".join(f"(UNPIVOT (SELECT COUNT({d}COLUMNS(*)) FROM {t}) ON COLUMNS(*) INTO NAME col VALUE {n})"
                               for d, n in (("", "present"), ("DISTINCT ", "uniq")))
        parts.append(f"SELECT '{t}' AS \"table\", col AS \"column\", r.n AS rows, r.n - present AS missing, "
                     f"(r.n - present) / r.n AS missing_rate, uniq AS unique_non_null "
                     f"FROM {counts} USING (col), (SELECT COUNT(*) AS n FROM {t}) r")
    return "\nUNION ALL\n".join(parts)


def _profile_all(s, d):
    return profile_tables({t: s.read.parquet(table_path(d, t)) for t in parquet_tables(s, d)})


register("column_profile_all_tables", _profile_all_sql())(_profile_all)

ORDER_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double",
               "o_orderdate": "timestamp_ntz"}


def _coerce(s, d):
    raw = s.read.parquet(table_path(d, "orders"))
    as_text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    typed, _ = coerce_types(as_text, ORDER_TYPES, policy="raise")
    return typed.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")


register("coerce_types_orders", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders
""")(_coerce)


def _catalog_q02(s, d):
    f = fact_base(s, d)
    model_catalog({"fact_orders": f})
    return s.sql("""
        SELECT COUNT(*) AS delivered_orders, ROUND(CAST(SUM(item_value) AS DOUBLE), 2) AS gmv_brl,
               COUNT(is_late) AS logistics_denominator
        FROM fact_orders WHERE analysis_period = 1 AND order_status = 'delivered'""")


register("catalog_sql_kpis", sql("""
SELECT COUNT(*) AS delivered_orders, ROUND(CAST(SUM(item_value) AS DOUBLE), 2) AS gmv_brl,
       COUNT(is_late) AS logistics_denominator FROM main_pop
"""))(_catalog_q02)
