"""Role adapter: driver tables -> the study's raw table schema.

The study works on nine marketplace tables (orders, customers, order_items,
order_payments, order_reviews, products, sellers, geolocation and the category
translation).  The driver ships TPC-H-like tables instead; this module states
one mapping from those tables to the study schema so every plan in the
library runs unchanged on them.  The same mapping is written in SQL in
``mercato.plans.oracle`` for the DuckDB check.

Mapping (fixed values for this fixture):
  order id / customer id     o_orderkey / o_custkey
  status                     F -> delivered, O -> shipped, P -> canceled
  purchase / approved        o_orderdate / o_orderdate + 1 day
  carrier / received         min / max l_shipdate per order
  promised                   o_orderdate + 365 * (first digit of o_orderpriority) days
  item                       product l_partkey, seller l_suppkey, price l_extendedprice,
                             freight round(price * l_tax, 2)
  payment                    type l_returnflag, instalments and sequence l_linenumber,
                             value price + freight - 5 when l_discount >= 0.1
  review                     id l_partkey, score 1 + floor(l_quantity) % 5,
                             created l_shipdate, answered l_shipdate + (l_linenumber - 3) days,
                             message 'retour <linestatus>' for returned lines, blank for 'A'
  states                     nation name of customer / supplier; zip prefix = nation key
  category                   p_type through CATEGORY_TRANSLATION (two types left out)
  weight / photos            p_size / 1 + p_partkey % 6
  geolocation                one point per customer, derived from its nation and key;
                             every 29th key lies outside the country box
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.session import table_path

# Fixed values of the fixture mapping.
PERIOD_START = "1996-01-01"
PERIOD_END = "2001-01-01"          # exclusive
OBSERVATION_END = "2001-08-01 00:00:00"
STATUS_MAP = {"F": "delivered", "O": "shipped", "P": "canceled"}
CATEGORY_TRANSLATION = [("MEDIUM", "medium"), ("STANDARD", "standard"),
                        ("LARGE", "large"), ("PROMO", "promo")]
MONEY = "decimal(18,2)"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _money(c: Column) -> Column:
    return c.cast(MONEY)


def study_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Return the nine study tables built lazily from the driver tables."""
    orders = _read(spark, sf_dir, "orders")
    line = _read(spark, sf_dir, "lineitem")
    customer = _read(spark, sf_dir, "customer")
    supplier = _read(spark, sf_dir, "supplier")
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = _read(spark, sf_dir, "part")

    status = F.create_map(*[x for kv in STATUS_MAP.items() for x in map(F.lit, kv)])
    ship = (line.groupBy("l_orderkey")
            .agg(F.min("l_shipdate").alias("carrier"), F.max("l_shipdate").alias("received")))
    promised_days = F.lit(365) * F.substring("o_orderpriority", 1, 1).cast("int")
    t_orders = (orders
                .join(ship, orders.o_orderkey == ship.l_orderkey, "left")
                .select(F.col("o_orderkey").alias("order_id"),
                        F.col("o_custkey").alias("customer_id"),
                        status[F.col("o_orderstatus")].alias("order_status"),
                        F.col("o_orderdate").alias("order_purchase_timestamp"),
                        (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("order_approved_at"),
                        F.col("carrier").alias("order_delivered_carrier_date"),
                        F.col("received").alias("order_delivered_customer_date"),
                        F.timestamp_add("DAY", promised_days, F.col("o_orderdate"))
                        .alias("order_estimated_delivery_date")))

    t_customers = (customer.join(F.broadcast(nation), customer.c_nationkey == nation.n_nationkey, "left")
                   .select(F.col("c_custkey").alias("customer_id"),
                           F.col("c_custkey").alias("customer_unique_id"),
                           F.col("c_nationkey").cast("string").alias("customer_zip_code_prefix"),
                           F.col("c_mktsegment").alias("customer_city"),
                           F.col("n_name").alias("customer_state")))

    t_sellers = (supplier.join(F.broadcast(nation), supplier.s_nationkey == nation.n_nationkey, "left")
                 .select(F.col("s_suppkey").alias("seller_id"),
                         F.col("s_nationkey").cast("string").alias("seller_zip_code_prefix"),
                         F.col("s_name").alias("seller_city"),
                         F.col("n_name").alias("seller_state")))

    t_products = part.select(F.col("p_partkey").alias("product_id"),
                             F.col("p_type").alias("product_category_name"),
                             F.length("p_name").alias("product_name_lenght"),
                             (F.lit(1) + F.col("p_partkey") % 6).cast("int").alias("product_photos_qty"),
                             F.col("p_size").cast("double").alias("product_weight_g"))

    price = _money(F.col("l_extendedprice"))
    freight = _money(F.round(price * _money(F.col("l_tax")), 2))
    t_items = line.select(F.col("l_orderkey").alias("order_id"),
                          F.col("l_linenumber").alias("order_item_id"),
                          F.col("l_partkey").alias("product_id"),
                          F.col("l_suppkey").alias("seller_id"),
                          F.col("l_shipdate").alias("shipping_limit_date"),
                          price.alias("price"), freight.alias("freight_value"))

    discount = F.when(F.col("l_discount") >= F.lit(0.1), F.lit(5)).otherwise(F.lit(0))
    t_payments = line.select(F.col("l_orderkey").alias("order_id"),
                             F.col("l_linenumber").alias("payment_sequential"),
                             F.col("l_returnflag").alias("payment_type"),
                             F.col("l_linenumber").alias("payment_installments"),
                             _money(price + freight - discount).alias("payment_value"))

    message = (F.when(F.col("l_returnflag") == "R", F.concat(F.lit("retour "), F.col("l_linestatus")))
               .when(F.col("l_returnflag") == "A", F.lit("  ")))
    # The source sequence stands in for the file row order of a review export:
    # all remaining line columns, so the latest-review tie-break is total.
    seq = F.struct("l_suppkey", "l_linenumber", "l_extendedprice", "l_quantity",
                   "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    t_reviews = line.select(F.col("l_partkey").alias("review_id"),
                            F.col("l_orderkey").alias("order_id"),
                            (F.lit(1) + F.floor("l_quantity").cast("int") % 5).alias("review_score"),
                            F.lit(None).cast("string").alias("review_comment_title"),
                            message.alias("review_comment_message"),
                            F.col("l_shipdate").alias("review_creation_date"),
                            F.timestamp_add("DAY", F.col("l_linenumber") - 3, F.col("l_shipdate"))
                            .alias("review_answer_timestamp"),
                            seq.alias("source_seq"))

    t_geo = customer.select(
        F.col("c_nationkey").cast("string").alias("geolocation_zip_code_prefix"),
        ((F.col("c_nationkey") * 120 + F.col("c_custkey") % 17) / 100 - 33
         + F.when(F.col("c_custkey") % 29 == 0, 60).otherwise(0)).alias("geolocation_lat"),
        ((F.col("c_nationkey") * 140 + F.col("c_custkey") % 13) / 100 - 72).alias("geolocation_lng"),
        F.col("c_mktsegment").alias("geolocation_city"))

    t_translation = spark.createDataFrame(
        CATEGORY_TRANSLATION, "product_category_name string, product_category_name_english string")

    return {"orders": t_orders, "customers": t_customers, "order_items": t_items,
            "order_payments": t_payments, "order_reviews": t_reviews, "products": t_products,
            "sellers": t_sellers, "geolocation": t_geo,
            "product_category_name_translation": t_translation}


def study_params() -> dict:
    return {"period_start": PERIOD_START, "period_end": PERIOD_END,
            "observation_end": OBSERVATION_END}
