"""The study's fact model: fact_orders (P01), fact_items (P02), customer
cohorts (P03/P04) and the shared populations (P06-P08).

All builders are lazy: they return DataFrames and run nothing.  Child tables
are aggregated before they meet orders (one-to-one joins); every join is on
the order or customer key, so Spark can keep one hash partitioning on
``order_id`` across the child aggregates and the joins.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions import columns as C
from mercato.operators.aggregates import geo_median, item_totals, payment_totals
from mercato.operators.windows import first_per_key, latest_review
from mercato.session import scratch_path


@dataclass(frozen=True)
class StudyParams:
    period_start: str = "2017-01-01"
    period_end: str = "2018-09-01"              # exclusive
    observation_end: str = "2018-08-31 23:59:59"
    repeat_window_days: int = 90

    @classmethod
    def from_dict(cls, d: dict) -> "StudyParams":
        return cls(**{k: v for k, v in d.items() if k in cls.__dataclass_fields__})


# Columns of the order fact that are computed from columns of its children.
FROM_CHILDREN = {"gross_value": {"item_value", "freight_value"}, "freight_share": {"item_value", "freight_value"},
                 "payment_gap": {"payment_total", "item_value", "freight_value"}, "bad_review": {"review_score"}}


def _kept_child(child: DataFrame, columns: Sequence[str], keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``columns`` of the order fact read of a child, kept; its other columns are null."""
    wanted = set(columns).union(*[FROM_CHILDREN.get(c, ()) for c in columns])
    used = [c for c in child.columns if c in wanted and c != "order_id"]
    if not used:
        return child
    kept = keep(child.filter(F.col("order_id").isNotNull()).select("order_id", *used))
    return kept.select(*[F.col(c) if c in kept.columns else F.lit(None).cast(child.schema[c].dataType).alias(c) for c in child.columns])


def build_fact_orders_base(t: dict[str, DataFrame], p: StudyParams, only_seller: bool = False, columns: Sequence[str] = (),
                           keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """P01 without the single-seller geography: one row per order.  With
    ``only_seller`` it tells the seller of orders that have one.  ``keep``
    writes each child's totals before they meet the orders, so that the
    shuffles of one child are gone when the next is aggregated; only
    ``columns`` of the result are valid then."""
    orders, customers = t["orders"], t["customers"]
    items = item_totals(t["order_items"], only_seller=only_seller)
    pays = payment_totals(t["order_payments"])
    latest = latest_review(t["order_reviews"], payload=("review_score", "has_comment"))
    if keep:
        items, pays, latest = [_kept_child(c, columns, keep) for c in (items, pays, latest)]
    f = (orders
         .join(customers, "customer_id", "left")
         .join(items, "order_id", "left")
         .join(pays, "order_id", "left")
         .join(latest, "order_id", "left"))
    valid = C.valid_delivery()
    handoff = C.days_between("order_approved_at", "order_delivered_carrier_date")
    transit = C.days_between("order_delivered_carrier_date", "order_delivered_customer_date")
    return (f
            .withColumn("purchase_date", C.purchase_date())
            .withColumn("purchase_month", C.purchase_month())
            .withColumn("gross_value", C.gross_value())
            .withColumn("freight_share", C.freight_share())
            .withColumn("payment_gap", C.payment_gap())
            .withColumn("delivery_days", C.delivery_days())
            .withColumn("delay_days", C.delay_days(valid=valid))
            .withColumn("is_late", C.is_late(F.col("delay_days"), valid))
            .withColumn("is_late_timestamp", C.is_late_timestamp(valid=valid))
            .withColumn("promise_days", C.promise_days())
            .withColumn("handoff_days", C.valid_duration(handoff))
            .withColumn("transit_days", C.valid_duration(transit))
            .withColumn("bad_review", C.bad_review())
            .withColumn("analysis_period", C.in_period("order_purchase_timestamp",
                                                      p.period_start, p.period_end)))


def dim_products(t: dict[str, DataFrame]) -> DataFrame:
    """J03 + C14: products with their category (translation, else original,
    else ``unknown``).  The translation table has one row per category name;
    Spark broadcasts it where its size allows."""
    tr = t["product_category_name_translation"]
    return (t["products"].join(tr, "product_category_name", "left")
            .withColumn("category", C.category()))


ORDER_COLUMNS_FOR_ITEMS = ["order_id", "customer_state", "customer_zip_code_prefix", "order_status",
                           "purchase_date", "purchase_month", "analysis_period", "delivery_days",
                           "is_late", "review_score", "item_count", "seller_count"]


def build_fact_items(t: dict[str, DataFrame], f_base: DataFrame, geo: DataFrame | None = None,
                     with_geo: bool = True) -> DataFrame:
    """Items + product + seller + order columns + geography + distance.
    ``with_geo=False`` leaves out the postal-prefix medians and the distance
    (null) for callers that do not read them: the joins are not pruned by the
    optimizer, so they are not built at all."""
    if not with_geo:
        return (t["order_items"]
                .join(dim_products(t), "product_id", "left")
                .join(t["sellers"], "seller_id", "left")
                .join(f_base.select(*ORDER_COLUMNS_FOR_ITEMS), "order_id", "inner")
                .withColumn("same_state", C.same_state())
                .withColumn("distance_km", F.lit(None).cast("double")))
    geo = geo if geo is not None else geo_median(t["geolocation"])
    return with_distance(t["order_items"]
                         .join(dim_products(t), "product_id", "left")
                         .join(t["sellers"], "seller_id", "left")
                         .join(f_base.select(*ORDER_COLUMNS_FOR_ITEMS), "order_id", "inner")
                         .withColumn("same_state", C.same_state()), geo)


def with_distance(d: DataFrame, geo: DataFrame) -> DataFrame:
    """Adds the postal-prefix medians of customer and seller and the distance between them."""
    cust_geo = geo.select(F.col("geolocation_zip_code_prefix").alias("customer_zip_code_prefix"),
                          F.col("geolocation_lat").alias("customer_lat"),
                          F.col("geolocation_lng").alias("customer_lng"))
    sell_geo = geo.select(F.col("geolocation_zip_code_prefix").alias("seller_zip_code_prefix"),
                          F.col("geolocation_lat").alias("seller_lat"),
                          F.col("geolocation_lng").alias("seller_lng"))
    d = (d.join(cust_geo, "customer_zip_code_prefix", "left")
         .join(sell_geo, "seller_zip_code_prefix", "left"))
    return d.withColumn("distance_km", C.haversine_km("customer_lat", "customer_lng",
                                                      "seller_lat", "seller_lng"))


def items_of_orders(t: dict[str, DataFrame], orders: DataFrame) -> DataFrame:
    """P02 without geography, for some orders: ``orders`` has their ids and the order columns wanted.  Items meet the orders
    first, so those of other orders are never moved to products and sellers."""
    return (t["order_items"].join(orders, "order_id", "inner")
            .join(dim_products(t), "product_id", "left")
            .join(t["sellers"], "seller_id", "left"))


def single_seller_places(t: dict[str, DataFrame], orders: DataFrame, geo: DataFrame) -> DataFrame:
    """J06 for some orders, from one row an order in place of its items: ``orders`` has order_id, seller_count and
    only_seller.  An order id that comes twice has the places of all its rows."""
    one = (orders.filter(F.col("seller_count") == 1).groupBy("order_id")
           .agg(F.max("seller_count").alias("seller_count"), F.max("only_seller").alias("seller_id")))
    d = (t["orders"].select("order_id", "customer_id").join(one, "order_id", "inner")
         .join(t["customers"], "customer_id", "left")
         .join(t["sellers"], "seller_id", "left")
         .withColumn("same_state", C.same_state()))
    return single_seller_geo(with_distance(d, geo))


def single_seller_geo(fact_items: DataFrame) -> DataFrame:
    """same_state and distance for single-seller orders (one per order)."""
    return (fact_items.filter(F.col("seller_count") == 1)
            .groupBy("order_id")
            .agg(F.max("same_state").alias("same_state"), F.max("distance_km").alias("distance_km")))


@dataclass
class Model:
    fact_orders: DataFrame
    fact_items: DataFrame
    fact_orders_base: DataFrame
    geo: DataFrame | None
    params: StudyParams
    tables: dict[str, DataFrame] | None = None


def build_model(t: dict[str, DataFrame], p: StudyParams) -> Model:
    """P01 + P02: the complete order fact (with single-seller geography) and
    the item fact."""
    base = build_fact_orders_base(t, p)
    geo = geo_median(t["geolocation"])
    items = build_fact_items(t, base, geo)
    f = base.join(single_seller_geo(items), "order_id", "left")
    return Model(fact_orders=f, fact_items=items, fact_orders_base=base, geo=geo, params=p, tables=t)


def build_light_model(t: dict[str, DataFrame], p: StudyParams) -> Model:
    """The facts without geography (no same_state / distance on orders, null
    distance on items), for queries that never read them."""
    base = build_fact_orders_base(t, p)
    items = build_fact_items(t, base, with_geo=False)
    return Model(fact_orders=base, fact_items=items, fact_orders_base=base, geo=None, params=p, tables=t)


# Columns of the order fact that the BI tables read, and those that decide between orders of the same id.
BI_ORDER_COLUMNS = {"order_id", "customer_unique_id", "order_status", "order_purchase_timestamp", "order_delivered_customer_date",
                    "order_estimated_delivery_date", "customer_zip_code_prefix", "customer_city", "customer_state", "item_count",
                    "seller_count", "item_value", "freight_value", "payment_total", "payment_type", "max_installments",
                    "review_answer_timestamp", "review_score", "purchase_date", "purchase_month", "gross_value", "delivery_days",
                    "delay_days", "is_late", "bad_review", "analysis_period"}


def with_written_orders(m: Model) -> Model:
    """A light model whose order fact is written once as a Parquet table in the shared folder, with the columns that the BI
    tables read: facts, cohorts, ratings and items all read it, and each would build it again from the children of all orders."""
    f = m.fact_orders.select(*[c for c in m.fact_orders.columns if c in BI_ORDER_COLUMNS])
    path = scratch_path(f.sparkSession, "orders")
    f.write.parquet(path)
    f = f.sparkSession.read.schema(f.schema).parquet(path)
    return Model(fact_orders=f, fact_items=build_fact_items(m.tables, f, with_geo=False), fact_orders_base=f, geo=None, params=m.params, tables=m.tables)


def main_population(f: DataFrame) -> DataFrame:
    """In the analysis period and delivered."""
    return f.filter((F.col("analysis_period") == 1) & (F.col("order_status") == "delivered"))


def review_after_receipt(f: DataFrame) -> DataFrame:
    """Review answered at or after receipt (both present)."""
    return f.filter(F.col("review_answer_timestamp") >= F.col("order_delivered_customer_date"))


def first_per_customer(f: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """First order per customer by purchase time then order id."""
    cols = columns or [c for c in f.columns if c not in ("customer_unique_id",)]
    return first_per_key(f, "customer_unique_id", ["order_purchase_timestamp", "order_id"], cols)


def rated_population(f: DataFrame) -> DataFrame:
    """Delivered in period, scored, lateness known, review after receipt,
    first such order per customer."""
    return first_per_customer(rated_of(main_population(f)))


def rated_of(d: DataFrame) -> DataFrame:
    """The orders of the main population that the rated one picks from."""
    return review_after_receipt(d.filter(F.col("review_score").isNotNull() & F.col("is_late").isNotNull()))


def single_seller_population(f: DataFrame) -> DataFrame:
    """Delivered in period, one seller, geography known, first per customer."""
    s = main_population(f).filter((F.col("seller_count") == 1) & F.col("same_state").isNotNull())
    return first_per_customer(s)


def first_order_population(f: DataFrame) -> DataFrame:
    """First delivered order per customer in the period."""
    return first_per_customer(main_population(f))


def build_customer_cohorts(f: DataFrame, p: StudyParams) -> DataFrame:
    """P03 + P04 + J07 + J08: first delivered purchase up to the observation
    end, repeat flags within the window and eligibility flags.

    The anchor is the first order, so each order is joined to exactly one
    anchor row per customer (N:1) and the repeat test is a ``max`` of a
    condition: no self join fan-out, no range join."""
    end = F.lit(p.observation_end).cast("timestamp_ntz")
    window = p.repeat_window_days
    d = f.filter((F.col("order_status") == "delivered") & (F.col("order_purchase_timestamp") <= end))
    first = first_per_key(d, "customer_unique_id", ["order_purchase_timestamp", "order_id"],
                          ["order_delivered_customer_date", "customer_state", "item_value", "is_late"])
    first = (first.withColumnRenamed("order_id", "first_order_id")
             .withColumnRenamed("order_purchase_timestamp", "first_purchase"))
    x = (d.select("customer_unique_id", "order_id", "order_purchase_timestamp")
         .join(first.select("customer_unique_id", "first_order_id", "first_purchase",
                            F.col("order_delivered_customer_date").alias("_first_received")),
               "customer_unique_id"))
    other = F.col("order_id") != F.col("first_order_id")
    delta = C.days_between("first_purchase", "order_purchase_timestamp")
    after = C.days_between("_first_received", "order_purchase_timestamp")
    flags = (x.groupBy("customer_unique_id").agg(
        F.max((other & (delta > 0) & (delta <= window)).cast("int")).alias("repeat_90"),
        F.max(F.coalesce(other & (after > 0) & (after <= window), F.lit(False)).cast("int"))
        .alias("repeat_after_delivery_90")))
    cutoff = F.date_trunc("MONTH", end - F.expr(f"INTERVAL {window} DAYS"))
    return (first.join(flags, "customer_unique_id", "left")
            .withColumn("eligible_90", (F.col("first_purchase") < cutoff).cast("int"))
            .withColumn("eligible_postdelivery_90", F.coalesce(
                F.col("order_delivered_customer_date") <= end - F.expr(f"INTERVAL {window} DAYS"),
                F.lit(False)).cast("int"))
            .withColumn("cohort_month", F.date_format("first_purchase", "yyyy-MM")))
