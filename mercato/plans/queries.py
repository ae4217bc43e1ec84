"""The study's named SQL questions (SQ00-SQ15) as DataFrame plans.

Each function takes the fact tables and returns a DataFrame whose column
names match the reference SQL.  Money totals are exact decimal sums shown as
double; averages of integer or decimal columns are exact sum / count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions import columns as C
from mercato.operators.aggregates import mean_exact, money
from mercato.operators.ranks import global_row_number
from mercato.operators.windows import lag_growth, latest_review, share_of_total
from mercato.plans.model import main_population, review_after_receipt, first_per_customer


def v_order_summary(t: dict[str, DataFrame]) -> DataFrame:
    """SQ00: one row per order from the raw tables, children aggregated first."""
    items = t["order_items"].groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_count"), F.count_distinct("seller_id").alias("seller_count"),
        F.sum("price").alias("item_value"), F.sum("freight_value").alias("freight_value"))
    pays = t["order_payments"].groupBy("order_id").agg(F.sum("payment_value").alias("payment_total"))
    rev = latest_review(t["order_reviews"], payload=("review_score",))
    return (t["orders"].join(t["customers"], "customer_id", "left")
            .join(items, "order_id", "left").join(pays, "order_id", "left")
            .join(rev, "order_id", "left")
            .select("order_id", "order_status", "order_purchase_timestamp", "customer_unique_id",
                    "customer_state", "item_count", "seller_count",
                    money(F.col("item_value")).alias("item_value"),
                    money(F.col("freight_value")).alias("freight_value"),
                    money(F.col("payment_total")).alias("payment_total"), "review_score"))


def q01_status_mix(t: dict[str, DataFrame]) -> DataFrame:
    counts = t["orders"].groupBy("order_status").agg(F.count(F.lit(1)).alias("orders"))
    return share_of_total(counts, "orders", "share_pct", 100.0, 2)


def q02_kpis(f: DataFrame) -> DataFrame:
    d = main_population(f)
    return d.agg(
        F.count(F.lit(1)).alias("delivered_orders"),
        F.round(money(F.sum("item_value")), 2).alias("gmv_brl"),
        F.round(mean_exact(F.col("item_value")), 2).alias("aov_brl"),
        F.round(mean_exact(F.col("review_score")), 3).alias("mean_review"),
        F.count("is_late").alias("logistics_denominator"),
        F.round(F.lit(100.0) * mean_exact(F.col("is_late")), 2).alias("late_pct"))


def q03_monthly_growth(f: DataFrame) -> DataFrame:
    m = main_population(f).groupBy("purchase_month").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("item_value").alias("_gmv"))
    return (lag_growth(m, "purchase_month", "orders", "mom_pct")
            .select("purchase_month", "orders", F.round(money(F.col("_gmv")), 2).alias("gmv"), "mom_pct"))


def q04_same_months_yoy(f: DataFrame, last_month: int = 8) -> DataFrame:
    d = main_population(f).filter(F.month("order_purchase_timestamp") <= last_month)
    return (d.groupBy(F.date_format("order_purchase_timestamp", "yyyy").alias("year"))
            .agg(F.count(F.lit(1)).alias("orders"),
                 F.round(money(F.sum("item_value")), 2).alias("gmv"),
                 F.round(mean_exact(F.col("item_value")), 2).alias("average_basket")))


def delivered_items(fi: DataFrame) -> DataFrame:
    return main_population(fi)


def q05_top_categories(fi: DataFrame, top: int = 15) -> DataFrame:
    g = delivered_items(fi).groupBy("category").agg(
        F.count(F.lit(1)).alias("items"), F.count_distinct("order_id").alias("orders"),
        F.sum("price").alias("_gmv"))
    return (g.orderBy(F.col("_gmv").desc(), F.col("category").asc()).limit(top)
            .select("category", "items", "orders", F.round(money(F.col("_gmv")), 2).alias("gmv")))


def seller_gmv(fi: DataFrame) -> DataFrame:
    return delivered_items(fi).groupBy("seller_id").agg(F.sum("price").alias("gmv"))


def q06_seller_concentration(fi: DataFrame, share: float = 0.2) -> DataFrame:
    """Share of GMV held by the top ceil(share * sellers) sellers.  The rank is
    the distributed row number; totals are one-row aggregates."""
    s = seller_gmv(fi)
    ranked = global_row_number(s, [("gmv", False), ("seller_id", True)], "rank")
    tot = s.agg(F.count(F.lit(1)).alias("total_sellers"), F.sum("gmv").alias("total_gmv"))
    k = F.ceil(F.col("total_sellers") * F.lit(share))
    return (ranked.crossJoin(F.broadcast(tot))
            .agg((F.sum(F.when(F.col("rank") <= k, F.col("gmv")).otherwise(F.lit(0))).cast("double")
                  / F.max("total_gmv").cast("double")).alias("top20_seller_gmv_share")))


def q07_late_vs_score(f: DataFrame) -> DataFrame:
    e = (main_population(f)
         .filter(F.col("is_late").isNotNull() & F.col("review_score").isNotNull())
         .transform(review_after_receipt))
    first = first_per_customer(e, ["order_id", "is_late", "review_score", "bad_review"])
    return first.groupBy("is_late").agg(
        F.count(F.lit(1)).alias("orders"), mean_exact(F.col("review_score")).alias("mean_review"),
        mean_exact(F.col("bad_review")).alias("bad_review_rate"))


def q08_geography(f: DataFrame, min_orders: int = 500) -> DataFrame:
    return (main_population(f).groupBy("customer_state").agg(
        F.count(F.lit(1)).alias("orders"), F.count("is_late").alias("valid_dates"),
        F.round(F.avg("delivery_days"), 6).alias("delivery_days"),
        mean_exact(F.col("is_late")).alias("late_rate"),
        money(F.sum("item_value")).alias("gmv"))
        .filter(F.col("orders") >= min_orders))


def q09_sellers_to_review(fi: DataFrame, min_valid: int = 100, top: int = 20) -> DataFrame:
    so = delivered_items(fi).select("seller_id", "order_id", "is_late", "review_score").distinct()
    g = so.groupBy("seller_id").agg(
        F.count(F.lit(1)).alias("orders"), F.count("is_late").alias("valid_dates"),
        mean_exact(F.col("is_late")).alias("late_rate"),
        mean_exact(F.col("review_score")).alias("mean_review"))
    return (g.filter(F.col("valid_dates") >= min_valid)
            .orderBy(F.col("late_rate").desc_nulls_last(), F.col("seller_id").asc()).limit(top))


def q10_cohorts(cohorts: DataFrame) -> DataFrame:
    return (cohorts.filter(F.col("eligible_90") == 1).groupBy("cohort_month").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("repeat_90").cast("long").alias("repeat_customers"),
        mean_exact(F.col("repeat_90")).alias("repeat_rate_90")))


def q11_basket_segments(f: DataFrame) -> DataFrame:
    d = main_population(f).filter(F.col("item_count").isNotNull())
    return d.groupBy(C.basket_segment().alias("segment")).agg(
        F.count(F.lit(1)).alias("orders"), mean_exact(F.col("item_value")).alias("average_basket"))


def q12_payments(f: DataFrame) -> DataFrame:
    return main_population(f).groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("orders"), mean_exact(F.col("gross_value")).alias("basket_with_freight"),
        mean_exact(F.col("max_installments")).alias("max_installments_per_order"))


def q13_payment_reconciliation(f: DataFrame, tolerance: float = 0.010001) -> DataFrame:
    d = main_population(f).filter(F.col("payment_gap").isNotNull())
    return d.agg(
        F.count(F.lit(1)).alias("comparable_orders"),
        F.count_if(F.abs(F.col("payment_gap")) > F.lit(tolerance)).alias("mismatch_orders"),
        money(F.sum("payment_gap")).alias("signed_gap"),
        money(F.sum(F.abs("payment_gap"))).alias("absolute_gap"))


def q14_lateness_sensitivity(f: DataFrame) -> DataFrame:
    return main_population(f).agg(
        F.count("is_late").alias("valid_dates"),
        mean_exact(F.col("is_late")).alias("calendar_late_rate"),
        mean_exact(F.col("is_late_timestamp")).alias("timestamp_late_rate"))


def q15_grain(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("order_id").alias("unique_orders"),
        F.sum(F.col("item_value").cast("decimal(18,2)")).cast("double").alias("total_item_value"),
        F.sum(F.col("payment_total").cast("decimal(18,2)")).cast("double").alias("total_payment"))
