"""Study aggregates (P05: G05-G10) and the descriptive tables G12-G19, T02, T03.

Populations are filtered first so the parquet scan sees the predicates;
every grouping key is low-cardinality (month, state, category, seller) and
Spark combines map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions import columns as C
from mercato.operators.aggregates import boxplot_stats, mean_exact, money
from mercato.operators.quantiles import exact_quantiles
from mercato.operators.ranks import running_sums
from mercato.plans.model import (Model, StudyParams, dim_products, main_population, rated_of, rated_population,
                                 review_after_receipt, single_seller_population)
from mercato.session import scratch_path


def monthly(f: DataFrame) -> DataFrame:                                     # G05
    return main_population(f).groupBy("purchase_month").agg(
        F.count(F.lit(1)).alias("orders"), money(F.sum("item_value")).alias("gmv"),
        mean_exact(F.col("item_value")).alias("aov"), mean_exact(F.col("is_late")).alias("late_rate"),
        mean_exact(F.col("review_score")).alias("review_score"))


def states(f: DataFrame) -> DataFrame:                                      # G06
    return main_population(f).groupBy("customer_state").agg(
        F.count(F.lit(1)).alias("orders"), money(F.sum("item_value")).alias("gmv"),
        F.round(F.avg("delivery_days"), 6).alias("delivery_days"),
        mean_exact(F.col("is_late")).alias("late_rate"),
        mean_exact(F.col("review_score")).alias("review_score"))


def categories(fi: DataFrame) -> DataFrame:                                 # G07
    return main_population(fi).groupBy("category").agg(
        F.count(F.lit(1)).alias("items"), F.count_distinct("order_id").alias("orders"),
        money(F.sum("price")).alias("gmv"))


def sellers(fi: DataFrame) -> DataFrame:                                    # G08
    di = main_population(fi)
    items = di.groupBy("seller_id").agg(F.count(F.lit(1)).alias("items"), money(F.sum("price")).alias("gmv"))
    pairs = di.select("seller_id", "order_id", "is_late", "review_score").distinct()   # T07
    per_order = pairs.groupBy("seller_id").agg(
        F.count(F.lit(1)).alias("orders"), F.count("is_late").alias("late_n"),
        mean_exact(F.col("is_late")).alias("late_rate"), F.count("review_score").alias("review_n"),
        mean_exact(F.col("review_score")).alias("review_score"))
    return items.join(per_order, "seller_id")


def review_delay(f: DataFrame) -> DataFrame:                                # G09
    r = rated_population(f)
    return r.groupBy(C.delay_bucket().alias("delay_bucket"),
                     C.delay_bucket_order().alias("bucket_order")).agg(
        F.count(F.lit(1)).alias("orders"), mean_exact(F.col("review_score")).alias("review_score"),
        mean_exact(F.col("bad_review")).alias("bad_review_rate"))


SENSITIVITY_LABELS = ["Tous avis disponibles", "Avis apres reception, tous clients",
                      "Avis apres reception, un par client (H10)"]


def review_sensitivity(f: DataFrame) -> DataFrame:                          # G10, T06
    d = main_population(f)
    pops = [d, review_after_receipt(d), rated_population(f)]
    cols = ["is_late", "review_score", "bad_review"]
    u = None
    for label, pop in zip(SENSITIVITY_LABELS, pops):
        part = pop.select(*cols).withColumn("population", F.lit(label))
        u = part if u is None else u.unionByName(part)
    u = u.filter(F.col("is_late").isNotNull() & F.col("review_score").isNotNull())
    return u.groupBy("population", "is_late").agg(
        F.count(F.lit(1)).alias("n"), mean_exact(F.col("review_score")).alias("review_score"),
        mean_exact(F.col("bad_review")).alias("bad_review_rate"))


def score_distribution(f: DataFrame) -> DataFrame:                          # G12
    return (main_population(f).filter(F.col("review_score").isNotNull())
            .groupBy("review_score").agg(F.count(F.lit(1)).alias("orders")))


def delivery_boxplot(f: DataFrame) -> DataFrame:                            # G13
    geo = main_population(f).filter((F.col("seller_count") == 1) & F.col("same_state").isNotNull()
                                    & F.col("delivery_days").isNotNull())
    return boxplot_stats(geo, "same_state", "delivery_days")


def concentration_curve(fi: DataFrame) -> DataFrame:                        # G14, W08
    s = main_population(fi).groupBy("seller_id").agg(F.sum("price").alias("gmv"))
    tot = s.agg(F.count(F.lit(1)).alias("_n"), F.sum("gmv").alias("_total"))
    s = s.withColumn("_one", F.lit(1))
    cum = running_sums(s, [("gmv", False), ("seller_id", True)], {"seller_rank": "_one", "_cum": "gmv"})
    return (cum.crossJoin(F.broadcast(tot)).select(
        "seller_id", "seller_rank", money(F.col("gmv")).alias("gmv"),
        F.round(F.col("seller_rank") / F.col("_n") * 100.0, 6).alias("seller_pct"),
        F.round(F.col("_cum").cast("double") / F.col("_total").cast("double") * 100.0, 6)
        .alias("cum_gmv_pct")))


STUDY_TABLES = ("monthly", "states", "categories", "sellers", "review_delay", "review_sensitivity")


def study_aggregates(m: Model) -> DataFrame:                               # P05
    """G05 to G10 in one call: (name, key, orders, items, gmv, aov, late_n, late_rate, review_n, review_score,
    bad_review_rate, delivery_days), the columns a table does not have null.

    The delivered population is built once and written, narrow, to the shared folder.  An order then gives one row for
    each table and key it counts in, an item likewise, first summed per order so that distinct orders are exact; one
    grouping by (name, key), combined map-side, makes all six tables."""
    d = main_population(m.fact_orders_base).select(
        "order_id", "customer_unique_id", "order_purchase_timestamp", "order_delivered_customer_date", "review_answer_timestamp",
        "purchase_month", "customer_state", "item_value", "is_late", "review_score", "bad_review", "delivery_days", "delay_days")
    path = scratch_path(d.sparkSession, "study-population")
    d.write.parquet(path)
    d = d.sparkSession.read.schema(d.schema).parquet(path)
    first = rated_of(d).groupBy("customer_unique_id").agg(F.min(F.struct("order_purchase_timestamp", "order_id")).alias("_f"))
    first = first.select(F.col("_f.order_id").alias("_first"))
    d = d.join(first, d["order_id"] == first["_first"], "left")
    after = F.coalesce(F.col("review_answer_timestamp") >= F.col("order_delivered_customer_date"), F.lit(False))
    judged = F.col("is_late").isNotNull() & F.col("review_score").isNotNull()
    rated = F.col("_first").isNotNull()

    def cell(name: str, key: Column, when: Column | None = None) -> Column:
        c = F.struct(F.lit(name).alias("name"), key.cast("string").alias("key"))
        return c if when is None else F.when(when, c)

    def population(label: str) -> Column:
        return F.concat(F.lit(label + "|"), F.col("is_late").cast("string"))

    cells = [cell("monthly", F.col("purchase_month")), cell("states", F.col("customer_state")), cell("review_delay", C.delay_bucket(), rated)]
    cells += [cell("review_sensitivity", population(label), judged & when)
              for label, when in zip(SENSITIVITY_LABELS, (F.lit(True), after, rated))]
    measures = ["is_late", "review_score", "bad_review", "delivery_days"]
    orders = d.select(F.explode(F.array(*cells)).alias("x"), F.lit(0).cast("long").alias("items"), F.col("item_value").alias("gmv"), *measures)
    orders = orders.filter("x IS NOT NULL").select("x.*", "items", "gmv", *measures)
    items = (m.tables["order_items"].join(dim_products(m.tables).select("product_id", "category"), "product_id", "left")
             .join(d.select("order_id", *measures), "order_id"))
    both = F.array(cell("categories", F.col("category")), cell("sellers", F.col("seller_id")))
    items = (items.select("order_id", "price", *measures, F.explode(both).alias("x"))
             .groupBy("x.name", "x.key", "order_id").agg(F.count(F.lit(1)).alias("items"), F.sum("price").alias("gmv"),
                                                         *[F.max(c).alias(c) for c in measures]).drop("order_id"))
    rows = orders.unionByName(items)
    has = lambda c, *names: F.when(F.col("name").isin(*names), c)
    judged_tables = ("review_delay", "review_sensitivity")
    return rows.groupBy("name", "key").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("items").alias("_items"), F.sum("gmv").alias("_gmv"), F.count("gmv").alias("_gmv_n"),
        F.count("is_late").alias("_late_n"), mean_exact(F.col("is_late")).alias("_late"), F.count("review_score").alias("_review_n"),
        mean_exact(F.col("review_score")).alias("_review"), mean_exact(F.col("bad_review")).alias("_bad"), F.avg("delivery_days").alias("_days")).select(
        "name", "key", "orders", has(F.col("_items"), "categories", "sellers").alias("items"),
        has(money(F.col("_gmv")), "monthly", "states", "categories", "sellers").alias("gmv"),
        has(F.try_divide(money(F.col("_gmv")), F.col("_gmv_n").cast("double")), "monthly").alias("aov"),
        has(F.col("_late_n"), "sellers").alias("late_n"), has(F.col("_late"), "monthly", "states", "sellers").alias("late_rate"),
        has(F.col("_review_n"), "sellers").alias("review_n"),
        has(F.col("_review"), "monthly", "states", "sellers", *judged_tables).alias("review_score"),
        has(F.col("_bad"), *judged_tables).alias("bad_review_rate"), has(F.round("_days", 6), "states").alias("delivery_days"))


def calendar_days(start: str, end: str, spark) -> DataFrame:
    """Days of [start, end) with their weekday (Mon = 0); one row per day."""
    return (spark.range(1).select(F.explode(F.sequence(
        F.to_date(F.lit(start)), F.date_sub(F.to_date(F.lit(end)), 1), F.expr("INTERVAL 1 DAY")))
        .alias("day")).withColumn("dow", F.weekday("day")))


def weekday_weekend_rate(f: DataFrame, p: StudyParams) -> DataFrame:        # G15
    d = main_population(f).withColumn("_we", F.weekday("order_purchase_timestamp") >= 5)
    orders = d.agg(F.count_if(F.col("_we")).alias("weekend_orders"),
                   F.count_if(~F.col("_we")).alias("weekday_orders"))
    cal = calendar_days(p.period_start, p.period_end, f.sparkSession).agg(
        F.count_if(F.col("dow") >= 5).alias("weekend_days"), F.count_if(F.col("dow") < 5).alias("weekday_days"))
    return (orders.crossJoin(cal)
            .withColumn("weekend_per_day", F.col("weekend_orders") / F.col("weekend_days"))
            .withColumn("weekday_per_day", F.col("weekday_orders") / F.col("weekday_days")))


def run_summary(f: DataFrame) -> DataFrame:                                 # G16
    d = main_population(f)
    src = f.agg(F.min("order_purchase_timestamp").alias("source_min_purchase"),
                F.max("order_purchase_timestamp").alias("source_max_purchase"),
                F.count(F.lit(1)).alias("source_orders"))
    kp = d.agg(F.count(F.lit(1)).alias("delivered_orders"), money(F.sum("item_value")).alias("gmv"),
               mean_exact(F.col("is_late")).alias("late_rate"),
               mean_exact(F.col("is_late_timestamp")).alias("late_timestamp_rate"),
               mean_exact(F.col("review_score")).alias("avg_review"))
    median = exact_quantiles(d, [], "delivery_days", {"_median": 0.5}).select(F.round("_median", 6).alias("delivery_median"))
    return src.crossJoin(kp).crossJoin(median)


def late_by_month(f: DataFrame) -> DataFrame:                               # G17
    return main_population(f).groupBy("purchase_month").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.when(F.col("is_late") == 1, 1).otherwise(0)).cast("long").alias("late_orders"),
        F.count_if(F.col("review_score") <= 2).alias("bad_reviews"),
        (F.sum(F.when(F.col("is_late") == 1, 1).otherwise(0)) / F.count(F.lit(1))).alias("late_share"))


def nonnull_by_status(f: DataFrame) -> DataFrame:                           # G18
    return f.filter(F.col("analysis_period") == 1).groupBy("order_status").agg(
        F.count(F.lit(1)).alias("orders"), F.count("review_score").alias("scored"),
        mean_exact(F.col("review_score")).alias("mean_score"),
        F.count("delivery_days").alias("timed"), F.round(F.avg("delivery_days"), 6).alias("mean_delivery_days"))


def cohort_table_with_total(cohorts: DataFrame) -> DataFrame:               # G19
    e = cohorts.filter(F.col("eligible_90") == 1)
    return (e.rollup("cohort_month").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("repeat_90").cast("long").alias("repeat_customers"),
        mean_exact(F.col("repeat_90")).alias("repeat_rate_90"),
        F.grouping_id().cast("int").alias("is_total")))


def top_share(fi: DataFrame, key: str = "category", top: int = 10) -> DataFrame:  # T02
    return top_share_of(main_population(fi), key, top)


def top_share_of(di: DataFrame, key: str = "category", top: int = 10) -> DataFrame:
    """T02 over items of the main population."""
    g = di.groupBy(key).agg(F.sum("price").alias("gmv"))
    head = g.orderBy(F.col("gmv").desc(), F.col(key).asc()).limit(top).agg(F.sum("gmv").alias("_top"))
    tot = g.agg(F.sum("gmv").alias("_all"))
    return head.crossJoin(tot).select(
        (F.col("_top").cast("double") / F.col("_all").cast("double")).alias("top_share"))


def arg_max_month(f: DataFrame, year: int) -> DataFrame:                   # T03
    m = (main_population(f).filter(F.year("order_purchase_timestamp") == year)
         .groupBy("purchase_month").agg(F.count(F.lit(1)).alias("orders")))
    return m.orderBy(F.col("orders").desc(), F.col("purchase_month").asc()).limit(1)


def fact_orders_export(f: DataFrame) -> DataFrame:
    """The order fact with every derived column (C01-C16), money as double."""
    money_cols = {"item_value", "freight_value", "gross_value", "payment_total", "payment_gap"}
    out = []
    for c in ["order_id", "customer_unique_id", "customer_state", "order_status", "purchase_date",
              "purchase_month", "item_count", "seller_count", "item_value", "freight_value",
              "gross_value", "freight_share", "payment_total", "payment_gap", "payment_type",
              "max_installments", "review_score", "has_comment", "bad_review", "delivery_days",
              "delay_days", "is_late", "is_late_timestamp", "promise_days", "handoff_days",
              "transit_days", "analysis_period", "same_state", "distance_km"]:
        col = F.col(c)
        if c in money_cols:
            col = money(col)
        elif c in ("freight_share", "distance_km", "delivery_days", "promise_days", "handoff_days",
                   "transit_days"):
            col = F.round(col, 6)
        elif c == "delay_days":
            col = col.cast("bigint")
        out.append(col.alias(c))
    return f.select(*out)


def fact_items_export(fi: DataFrame) -> DataFrame:
    return fi.select("order_id", "order_item_id", "product_id", "seller_id", "category",
                     money(F.col("price")).alias("price"), money(F.col("freight_value")).alias("freight_value"),
                     "customer_state", "seller_state", "same_state",
                     F.round("customer_lat", 6).alias("customer_lat"), F.round("customer_lng", 6).alias("customer_lng"),
                     F.round("seller_lat", 6).alias("seller_lat"), F.round("seller_lng", 6).alias("seller_lng"),
                     F.round("distance_km", 6).alias("distance_km"))
