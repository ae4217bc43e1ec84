"""Aggregation operators (G-family) and the child aggregates of the fact model.

Each child table (items, payments, reviews) is aggregated to one row per order
*before* it meets the orders table, so joins stay one-to-one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.operators.quantiles import exact_quantiles


def item_totals(items: DataFrame, key: str = "order_id", only_seller: bool = False) -> DataFrame:
    """Rows, distinct sellers, sum of price and of freight per order; with
    ``only_seller`` also the seller of orders that have one.

    The sellers of an order are gathered with ``collect_set``, in one shuffle of
    rows combined map-side; ``count_distinct`` moves a row per order and seller
    twice.  A set holds the distinct sellers of one order."""
    totals = items.groupBy(key).agg(
        F.count(F.lit(1)).alias("item_count"),
        F.collect_set("seller_id").alias("_sellers"),
        F.sum("price").alias("item_value"),
        F.sum("freight_value").alias("freight_value"))
    seller_count = F.size("_sellers").cast("long")
    only = [F.when(seller_count == 1, F.col("_sellers")[0]).alias("only_seller")] if only_seller else []
    return totals.select(key, "item_count", seller_count.alias("seller_count"), "item_value", "freight_value", *only)


def payment_totals(payments: DataFrame, key: str = "order_id") -> DataFrame:
    """G02 + G03: payment sum, rows, distinct types, max instalments and the
    single payment type, or ``mixed`` when the count of distinct types is not 1.

    The types are gathered with ``collect_set`` (a handful per order at most),
    which runs as an object hash aggregate in one shuffle; ``count_distinct``
    would add an expand and a second shuffle, and ``max`` of a string would
    force a sort-based aggregate."""
    return (payments.groupBy(key).agg(
        F.sum("payment_value").alias("payment_total"),
        F.count(F.lit(1)).alias("payment_rows"),
        F.max("payment_installments").alias("max_installments"),
        F.collect_set("payment_type").alias("_types"))
        .withColumn("payment_types", F.size("_types").cast("long"))
        .withColumn("payment_type", F.when(F.col("payment_types") == 1, F.col("_types")[0])
                    .otherwise(F.lit("mixed")))
        .drop("_types"))


def geo_median(geo: DataFrame, key: str = "geolocation_zip_code_prefix",
               lat: str = "geolocation_lat", lng: str = "geolocation_lng",
               bbox: tuple[float, float, float, float] = (-34.0, 6.0, -74.0, -34.0),
               exact: bool = True) -> DataFrame:
    """Median latitude and longitude per postal prefix over plausible
    points only (inside the country box).  A prefix may hold any number of
    points; ``exact=False`` uses ``percentile_approx``."""
    lat_lo, lat_hi, lng_lo, lng_hi = bbox
    ok = F.col(lat).between(lat_lo, lat_hi) & F.col(lng).between(lng_lo, lng_hi)
    if not exact:
        return geo.filter(ok).groupBy(key).agg(*[F.percentile_approx(c, 0.5, 10000).alias(c) for c in (lat, lng)])
    # Both coordinates take one pass: (prefix, which, value).
    both = F.array(F.struct(F.lit(0).alias("_axis"), F.col(lat).cast("double").alias("_x")),
                   F.struct(F.lit(1).alias("_axis"), F.col(lng).cast("double").alias("_x")))
    medians = exact_quantiles(geo.filter(ok).select(key, F.inline(both)), [key, "_axis"], "_x", {"_median": 0.5})
    return medians.groupBy(key).agg(*[F.max(F.when(F.col("_axis") == a, F.col("_median"))).alias(c) for a, c in enumerate((lat, lng))])


def ratio(num: Column, den: Column) -> Column:
    """DIVIDE(): null on a zero or null denominator."""
    return F.try_divide(num.cast("double"), F.nullif(den, F.lit(0)).cast("double"))


def mean_exact(c: Column) -> Column:
    """Average of an integer or decimal column as sum / count, computed from the
    exact sum so every engine gives the same double."""
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))


def money(c: Column) -> Column:
    """Output form of a money total: exact decimal sum shown as double."""
    return c.cast("double")


def boxplot_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles and 1.5 IQR whiskers per group, outliers dropped.

    Quartiles come from a distributed selection; whiskers are the extreme
    observed values inside the fences, found among the distinct values."""
    q = exact_quantiles(df, [group], value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    spread = F.col("q3") - F.col("q1")
    fences = q.select(F.col(group).alias("_g"), (F.col("q1") - 1.5 * spread).alias("_lo"), (F.col("q3") + 1.5 * spread).alias("_hi"))
    seen = df.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("_c"))
    fenced = (seen.join(fences, seen[group].eqNullSafe(fences["_g"])).filter(F.col(value).between(F.col("_lo"), F.col("_hi")))
              .groupBy("_g").agg(F.min(value).alias("whisker_low"), F.max(value).alias("whisker_high")))
    return q.join(fenced, q[group].eqNullSafe(fenced["_g"]), "left").drop("_g")


def score_distribution(df: DataFrame, score: str = "review_score") -> DataFrame:
    """Count per score value (null scores excluded)."""
    return df.filter(F.col(score).isNotNull()).groupBy(score).agg(F.count(F.lit(1)).alias("reviews"))


def grouped(df: DataFrame, by: Sequence[str], **aggs: Column) -> DataFrame:
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in aggs.items()])
