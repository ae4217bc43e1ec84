"""The hypothesis register (H01-H26): populations, tests, BH correction and
conclusions, as one DataFrame with one row per hypothesis.

Populations (P06-P08) are written once because many tests read them; each
test reduces its population to one row of sufficient statistics.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.operators import stats as S
from mercato.operators.aggregates import mean_exact
from mercato.session import remove_written, written_once
from mercato.functions import columns as C
from mercato.plans import aggregates as A
from mercato.plans.model import (Model, StudyParams, build_customer_cohorts, build_fact_orders_base, first_order_population,
                                 items_of_orders, main_population, rated_population, single_seller_places,
                                 single_seller_population)


@dataclass(frozen=True)
class HypothesisParams:
    """Values that name members of the data (fixed per dataset)."""
    card_type: str = "credit_card"
    boleto_type: str = "boleto"
    big_state: str = "SP"
    peak_month: int = 11


SCHEMA_COLS = ["id", "theme", "method", "direction", "n_a", "n_b", "effect", "ci_low", "ci_high",
               "p_value", "observed", "conclusion"]


def _row(df: DataFrame, hid: str, theme: str, method: str, direction: float | None, **cols: Column) -> DataFrame:
    base = {"id": F.lit(hid), "theme": F.lit(theme), "method": F.lit(method),
            "direction": F.lit(direction).cast("double"),
            "n_a": F.lit(None).cast("long"), "n_b": F.lit(None).cast("long"),
            "effect": F.lit(None).cast("double"), "ci_low": F.lit(None).cast("double"),
            "ci_high": F.lit(None).cast("double"), "p_value": F.lit(None).cast("double"),
            "observed": F.lit(None).cast("double"), "conclusion": F.lit(None).cast("string")}
    base.update(cols)
    return df.select(*[base[c].cast(_TYPES[c]).alias(c) for c in SCHEMA_COLS])


_TYPES = {"id": "string", "theme": "string", "method": "string", "direction": "double", "n_a": "long",
          "n_b": "long", "effect": "double", "ci_low": "double", "ci_high": "double", "p_value": "double",
          "observed": "double", "conclusion": "string"}


def _desc(df: DataFrame, hid: str, theme: str, observed: Column, supported: Column) -> DataFrame:
    return _row(df, hid, theme, "Descriptif", None, observed=observed,
                conclusion=S.describe(observed, supported))


def _spearman(df: DataFrame, hid: str, theme: str, x: str, y: str, direction: float) -> DataFrame:
    s = S.spearman_test(df, x, y)
    return _row(s, hid, theme, "Spearman, bilateral", direction, n_a=F.col("n"), effect=F.col("rho"),
                p_value=F.col("p_value"))


# Columns of the facts that the register reads.
ORDER_COLUMNS = ["order_id", "customer_unique_id", "order_status", "order_purchase_timestamp", "analysis_period",
                 "order_delivered_customer_date", "review_answer_timestamp", "review_score", "has_comment", "is_late",
                 "delivery_days", "delay_days", "handoff_days", "item_count", "seller_count", "same_state", "distance_km",
                 "customer_state", "item_value", "gross_value", "freight_share", "payment_gap", "payment_type",
                 "max_installments"]
GEO_COLUMNS = ["same_state", "distance_km"]
ITEM_COLUMNS = ["order_id", "seller_id", "category", "price", "freight_value", "item_count", "review_score",
                "product_weight_g", "product_photos_qty"]
# Those that the rank correlations read.  Of orders all before ``customer_state``: rows of one customer, time and order id
# are told apart by their columns from the left.
SPEARMAN_ORDERS = ORDER_COLUMNS[:ORDER_COLUMNS.index("customer_state")]
SPEARMAN_ITEMS = ["order_id", "freight_value", "item_count", "review_score", "product_weight_g", "product_photos_qty"]
# The Kruskal test reads of orders which are rated, of items the score by category.
KRUSKAL_ORDERS = ["order_id", "customer_unique_id", "order_status", "order_purchase_timestamp", "analysis_period",
                  "order_delivered_customer_date", "review_answer_timestamp", "review_score", "is_late", "item_count"]
KRUSKAL_ITEMS = ["order_id", "category", "item_count", "review_score"]


class Populations:
    """The study populations, built on first use.  With ``persist`` the delivered orders, the delivered items and each
    population that picks one order a customer are written once as Parquet tables in the shared
    ``spark.checkpoint.dir``, with the columns that the register reads: a dozen tests read each of them, and the cut
    lineage keeps the 26-branch register plan small.  Each is built from those written before it, so the children of
    orders are aggregated once, one after the other; the shuffles of a table are gone before the next one is built.  Filters of a written
    table are read from it, not written again.  Populations a query does not read are never built; without ``geo`` the
    orders are built without their places.  A query that reads less of the facts names the columns of orders and items,
    and with ``one_item`` it has no items of orders of several (``sr`` and ``one`` read no others)."""

    def __init__(self, m: Model, persist: bool = True, geo: bool = True, orders: Sequence[str] = ORDER_COLUMNS,
                 items: Sequence[str] = ITEM_COLUMNS, one_item: bool = False):
        self.m, self.persist, self.geo = m, persist, geo
        self.columns = [c for c in orders if geo or c not in GEO_COLUMNS]
        self.item_columns, self.one_item = list(items), one_item

    def _keep(self, df: DataFrame) -> DataFrame:
        return written_once(df, "population") if self.persist else df

    @cached_property
    def _written(self) -> DataFrame:
        """The delivered orders without places, with the seller that ``f`` looks up: no population holds others."""
        columns = [c for c in self.columns if c not in GEO_COLUMNS] + (["only_seller"] if self.geo else [])
        children: list[DataFrame] = []

        def keep(child: DataFrame) -> DataFrame:
            children.append(written_once(child, "children"))
            return children[-1]
        base = build_fact_orders_base(self.m.tables, self.m.params, self.geo, columns, keep if self.persist else None)
        orders = self._keep(base.filter(F.col("order_status") == "delivered").select(*columns))
        for child in children:
            remove_written(child)
        return orders

    @cached_property
    def orders(self) -> DataFrame:
        """The delivered orders without their places."""
        return self._written.drop("only_seller")

    @cached_property
    def f(self) -> DataFrame:
        """The delivered orders, with places if asked for."""
        if not self.geo:
            return self.orders
        places = single_seller_places(self.m.tables, self._written, self.m.geo)
        return self.orders.join(places, "order_id", "left").select(*self.columns)

    @cached_property
    def d(self) -> DataFrame:
        return main_population(self.orders)

    @cached_property
    def di(self) -> DataFrame:
        orders = self.d.select("order_id", "review_score", "item_count")
        if self.one_item:
            orders = orders.filter(F.col("item_count") == 1)
        return self._keep(items_of_orders(self.m.tables, orders).select(*self.item_columns))

    @cached_property
    def rated(self) -> DataFrame:
        return self._keep(rated_population(self.orders))

    @cached_property
    def single(self) -> DataFrame:
        return self._keep(single_seller_population(self.f))

    @cached_property
    def payd(self) -> DataFrame:
        return self._keep(first_order_population(self.orders))

    @cached_property
    def cohorts(self) -> DataFrame:
        return self._keep(build_customer_cohorts(self.orders, self.m.params))

    @cached_property
    def delivered_obs(self) -> DataFrame:
        end = F.lit(self.m.params.observation_end).cast("timestamp_ntz")
        return self.orders.filter((F.col("order_status") == "delivered") & (F.col("order_purchase_timestamp") <= end))

    @cached_property
    def sr(self) -> DataFrame:
        return self.di.filter(F.col("item_count") == 1).join(self.rated.select("order_id"), "order_id", "left_semi")

    @cached_property
    def one(self) -> DataFrame:
        return self.di.filter(F.col("item_count") == 1).join(self.payd.select("order_id"), "order_id", "left_semi")


def populations(m: Model, persist: bool = True, geo: bool = True, **narrow) -> Populations:
    return Populations(m, persist, geo, **narrow)


def welch_specs(P: Populations, hp: HypothesisParams):
    """(id, theme, base population, sub-population condition, flag, metric, direction)."""
    r = P.rated
    return [
        ("H10", "Satisfaction", r, None, F.col("is_late") == 1, "review_score", -1.0),
        ("H12", "Livraison", r, None, F.col("delivery_days") > 15, "review_score", -1.0),
        ("H13", "Geographie", P.single, None, F.col("same_state") == 0, "delivery_days", 1.0),
        ("H15", "Prix", r, F.col("freight_share").isNotNull(), F.col("freight_share") > 0.2, "review_score", -1.0),
        ("H16", "Vendeurs", r, F.col("seller_count").isNotNull(), F.col("seller_count") > 1, "review_score", -1.0),
        ("H17", "Produits", r, F.col("item_count").isNotNull(), F.col("item_count") > 1, "review_score", -1.0),
        ("H18", "Paiement", P.payd, (F.col("payment_type") == hp.card_type) & (F.col("max_installments") >= 1),
         F.col("max_installments") > 1, "gross_value", 1.0),
        ("H19", "Paiement", P.payd, F.col("payment_type").isin(hp.card_type, hp.boleto_type),
         F.col("payment_type") == hp.card_type, "gross_value", 1.0),
        ("H23", "Satisfaction", r, None, F.col("has_comment") == 1, "review_score", -1.0),
        ("H24", "Fidelisation", P.cohorts, (F.col("eligible_postdelivery_90") == 1) & F.col("is_late").isNotNull(),
         F.col("is_late") == 1, "repeat_after_delivery_90", -1.0),
    ]


def welch_stats(P: Populations, hp: HypothesisParams) -> DataFrame:
    """Sufficient statistics of every Welch hypothesis: one aggregation pass
    per base population (rated, single-seller, first orders, cohorts)."""
    groups: dict[int, tuple[DataFrame, list]] = {}
    for hid, _, base, cond, flag, metric, _ in welch_specs(P, hp):
        groups.setdefault(id(base), (base, []))[1].append((hid, cond, flag, metric))
    out = None
    for base, specs in groups.values():
        part = S.welch_sufficient_many(base, specs)
        out = part if out is None else out.unionByName(part)
    return out


def spearman_specs(P: Populations):
    return [
        ("H11", "Satisfaction", P.rated.filter(F.col("is_late") == 1), "delay_days", "review_score", -1.0),
        ("H14", "Geographie", P.single, "distance_km", "delivery_days", 1.0),
        ("H21", "Logistique", P.one, "product_weight_g", "freight_value", 1.0),
        ("H22", "Produits", P.sr, "product_photos_qty", "review_score", 1.0),
        ("H26", "Logistique", P.single, "handoff_days", "delay_days", 1.0),
    ]


def descriptive_rows(P: Populations, m: Model, hp: HypothesisParams) -> list[DataFrame]:
    p = m.params
    y1 = int(p.period_start[:4])
    d = P.d
    same = d.filter(F.month("order_purchase_timestamp") <= 8)
    yr = F.year("order_purchase_timestamp")
    win = same.agg(F.count_if(yr == y1).alias("n1"), F.count_if(yr == y1 + 1).alias("n2"),
                   mean_exact(F.when(yr == y1, F.col("item_value"))).alias("a1"),
                   mean_exact(F.when(yr == y1 + 1, F.col("item_value"))).alias("a2"))
    g1 = F.col("n2") / F.col("n1") - 1
    g2 = F.col("a2") / F.col("a1") - 1
    peak = A.arg_max_month(P.orders.withColumn("purchase_month", C.purchase_month()), y1)
    wk = A.weekday_weekend_rate(P.orders, p)
    cat = A.top_share_of(P.di, "category", 10)
    sellers = P.di.groupBy("seller_id").agg(F.sum("price").alias("gmv"))
    n_sellers = sellers.agg(F.count(F.lit(1)).alias("_n"), F.sum("gmv").alias("_all"))
    from mercato.operators.ranks import global_row_number
    ranked = global_row_number(sellers, [("gmv", False), ("seller_id", True)], "_rk")
    top_sellers = ranked.crossJoin(F.broadcast(n_sellers)).agg(
        (F.sum(F.when(F.col("_rk") <= F.ceil(F.col("_n") * 0.2), F.col("gmv")).otherwise(0)).cast("double")
         / F.max("_all").cast("double")).alias("share"))
    state = d.agg((F.sum(F.when(F.col("customer_state") == hp.big_state, F.col("item_value")).otherwise(0))
                   .cast("double") / F.sum("item_value").cast("double")).alias("share"))
    per_cust = P.delivered_obs.groupBy("customer_unique_id").agg(F.count(F.lit(1)).alias("_n"))
    several = per_cust.agg(mean_exact((F.col("_n") > 1).cast("int")).alias("share"))
    rep90 = P.cohorts.filter(F.col("eligible_90") == 1).agg(mean_exact(F.col("repeat_90")).alias("rate"))
    recon = d.filter(F.col("payment_gap").isNotNull()).agg(
        (1 - F.count_if(F.abs(F.col("payment_gap")) > 0.010001) / F.count(F.lit(1))).alias("match"))
    return [
        _desc(win, "H01", "Ventes", g1, g1 > 0),
        _desc(win, "H02", "Ventes", g2, g2 > 0),
        _desc(peak, "H03", "Ventes", F.month(F.to_date(F.concat(F.col("purchase_month"), F.lit("-01")))).cast("double"),
              F.col("purchase_month") == F.lit(f"{y1}-{hp.peak_month:02d}")),
        _desc(wk, "H04", "Ventes", F.col("weekend_per_day") / F.col("weekday_per_day"),
              F.col("weekend_per_day") < F.col("weekday_per_day")),
        _desc(cat, "H05", "Produits", F.col("top_share"), F.col("top_share") > 0.5),
        _desc(top_sellers, "H06", "Vendeurs", F.col("share"), F.col("share") >= 0.8),
        _desc(state, "H07", "Geographie", F.col("share"), F.col("share") > 0.4),
        _desc(several, "H08", "Fidelisation", F.col("share"), F.col("share") < 0.1),
        _desc(rep90, "H09", "Fidelisation", F.col("rate"), F.col("rate") < 0.05),
        _desc(recon, "H25", "Qualite", F.col("match"), F.col("match") >= 0.99),
    ]


def hypothesis_register(m: Model, hp: HypothesisParams = HypothesisParams()) -> DataFrame:
    """H-R: 26 rows with effect, CI, p, BH q over the inferential tests and a
    conclusion for every row."""
    P = populations(m)
    rows = descriptive_rows(P, m, hp)
    spark = m.fact_orders.sparkSession
    meta = spark.createDataFrame([(h, th, dr) for h, th, _, _, _, _, dr in welch_specs(P, hp)],
                                 "id string, theme string, direction double")
    closed = S.welch_close(welch_stats(P, hp)).join(F.broadcast(meta), "id")
    cols = {"id": F.col("id"), "theme": F.col("theme"), "method": F.lit("Welch, bilateral"),
            "direction": F.col("direction"), "n_a": F.col("n_a"), "n_b": F.col("n_b"), "effect": F.col("effect"),
            "ci_low": F.col("ci_low"), "ci_high": F.col("ci_high"), "p_value": F.col("p_value"),
            "observed": F.lit(None), "conclusion": F.lit(None)}
    rows.append(closed.select(*[cols[c].cast(_TYPES[c]).alias(c) for c in SCHEMA_COLS]))
    rows += [_spearman(df, h, th, x, y, dr) for h, th, df, x, y, dr in spearman_specs(P)]
    k = S.kruskal_test(P.sr, "category", "review_score", top_k=10)
    rows.append(_row(k, "H20", "Produits", "Kruskal-Wallis, omnibus", 1.0, n_a=F.col("n"), effect=F.col("h"),
                     p_value=F.col("p_value")))
    # One small job a part: the plan of all parts together fills the driver, and their shuffles the disk.
    parts = [written_once(r.coalesce(1), "part") for r in rows]
    # The correction reads the p-values twice and joins them on their value: sums of doubles may differ in the last
    # digits when rows are added in another order, so the tests run once and their rows are written.
    reg = written_once(reduce(DataFrame.unionByName, parts).coalesce(1), "register")
    for part in parts:
        remove_written(part)
    return S.conclude(S.benjamini_hochberg(reg, "p_value", "q_bh"))


def welch_table(m: Model, hp: HypothesisParams = HypothesisParams()) -> DataFrame:
    """Sufficient statistics and Welch df / SE for every Welch hypothesis."""
    P = populations(m)
    st = welch_stats(P, hp)
    vx, vy = F.col("var_a") / F.col("n_a"), F.col("var_b") / F.col("n_b")
    return st.select("id", "n_a", "n_b", F.round(F.col("mean_a") - F.col("mean_b"), 6).alias("effect"),
                     F.round(F.sqrt(vx + vy), 6).alias("se"),
                     F.round(F.pow(vx + vy, 2) / (F.pow(vx, 2) / (F.col("n_a") - 1)
                                                  + F.pow(vy, 2) / (F.col("n_b") - 1)), 4).alias("df"))


def spearman_table(m: Model) -> DataFrame:
    P = populations(m, orders=SPEARMAN_ORDERS, items=SPEARMAN_ITEMS, one_item=True)
    out = None
    for h, _, df, x, y, _ in spearman_specs(P):
        s = S.spearman_rho(df, x, y).select(F.lit(h).alias("id"), "n", F.round("rho", 9).alias("rho"))
        out = s if out is None else out.unionByName(s)
    return out


def kruskal_table(m: Model) -> DataFrame:
    P = populations(m, geo=False, orders=KRUSKAL_ORDERS, items=KRUSKAL_ITEMS, one_item=True)
    return S.kruskal_statistic(P.sr, "category", "review_score", top_k=10).select(
        "n", "k", F.round("h", 6).alias("h"))
