"""Semantic model: seven BI tables, one-direction many-to-one relationships
and 27 measures evaluated under a filter context (§2.13).

A filter on a table reaches the tables on the *many* side of its
relationships (one hop or a chain) as a left-semi join; it never travels
from a fact up to a dimension, so a product filter leaves order measures
unchanged.  Grouping by a column of a table the measure cannot reach shows
the unfiltered value on every member, as a BI engine does.  Counts over no
rows are blank (null) and rows whose measures are all blank are hidden.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions import columns as C
from mercato.operators.aggregates import ratio
from mercato.operators.quantiles import exact_quantiles
from mercato.operators.ranks import global_row_number
from mercato.operators.windows import dense_rank_top
from mercato.plans.model import Model, StudyParams, build_customer_cohorts, rated_population

# BI relationships (child table, child key, parent table, parent key).
RELATIONSHIPS = [("FactOrders", "purchase_date", "DimDate", "Date"),
                 ("FactItems", "order_id", "FactOrders", "order_id"),
                 ("FactItems", "product_id", "DimProducts", "product_id"),
                 ("FactItems", "seller_id", "DimSellers", "seller_id"),
                 ("ReviewAnalysis", "order_id", "FactOrders", "order_id")]


def seller_labels(sellers: DataFrame, key: str = "seller_id") -> DataFrame:
    """C21: 'Vendeur 0001', ... by sorted seller id (distributed row number); numbers
    over 9999 keep all their digits."""
    ids = sellers.select(key).distinct()
    number = F.col("_n").cast("string")
    padded = F.concat(F.repeat(F.lit("0"), 4 - F.length(number)), number)
    return global_row_number(ids, [key], "_n").select(key, F.concat(F.lit("Vendeur "), padded).alias("Vendeur"))


def calendar_dim(bounds: DataFrame, start: Column, end: Column) -> DataFrame:
    """One row per day from start to end (columns of the one-row ``bounds``)
    with month text, year and year*100+month."""
    days = bounds.select(F.explode(F.sequence(start, end, F.expr("INTERVAL 1 DAY"))).alias("Date"))
    return days.select("Date", F.date_format("Date", "yyyy-MM").alias("Mois"), F.year("Date").alias("Annee"),
                       (F.year("Date") * 100 + F.month("Date")).alias("MoisNumero"))


def _combined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join on keys where null equals null, so a null group stays one."""
    other = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = None
    for k in keys:
        own = left[k].eqNullSafe(other[f"_r_{k}"])
        same = own if same is None else same & own
    both = left.withColumn("_in", F.lit(True)).join(other, same, "full_outer")
    return both.select(*[F.when(F.col("_in"), F.col(k)).otherwise(F.col(f"_r_{k}")).alias(k) for k in keys],
                       *[c for c in left.columns + right.columns if c not in keys])


def _with_median(agg: DataFrame, df: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """``agg``, one row per ``by``, with the median measure ``name``; null where a group has no value."""
    x = df.select(*by, MEASURES[name].median_of().alias("_x"))
    medians = exact_quantiles(x, by, "_x", {name: 0.5}, n="_n").drop("_n")
    if not by:
        return agg.crossJoin(medians)
    return _combined(agg, medians, by)


def bi_tables(m: Model, cohorts: DataFrame | None = None) -> dict[str, DataFrame]:
    """The seven curated BI tables."""
    f, fi = m.fact_orders, m.fact_items
    fo = f.select("order_id", "customer_unique_id", "order_status", "purchase_date", "purchase_month",
                  "customer_state", "item_value", "freight_value", "gross_value", "payment_total", "item_count",
                  "seller_count", "review_score", "bad_review", "delivery_days", "is_late", "analysis_period",
                  "payment_type", "max_installments",
                  C.delivery_status_label().alias("livraison_statut"), C.order_type_label().alias("commande_type"))
    items = fi.select("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value")
    if m.tables is not None:             # dimensions from their own tables (every product and seller)
        from mercato.plans.model import dim_products
        products = dim_products(m.tables).select("product_id", "category")
        sellers = m.tables["sellers"].select("seller_id", "seller_state")
    else:
        products = fi.select("product_id", "category").distinct()
        sellers = fi.select("seller_id", "seller_state").distinct()
    sellers = sellers.join(seller_labels(sellers), "seller_id")
    bounds = f.agg(F.trunc(F.min("purchase_date"), "month").alias("a"),
                   F.last_day(F.max("purchase_date")).alias("b"))
    dates = calendar_dim(bounds, F.col("a"), F.col("b"))
    coh = cohorts if cohorts is not None else build_customer_cohorts(f, m.params)
    coh = coh.select("customer_unique_id", "cohort_month", "customer_state", "eligible_90", "repeat_90",
                     "item_value", C.repeat_label().alias("Reachat"))
    ra = rated_population(f).select("order_id", "review_score", "bad_review",
                                    C.delay_bucket().alias("Retard"), C.delay_bucket_order().alias("OrdreRetard"))
    return {"FactOrders": fo, "FactItems": items, "DimProducts": products, "DimSellers": sellers,
            "DimDate": dates, "Cohorts": coh, "ReviewAnalysis": ra}


@dataclass
class Measure:
    name: str
    table: str | None = None
    agg: Callable[[], Column] | None = None
    combine: Callable[[dict[str, Column]], Column] | None = None
    deps: Sequence[str] = ()
    median_of: Callable[[], Column] | None = None   # exact median of this column
    post_rank: tuple[str, str] | None = None   # (dimension column, base measure) for dense-rank top 10


def _period() -> Column:
    return F.col("analysis_period") == 1


def _logistics() -> Column:
    return _period() & (F.col("order_status") == "delivered")


def _blank0(c: Column) -> Column:
    return F.nullif(c, F.lit(0))


MEASURES: dict[str, Measure] = {m.name: m for m in [
    Measure("orders", "FactOrders", lambda: _blank0(F.count_if(_period()))),                                    # M01
    Measure("orders_delivered", "FactOrders", lambda: _blank0(F.count_if(_logistics()))),                       # M02
    Measure("gmv", "FactOrders", lambda: F.sum(F.when(_logistics(), F.col("item_value")))),                     # M03
    Measure("avg_basket", combine=lambda m: ratio(m["gmv"], m["orders_delivered"]),
            deps=("gmv", "orders_delivered")),                                                          # M04
    Measure("_canceled", "FactOrders", lambda: _blank0(F.count_if(_period() & (F.col("order_status") == "canceled")))),
    Measure("cancel_rate", combine=lambda m: ratio(m["_canceled"], m["orders"]), deps=("_canceled", "orders")),  # M05
    Measure("deliveries_assessable", "FactOrders", lambda: _blank0(F.count(F.when(_logistics(), F.col("is_late"))))),   # M06
    Measure("late_orders", "FactOrders", lambda: F.sum(F.when(_logistics(), F.col("is_late"))).cast("long")),  # M07
    Measure("late_rate", combine=lambda m: ratio(m["late_orders"], m["deliveries_assessable"]),
            deps=("late_orders", "deliveries_assessable")),                                            # M08
    Measure("median_delivery_days", "FactOrders", median_of=lambda: F.when(_logistics(), F.col("delivery_days"))),  # M09
    Measure("mean_score", "FactOrders",
            lambda: ratio(F.sum(F.when(_logistics(), F.col("review_score"))),
                  F.count(F.when(_logistics(), F.col("review_score"))))),                              # M10
    Measure("reviews_available", "FactOrders", lambda: _blank0(F.count(F.when(_logistics(), F.col("review_score"))))),  # M11
    Measure("bad_reviews", "FactOrders", lambda: F.sum(F.when(_logistics(), F.col("bad_review"))).cast("long")),  # M12
    Measure("bad_review_rate", combine=lambda m: ratio(m["bad_reviews"], m["reviews_available"]),
            deps=("bad_reviews", "reviews_available")),                                                # M13
    Measure("late_rate_500", combine=lambda m: F.when(m["orders_delivered"] >= 500, m["late_rate"]),
            deps=("orders_delivered", "late_rate")),                                                   # M14
    Measure("mean_score_after_receipt", "ReviewAnalysis",
            lambda: ratio(F.sum("review_score"), F.count("review_score"))),                                    # M15
    Measure("reviews_after_receipt", "ReviewAnalysis", lambda: _blank0(F.count(F.lit(1)))),                    # M16
    Measure("gmv_items", "FactItems", lambda: F.sum("price")),                                                 # M17
    Measure("items_delivered", "FactItems", lambda: _blank0(F.count(F.lit(1)))),                               # M18
    Measure("orders_with_items", "FactItems", lambda: _blank0(F.count_distinct("order_id"))),                  # M19
    Measure("active_sellers", "FactItems", lambda: _blank0(F.count_distinct("seller_id"))),                    # M20
    Measure("gmv_top_categories", combine=lambda m: m["gmv_items"], deps=("gmv_items",),
            post_rank=("category", "gmv_items")),                                                      # M21
    Measure("gmv_top_sellers", combine=lambda m: m["gmv_items"], deps=("gmv_items",),
            post_rank=("Vendeur", "gmv_items")),                                                       # M22
    Measure("eligible_customers", "Cohorts", lambda: _blank0(F.count_if(F.col("eligible_90") == 1))),         # M23
    Measure("repeat_customers", "Cohorts",
            lambda: F.sum(F.when(F.col("eligible_90") == 1, F.col("repeat_90"))).cast("long")),                # M24
    Measure("repeat_rate_90", combine=lambda m: ratio(m["repeat_customers"], m["eligible_customers"]),
            deps=("repeat_customers", "eligible_customers")),                                          # M25
    Measure("first_basket", "Cohorts",
            lambda: ratio(F.sum(F.when(F.col("eligible_90") == 1, F.col("item_value"))),
                  F.count(F.when(F.col("eligible_90") == 1, F.col("item_value"))))),                  # M26
    Measure("repeat_rate_200", combine=lambda m: F.when(m["eligible_customers"] >= 200, m["repeat_rate_90"]),
            deps=("eligible_customers", "repeat_rate_90")),                                            # M27
]}


def support_measure(name: str, rate: str, count: str, least: int) -> None:
    """Adds a measure: ``rate`` where ``count`` is at least ``least``, as M14 and M27 with another support."""
    MEASURES[name] = Measure(name, combine=lambda m: F.when(m[count] >= least, m[rate]), deps=(count, rate))


# Items measures carry the logistics filter on FactOrders (it reaches FactItems).
TABLE_FILTERS = {"FactItems": [("FactOrders", _logistics)]}


@dataclass
class Context:
    group_by: Sequence[tuple[str, str]] = ()          # (table, column)
    filters: Sequence[tuple[str, Column]] = ()        # (table, predicate on that table)
    extra: dict = field(default_factory=dict)


class SemanticModel:
    def __init__(self, tables: dict[str, DataFrame], relationships=RELATIONSHIPS):
        self.tables = tables
        self.rels = list(relationships)

    def parents(self, table: str):
        return [(ck, p, pk) for c, ck, p, pk in self.rels if c == table]

    def upstream(self, table: str) -> set[str]:
        seen, stack = set(), [table]
        while stack:
            t = stack.pop()
            for _, p, _ in self.parents(t):
                if p not in seen:
                    seen.add(p)
                    stack.append(p)
        return seen

    def filtered(self, table: str, filters: Sequence[tuple[str, Column]]) -> DataFrame:
        """Rows of ``table`` under the filters of itself and of every
        table upstream (one side), applied as semi joins along the chain."""
        df = self.tables[table]
        for t, pred in filters:
            if t == table:
                df = df.filter(pred)
        for ck, parent, pk in self.parents(table):
            relevant = [x for x in filters if x[0] == parent or x[0] in self.upstream(parent)]
            if relevant:
                keys = self.filtered(parent, relevant).select(F.col(pk).alias(ck)).distinct()
                df = df.join(keys, ck, "left_semi")
        return df

    def with_columns(self, table: str, df: DataFrame, wanted: Sequence[tuple[str, str]]) -> DataFrame:
        """Bring columns of upstream tables onto ``df`` (many-to-one joins)."""
        for t, col in wanted:
            if t == table or col in df.columns:
                continue
            path = self._path(table, t)
            cur = df
            for child, ck, parent, pk in path:
                keep = [pk] + [c for c in ([col] if parent == t else []) if c != pk]
                nxt = [r for r in path if r[0] == parent]
                if nxt:
                    keep.append(nxt[0][1])
                dim = self.tables[parent].select(*dict.fromkeys(keep)).withColumnRenamed(pk, ck)
                cur = cur.join(dim, ck, "left")
            df = cur
        return df

    def _path(self, start: str, goal: str):
        frontier = [(start, [])]
        while frontier:
            t, path = frontier.pop(0)
            if t == goal:
                return path
            for ck, p, pk in self.parents(t):
                frontier.append((p, path + [(t, ck, p, pk)]))
        return None

    def evaluate(self, names: Sequence[str], ctx: Context = Context()) -> DataFrame:
        """Measures ``names`` grouped by ``ctx.group_by`` under ``ctx.filters``."""
        needed, order = set(), []

        def visit(n):
            if n in needed:
                return
            needed.add(n)
            for d in MEASURES[n].deps:
                visit(d)
            order.append(n)
        for n in names:
            visit(n)
        base = [n for n in order if MEASURES[n].table is not None]
        keys = [c for _, c in ctx.group_by]
        per_table: list[DataFrame] = []
        for table in dict.fromkeys(MEASURES[n].table for n in base):
            ms = [n for n in base if MEASURES[n].table == table]
            filters = list(ctx.filters) + [(t, p()) for t, p in TABLE_FILTERS.get(table, [])]
            df = self.filtered(table, filters)
            reach = {table} | self.upstream(table)
            own = [(t, c) for t, c in ctx.group_by if t in reach]
            other = [(t, c) for t, c in ctx.group_by if t not in reach]
            df = self.with_columns(table, df, own)
            by = [c for _, c in own]
            plain = [MEASURES[n].agg().alias(n) for n in ms if MEASURES[n].agg is not None]
            agg = df.groupBy(*by).agg(*(plain or [F.count(F.lit(1)).alias("_rows")]))
            for n in ms:
                if MEASURES[n].median_of is not None:
                    agg = _with_median(agg, df, by, n)
            for t, c in other:      # unrelated axis: same value on every member
                members = self.filtered(t, ctx.filters).select(c).distinct()
                agg = agg.crossJoin(members)
            per_table.append(agg)
        out = per_table[0]
        for nxt in per_table[1:]:
            out = _combined(out, nxt, keys) if keys else out.crossJoin(nxt)      # one row each
        cols = {n: F.col(n) for n in base}
        for n in order:
            mdef = MEASURES[n]
            if mdef.combine is not None:
                out = out.withColumn(n, mdef.combine(cols))
                cols[n] = F.col(n)
                if mdef.post_rank:
                    _, measure = mdef.post_rank
                    out = dense_rank_top(out.withColumn(n, F.col(measure)), n, 10)
        out = out.select(*keys, *names)
        if keys:
            any_value = None
            for n in names:
                any_value = F.col(n).isNotNull() if any_value is None else (any_value | F.col(n).isNotNull())
            out = out.filter(any_value)
        return out


def semantic_model(m: Model) -> SemanticModel:
    return SemanticModel(bi_tables(m))


# Report visuals (V01-V12): name -> (measures, group_by).
VISUALS: dict[str, tuple[list[str], list[tuple[str, str]]]] = {
    "page_performance_cards": (["orders_delivered", "gmv", "avg_basket", "cancel_rate"], []),
    "orders_by_month": (["orders_delivered"], [("DimDate", "Mois")]),
    "gmv_by_month": (["gmv"], [("DimDate", "Mois")]),
    "gmv_by_state": (["gmv"], [("FactOrders", "customer_state")]),
    "orders_by_status": (["orders"], [("FactOrders", "order_status")]),
    "page_delivery_cards": (["late_rate", "median_delivery_days", "mean_score", "bad_review_rate"], []),
    "late_by_month": (["late_rate"], [("DimDate", "Mois")]),
    "late_by_state_500": (["late_rate_500"], [("FactOrders", "customer_state")]),
    "score_by_delay_bucket": (["mean_score_after_receipt"], [("ReviewAnalysis", "Retard")]),
    "score_histogram": (["reviews_available"], [("FactOrders", "review_score")]),
    "page_offer_cards": (["gmv_items", "items_delivered", "orders_with_items", "active_sellers"], []),
    "top_categories_visual": (["gmv_top_categories"], [("DimProducts", "category")]),
    "top_sellers_visual": (["gmv_top_sellers"], [("DimSellers", "Vendeur")]),
    "offer_by_month": (["gmv_items"], [("DimDate", "Mois")]),
    "category_table": (["gmv_items", "orders_with_items", "items_delivered"], [("DimProducts", "category")]),
    "page_retention_cards": (["eligible_customers", "repeat_customers", "repeat_rate_90", "first_basket"], []),
    "retention_by_cohort": (["repeat_rate_90", "eligible_customers"], [("Cohorts", "cohort_month")]),
    "retention_by_state_200": (["repeat_rate_200"], [("Cohorts", "customer_state")]),
}


def visual_with_total(sm: SemanticModel, names: Sequence[str], group: tuple[str, str],
                      filters: Sequence[tuple[str, Column]] = ()) -> DataFrame:
    """A table visual with its total row: the total is the measure evaluated
    without the grouping (recomputed from totals, never summed from rows)."""
    rows = sm.evaluate(names, Context(group_by=[group], filters=filters)).withColumn("is_total", F.lit(0))
    total = sm.evaluate(names, Context(filters=filters)).select(
        F.lit(None).cast("string").alias(group[1]), *names).withColumn("is_total", F.lit(1))
    return rows.unionByName(total)


ALL_MEASURES = [n for n in MEASURES if not n.startswith("_") and MEASURES[n].post_rank is None]


def visual(sm: SemanticModel, name: str, filters: Sequence[tuple[str, Column]] = ()) -> DataFrame:
    names, group = VISUALS[name]
    return sm.evaluate(names, Context(group_by=group, filters=filters))
