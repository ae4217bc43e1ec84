"""Window-style operators (W-family) written so that no key holds a whole task.

"Latest per key" and "first per key" are written as ``max``/``min`` of a
struct inside ``groupBy``: Spark combines them map-side, so a key that holds a
third of all rows is reduced before the shuffle instead of being sorted in one
task as ``row_number()`` over a window would.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _pick(df: DataFrame, key: str | Sequence[str], order: Sequence[str], payload: Sequence[str],
          largest: bool) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    fields = list(dict.fromkeys([*order, *payload]))
    packed = F.struct(*[F.col(c).alias(c) for c in fields])
    agg = F.max(packed) if largest else F.min(packed)
    return df.groupBy(*keys).agg(agg.alias("_pick")).select(*keys, *[F.col("_pick")[c].alias(c) for c in fields])


def last_per_key(df: DataFrame, key, order: Sequence[str], payload: Sequence[str] = ()) -> DataFrame:
    """One row per key: the row that sorts last on ``order`` (nulls sort first,
    so a null date is the oldest).  Equivalent to ROW_NUMBER() = 1 over
    ``ORDER BY order DESC NULLS LAST``.  ``order`` must make rows unique within
    a key (add a source sequence column last)."""
    return _pick(df, key, order, payload, largest=True)


def first_per_key(df: DataFrame, key, order: Sequence[str], payload: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first row in ascending ``order``."""
    return _pick(df, key, order, payload, largest=False)


def latest_review(reviews: DataFrame, payload: Sequence[str] = ("review_score", "has_comment")) -> DataFrame:
    """Latest review per order by answer, creation, review id, source row."""
    from mercato.functions.columns import has_comment
    r = reviews
    if "has_comment" in payload and "has_comment" not in r.columns:
        r = r.withColumn("has_comment", has_comment())
    order = ["review_answer_timestamp", "review_creation_date", "review_id"]
    if "source_seq" in r.columns:
        order.append("source_seq")
    return last_per_key(r, "order_id", order, payload).drop(
        *[c for c in ("review_creation_date", "review_id", "source_seq") if c not in payload])


def share_of_total(counts: DataFrame, value: str, out: str, scale: float = 100.0,
                   digits: int | None = 2) -> DataFrame:
    """Value / total over all rows.  The total is a one-row aggregate
    joined as a scalar, never a window over one partition."""
    total = counts.agg(F.sum(value).alias("_total"))
    share = F.lit(scale) * F.col(value).cast("double") / F.col("_total").cast("double")
    if digits is not None:
        share = F.round(share, digits)
    return counts.crossJoin(F.broadcast(total)).withColumn(out, share).drop("_total")


def with_totals(df: DataFrame, **aggs: Column) -> DataFrame:
    """Attach one-row totals (COUNT(*) OVER (), SUM(x) OVER ()) as columns."""
    total = df.agg(*[c.alias(n) for n, c in aggs.items()])
    return df.crossJoin(F.broadcast(total))


def lag_growth(df: DataFrame, order: str, value: str, out: str, digits: int = 2) -> DataFrame:
    """Period-on-period growth in %, null on a zero or missing base.

    The window has no partition key: use it on a series that is already
    aggregated to one row per period (months), never on raw rows."""
    prev = F.lag(value).over(Window.orderBy(F.col(order).asc_nulls_first()))
    growth = F.round(F.lit(100.0) * (F.col(value) - prev).cast("double")
                     / F.nullif(prev, F.lit(0)).cast("double"), digits)
    return df.withColumn(out, growth)


def dense_rank_top(df: DataFrame, measure: str, top: int = 10, out: str | None = None) -> DataFrame:
    """Keep the measure when its dense rank (descending) is <= top, else
    null.  Ties share a rank, so more than ``top`` members may be kept.

    Dense rank <= top holds exactly when the value is at least the top-th
    largest distinct value; that threshold comes from a distributed top-k
    (TakeOrderedAndProject) over distinct values, so no window holds all
    members in one task.  Null measures are never kept."""
    out = out or measure
    threshold = (df.select(measure).filter(F.col(measure).isNotNull()).distinct()
                 .orderBy(F.col(measure).desc()).limit(top).agg(F.min(measure).alias("_thr")))
    return (df.crossJoin(F.broadcast(threshold))
            .withColumn(out, F.when(F.col(measure) >= F.col("_thr"), F.col(measure))).drop("_thr"))


def reverse_running_min(df: DataFrame, value: str, order: str, out: str) -> DataFrame:
    """Running minimum from the largest ``order`` down to the current row
    (the Benjamini-Hochberg step), with the distributed running minimum."""
    from mercato.operators.ranks import running_min
    return running_min(df, [(order, False), (value, False)], value, out)
