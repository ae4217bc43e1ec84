"""Distributed ranks and prefix sums.

Rows are dealt into buckets that follow the order (``operators/ordering.py``);
a window inside each bucket ranks or sums its rows, and a table of one row per
bucket gives the totals of all buckets before it.  Everything is
one lazy plan: building it starts no job and writes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.operators.ordering import BUCKET, Order, in_buckets, in_cells, offsets, sort_columns


def is_small(df: DataFrame, limit: int) -> bool:
    """True when ``df`` has at most ``limit`` rows; reads at most limit + 1.  For
    choosing a join strategy only: results never depend on it."""
    return limit > 0 and df.limit(limit + 1).count() <= limit


def _inside(order: Order) -> Window:
    return Window.partitionBy(BUCKET).orderBy(*sort_columns(order))


def _so_far(order: Order) -> Window:
    return _inside(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _numbered(rows: DataFrame, order: Order, out: str) -> DataFrame:
    """Adds the row number to rows in buckets."""
    counts = rows.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("_n"))
    first = offsets(counts, {"_offset": "_n"})
    return (rows.withColumn(out, F.row_number().over(_inside(order))).join(first, BUCKET)
            .withColumn(out, (F.col(out) + F.col("_offset")).cast("long")).drop("_offset"))


def global_row_number(df: DataFrame, order: Order, out: str = "rank", partitions: int | None = None) -> DataFrame:
    """ROW_NUMBER() OVER (ORDER BY order) without a single-task window.

    ``order`` items are column names (ascending, nulls first) or ``(name, asc)``
    tuples (descending puts nulls last).  The order must be total (end it with a
    unique key) for the numbering to be deterministic.  The result is a bigint
    at every size."""
    return _numbered(in_buckets(df, order, partitions), order, out).drop(BUCKET)


def running_sum(df: DataFrame, order: Order, value: str, out: str, partitions: int | None = None) -> DataFrame:
    """SUM(value) OVER (ORDER BY order ROWS UNBOUNDED PRECEDING), distributed
    (W08)."""
    return running_sums(df, order, {out: value}, partitions)


def running_sums(df: DataFrame, order: Order, sums: dict[str, str], partitions: int | None = None) -> DataFrame:
    """Several running sums over one order."""
    return _running_sums(in_buckets(df, order, partitions), order, sums).drop(BUCKET)


def _running_sums(rows: DataFrame, order: Order, sums: dict[str, str]) -> DataFrame:
    """Adds running sums to rows in buckets."""
    totals = rows.groupBy(BUCKET).agg(*[F.sum(v).alias(f"_t_{o}") for o, v in sums.items()])
    before = offsets(totals, {f"_o_{o}": f"_t_{o}" for o in sums})
    inside = rows.select("*", *[F.sum(v).over(_so_far(order)).alias(f"_s_{o}") for o, v in sums.items()])
    kept = [F.col(c) for c in rows.columns if c not in sums]
    return inside.join(before, BUCKET).select(*kept, *[(F.col(f"_o_{o}") + F.col(f"_s_{o}")).alias(o) for o in sums])


def _running_min(rows: DataFrame, order: Order, value: str, out: str, last: bool) -> DataFrame:
    """Adds the minimum of ``value`` up to each of the rows in buckets, or from it on with ``last``."""
    least = rows.groupBy(BUCKET).agg(F.min(value).alias("_least"))
    beyond = offsets(least, {"_beyond": "_least"}, combine=F.min, start=None, last=last)
    frame = (_inside(order).rowsBetween(Window.currentRow, Window.unboundedFollowing) if last else _so_far(order))
    return (rows.withColumn("_own", F.min(value).over(frame)).join(beyond, BUCKET)
            .withColumn(out, F.least("_own", "_beyond")).drop("_own", "_beyond"))


def running_min(df: DataFrame, order: Order, value: str, out: str, partitions: int | None = None) -> DataFrame:
    """MIN(value) OVER (ORDER BY order ROWS UNBOUNDED PRECEDING), distributed."""
    return _running_min(in_buckets(df, order, partitions), order, value, out, last=False).drop(BUCKET)


def counted_values(df: DataFrame, value: str, out: str = "n") -> DataFrame:
    """Distinct values with their counts, map-side combined, so a hot value is one row a task.  The filter on the count is always
    true; it makes every reader of the table ask for the same columns, so that they share its shuffle."""
    return df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias(out)).filter(F.col(out) > 0)


def rank_table(df: DataFrame, value: str, out: str = "rank", partitions: int | None = None) -> DataFrame:
    """Distinct values of ``value`` with their mid-rank and count (the small
    side of W09 before it is joined back)."""
    cum = _running_sums(in_cells(counted_values(df, value), value, partitions), [value], {"_cum": "n"})
    return cum.select(value, "n", (F.col("_cum") - F.col("n") + (F.col("n") + 1) / 2.0).alias(out))


def average_rank(df: DataFrame, value: str, out: str = "rank", partitions: int | None = None) -> DataFrame:
    """Mid-rank of ``value`` with ties sharing the average rank (as
    pandas ``rank()``).  Null values get a null rank and do not count.

    Values are first counted per distinct value (map-side combined, so a hot
    value costs one row), ranks are computed on the distinct values, and the
    result is joined back on the value."""
    return df.join(rank_table(df, value, out, partitions).select(value, out), value, "left")


def step_up(df: DataFrame, value: str, expression, out: str, partitions: int | None = None) -> DataFrame:
    """W10 over the distinct values of ``value``: (value, out), ``out`` being the minimum of ``expression(value, rank, total)`` from
    each value to the largest one.  ``rank`` is the number of rows up to the value, ties included, ``total`` that of all rows."""
    rows = in_cells(counted_values(df, value, "_n"), value, partitions)
    counts = rows.groupBy(BUCKET).agg(F.sum("_n").alias("_m"))
    before = offsets(counts, {"_before": "_m"})
    every = counts.agg(F.sum("_m").alias("_all"))
    ranked = (rows.withColumn("_to", F.sum("_n").over(_so_far([value]))).join(before, BUCKET).crossJoin(F.broadcast(every))      # one row
              .select(value, BUCKET, expression(F.col(value), F.col("_to") + F.col("_before"), F.col("_all")).alias("_step")))
    return _running_min(ranked, [value], "_step", out, last=True).select(value, out)
