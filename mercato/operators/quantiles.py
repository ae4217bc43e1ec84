"""Exact quantiles of groups of any size.

``percentile`` and ``median`` keep every distinct value of a group in one
buffer.  Here the values are counted and dealt into cells that follow their
order; the counts per group and cell, a histogram, tell which cell holds a
wanted rank.  Only the distinct values of those cells are sorted, each cell by
itself.  Counting is combined map-side, so a group or value with a third of all
rows costs one row a task and distinct value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.operators.ordering import BUCKET, in_cells


def _same(a: DataFrame, b: DataFrame, left: Sequence[str], right: Sequence[str]) -> Column:
    cond = F.lit(True)
    for x, y in zip(left, right):
        cond = cond & a[x].eqNullSafe(b[y])
    return cond


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, shares: dict[str, float], n: str = "n") -> DataFrame:
    """(by, n, one column per share): quantiles with linear interpolation between the two nearest ranks, as ``percentile`` has them.

    ``shares``: output name -> share in [0, 1].  Null values do not count; a group without others has no row.  Null is a group.
    Without ``by`` there is one row, with n 0 and null quantiles where there are no values."""
    by = list(by)
    counts = (df.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
              .groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 0"))
    rows = in_cells(counts, "_v")
    held = rows.groupBy(*by, BUCKET).agg(F.sum("_c").alias("_m"))
    before = Window.partitionBy(*by).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("_before", F.coalesce(F.sum("_m").over(before), F.lit(0))).withColumn("_total", F.sum("_m").over(Window.partitionBy(*by)))

    def place(share: float) -> Column:
        return (F.col("_total") - 1) * F.lit(float(share))

    ranks = {(out, end): f(place(p)).cast("long") for out, p in shares.items() for end, f in (("lo", F.floor), ("hi", F.ceil))}
    asked = None
    for r in ranks.values():
        here = (r >= F.col("_before")) & (r < F.col("_before") + F.col("_m"))
        asked = here if asked is None else asked | here
    wanted = held.filter(asked).select(*[F.col(c).alias(f"_w_{c}") for c in by], F.col(BUCKET).alias("_w_bucket"), "_before", "_total")
    near = rows.join(wanted, _same(rows, wanted, [*by, BUCKET], [*[f"_w_{c}" for c in by], "_w_bucket"]))
    inside = Window.partitionBy(*by, BUCKET).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = near.withColumn("_to", F.col("_before") + F.sum("_c").over(inside))
    at = {k: F.max(F.when((r < F.col("_to")) & (r >= F.col("_to") - F.col("_c")), F.col("_v"))).alias("_".join(("_q", *k))) for k, r in ranks.items()}
    found = near.groupBy(*by).agg(F.max("_total").alias("_total"), *at.values())

    def between(out: str, share: float) -> Column:
        lo, hi, x = F.floor(place(share)), F.ceil(place(share)), place(share)
        low, high = F.col(f"_q_{out}_lo"), F.col(f"_q_{out}_hi")
        return F.when(lo == hi, low).otherwise((hi - x) * low + (x - lo) * high)

    return found.select(*by, F.coalesce("_total", F.lit(0)).cast("long").alias(n), *[between(o, p).alias(o) for o, p in shares.items()])
