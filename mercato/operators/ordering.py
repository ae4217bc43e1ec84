"""Total orders without a single task and without a job of their own.

A window with ORDER BY and no PARTITION BY moves every row into one task.  Here
rows are dealt into buckets that follow the order: a bucket holds the keys
between two neighbouring bounds.  The bounds are part of the same lazy plan:
a hash picks one key for each of a fixed number of slots (a map-side combined
aggregate), the picked keys are sorted, and every ``PICKS``-th is a bound.
The pick depends on nothing but the keys, so each branch of a plan that asks
for a row's bucket, and each retry of a task, gets the same answer.

Tables of one row per bucket give the offsets; they are bounded by the bucket
count, whatever the input's size.

Distinct numbers need no bounds: ``in_cells`` deals them by binary exponent and
leading digits, one cell for each 1/4096 of an octave.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Picked keys for each bucket.
PICKS = 8
#: Bounds that one step of the two-step search skips.
STRIDE = 16
BUCKET = "_bucket"
_HEX, _XEH = "0123456789ABCDEF", "FEDCBA9876543210"

Order = Sequence["str | tuple[str, bool]"]


def pairs(order: Order) -> list[tuple[str, bool]]:
    """(column, ascending) of each item."""
    return [(o, True) if isinstance(o, str) else o for o in order]


def sort_columns(order: Order) -> list[Column]:
    """Ascending puts nulls first, descending last."""
    return [F.col(c).asc_nulls_first() if up else F.col(c).desc_nulls_last() for c, up in pairs(order)]


def _falling(c: Column, kind: T.DataType) -> list[Column]:
    """Fields whose ascending order is the descending order of ``c``, nulls last."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        value = [F.bitwise_not(c)]
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        value = [~F.isnan(c), F.negative(c)]
    elif isinstance(kind, T.DecimalType):
        value = [F.negative(c)]
    elif isinstance(kind, T.BooleanType):
        value = [~c]
    elif isinstance(kind, T.DateType):
        value = [F.negative(F.unix_date(c))]
    elif isinstance(kind, T.TimestampType):
        value = [F.bitwise_not(F.unix_micros(c))]
    elif isinstance(kind, (T.StringType, T.BinaryType)):
        # The end sign sorts after all digits, so a longer value comes before its own beginning.
        value = [F.concat(F.translate(F.hex(c), _HEX, _XEH), F.lit("G"))]
    else:
        raise TypeError(f"no descending order for {kind.simpleString()}")
    return [c.isNull(), *value]


def sort_key(df: DataFrame, order: Order) -> Column:
    """One struct that sorts as ``order`` does."""
    fields: list[Column] = []
    for name, up in pairs(order):
        fields += [F.col(name)] if up else _falling(F.col(name), df.schema[name].dataType)
    return F.struct(*[c.alias(f"f{i}") for i, c in enumerate(fields)])


def bucket_count(df: DataFrame, partitions: int | None) -> int:
    """Twice the shuffle partitions, as buckets are dealt to them by hash."""
    return 2 * (partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def in_buckets(df: DataFrame, order: Order, partitions: int | None = None, out: str = BUCKET) -> DataFrame:
    """Adds ``out``: every key of a bucket sorts before all keys of the next.

    Equal keys share a bucket; end the order with a unique column, or count
    equal keys first, where one key may hold many rows."""
    buckets = bucket_count(df, partitions)
    names = [c for c, _ in pairs(order)]
    place = F.xxhash64(*names)
    picked = (df.select(*dict.fromkeys(names), place.alias("_h"))
              .groupBy(F.pmod("_h", F.lit(buckets * PICKS)).alias("_slot"))
              .agg(*[F.min_by(c, "_h").alias(c) for c in dict.fromkeys(names)]))
    keys = F.array_sort(F.collect_list(sort_key(df, order)))
    bounds = picked.agg(keys.alias("_k")).select(F.filter("_k", lambda _, i: i % PICKS == PICKS - 1).alias("_bounds"))
    bounds = bounds.select("_bounds", F.filter("_bounds", lambda _, i: i % STRIDE == 0).alias("_coarse"))      # one row of at most ``buckets`` keys
    key = F.col("_key")
    block = F.size(F.filter("_coarse", lambda b: b <= key)) - 1
    fine = F.slice("_bounds", F.col("_block") * STRIDE + 1, F.lit(STRIDE))
    dealt = df.withColumn("_key", sort_key(df, order)).crossJoin(F.broadcast(bounds)).withColumn("_block", block)
    bucket = F.when(F.col("_block") < 0, 0).otherwise(F.col("_block") * STRIDE + F.size(F.filter(fine, lambda b: b <= key)))
    return dealt.withColumn(out, F.coalesce(bucket.cast("int"), F.lit(0))).drop("_key", "_bounds", "_coarse", "_block")


#: Cells of an octave.
CELLS = 4096
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def number_cell(c: Column) -> Column:
    """A bigint that never falls where ``c`` grows: log2 of its size, linear between powers of two, with the sign."""
    x = c.cast("double")
    size = F.abs(x)
    octave = F.floor(F.log2(size))
    code = (octave + 1100) * CELLS + F.floor((size / F.pow(F.lit(2.0), octave) - 1) * CELLS) + 1
    most = F.lit(4000 * CELLS).cast("long")
    finite = F.when(size > 1.7976931348623157e308, most).otherwise(code)
    # Not null by type: a join on the cell then adds no filter of its own to one of the branches that share a shuffle.
    cell = F.when(F.isnan(x), most + 1).when(x == 0, F.lit(0).cast("long")).when(x > 0, finite).otherwise(-finite)
    return F.coalesce(cell, -most - 1)


def in_cells(df: DataFrame, value: str, partitions: int | None = None, out: str = BUCKET) -> DataFrame:
    """``in_buckets`` for rows that are distinct on ``value`` (in each group): numbers go to cells, which takes no look at the
    data; other types to buckets between bounds."""
    if isinstance(df.schema[value].dataType, _NUMBERS):
        return df.withColumn(out, number_cell(F.col(value)))
    return in_buckets(df, [value], partitions, out)


def offsets(per_bucket: DataFrame, totals: dict[str, str], by: Sequence[str] = (), combine=F.sum, start=0, last: bool = False) -> DataFrame:
    """Running ``combine`` of each total over the buckets before a bucket (after it, with ``last``): one row per bucket and group.
    Rows in buckets are partitioned by bucket, so the join with this table moves only the table."""
    order = F.col(BUCKET).desc() if last else F.col(BUCKET).asc()
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    shown = {out: combine(c).over(before) for out, c in totals.items()}
    return per_bucket.select(*by, BUCKET, *[(F.coalesce(v, F.lit(start)) if start is not None else v).alias(out) for out, v in shown.items()])
