"""Helpers the operators share: intermediate tables in the shared folder and
gapless numbering without a one-task window."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.session import checkpoint_dir


def scratch_path(spark, name: str) -> str:
    """A new path in the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lineage cut that
    survives lost executors and is scanned column by column."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, keys: list[str], order: list[Column], out: str, salt: Column, salts: int) -> DataFrame:
    """Adds ``out``, numbers from 0 without a gap inside each value of ``keys``.

    Rows are dealt by (keys, salt), so a key that holds a third of all rows is
    spread over ``salts`` tasks.  Counts per (keys, salt) give every share its
    offset; that table has at most keys x salts rows.  ``df`` must give the same
    rows when evaluated again (a written table does).
    """
    df = df.withColumn("_salt", F.pmod(salt, F.lit(salts)).cast("int"))
    counts = df.groupBy(*keys, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_salt").alias("_s"),
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    share = Window.partitionBy(*keys, "_salt").orderBy(*order)
    ranked = df.withColumn("_rn", F.row_number().over(share))
    on = [ranked[k].eqNullSafe(offsets[f"_k_{k}"]) for k in keys] + [ranked["_salt"] == offsets["_s"]]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return (ranked.join(offsets, cond, "left")
            .withColumn(out, (F.col("_rn") - 1 + F.col("_before")).cast("long"))
            .drop("_salt", "_rn", "_s", "_before", *[f"_k_{k}" for k in keys]))


class BitFilter:
    """Fixed-size bit filter over 64-bit hashes: says no only to hashes that were
    not put in.  Its size, and so its broadcast, does not grow with the data; a
    full one only lets more rows through to the exact step that follows it."""

    def __init__(self, hashes: DataFrame, column: str, log_bits: int = 24):
        if not 6 <= log_bits <= 28:
            raise ValueError("log_bits must be 6 to 28")
        place = F.col(column).bitwiseAND(F.lit((1 << log_bits) - 1))
        words = (hashes.filter(F.col(column).isNotNull())
                 .groupBy(F.shiftright(place, 6).cast("int").alias("w"))
                 .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(`{column}` & 63 as int))")).alias("bits")))
        rows = words.toPandas()                       # at most 2 ** (log_bits - 6) rows
        table = np.zeros(1 << (log_bits - 6), np.uint64)
        table[rows["w"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64).view(np.uint64)
        self.log_bits, self.empty = log_bits, len(rows) == 0
        self._table = hashes.sparkSession.sparkContext.broadcast(table)

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        h = hashes.view(np.uint64) & np.uint64((1 << self.log_bits) - 1)
        word = self._table.value[(h >> np.uint64(6)).astype(np.int64)]
        return ((word >> (h & np.uint64(63))) & np.uint64(1)).astype(bool)
