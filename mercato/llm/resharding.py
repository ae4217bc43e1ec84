"""Resharding by minimum-cost flow (operator 1).

Old shards have sizes, new shards have capacities.  ``transfer_plan`` solves the
transport problem between them, where a byte that stays in its shard costs 0 and
a byte that moves costs 1 (or a given cost), by successive shortest paths; the
plan is a table of block transfers of at most old x new shards, whatever the
data's size.

``Layout`` carries the plan out on rows.  The rows of an old shard have an order
(hash share, then id); running totals of their sizes lay them out on [0, shard
size), the plan cuts that range into blocks, and a row goes to the block that
holds its middle.  A shard's size so differs from its capacity by at most one
row a block edge.  Totals run in shares of bounded size, so an old shard that
holds a third of all rows is spread over many tasks; sizes and places are found
on a table without texts, and the texts are shuffled once.

``reshard`` writes the shards that gain or lose rows as Parquet, one directory a
shard, in slot order, and leaves the others to their old files.

Defined results.  Null text: no bytes.  Null ids come first in the order; equal
rows are placed one by one.  A row with a null old shard counts as one of shard
0.  A very long text is one row, so a shard may pass its capacity by part of it.
An empty table gives an empty result.  Other columns are ignored.  Equal texts are
placed by their rows, not as a group: the law balances bytes.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.shared import scratch_path, written

#: Bytes of text that a share of an old shard holds about.
SHARE_BYTES = 32 << 20


def equal_capacities(total: int, shards: int) -> list[int]:
    """Capacities that add up to the total, at most one byte apart."""
    return [total // shards + (i < total % shards) for i in range(shards)]


def transfer_plan(sizes: list[int], capacities: list[int], cost: list[list[int]] | None = None) -> list[tuple[int, int, int]]:
    """(old shard, new shard, bytes) with the least total cost; the capacities must
    hold all bytes.  Without ``cost`` a byte costs 1 unless it keeps its number.

    Successive shortest paths with potentials on the graph source - old - new -
    sink; each path fills a capacity or empties a shard, or undoes a transfer.
    """
    n, m = len(sizes), len(capacities)
    if sum(sizes) > sum(capacities):
        raise ValueError("the capacities do not hold all bytes")
    flow = np.zeros((n, m), dtype=object)
    price = np.array(cost if cost is not None else [[int(i != j) for j in range(m)] for i in range(n)], dtype=object)
    left, room = list(sizes), list(capacities)
    pot_old, pot_new = [0] * n, [0] * m
    while any(left):
        far = [float("inf")] * (n + m)
        back: list[int | None] = [None] * (n + m)
        heap = []
        for i in range(n):
            if left[i]:
                far[i] = 0
                heapq.heappush(heap, (0, i))
        while heap:
            d, v = heapq.heappop(heap)
            if d > far[v]:
                continue
            if v < n:
                steps = ((n + j, price[v][j] + pot_old[v] - pot_new[j]) for j in range(m))
            else:
                steps = ((i, -price[i][v - n] + pot_new[v - n] - pot_old[i]) for i in range(n) if flow[i][v - n])
            for u, c in steps:
                if d + c < far[u]:
                    far[u], back[u] = d + c, v
                    heapq.heappush(heap, (d + c, u))
        open_new = [j for j in range(m) if room[j] and far[n + j] < float("inf")]
        # True cost of a path to j: reduced length plus the new shard's potential.
        end = min(open_new, key=lambda j: far[n + j] + pot_new[j])
        path, v = [n + end], n + end
        while back[v] is not None:
            v = back[v]
            path.append(v)
        path.reverse()
        amount = min(left[path[0]], room[end])
        for a, b in zip(path, path[1:], strict=False):
            if a >= n:
                amount = min(amount, flow[b][a - n])
        for a, b in zip(path, path[1:], strict=False):
            if a < n:
                flow[a][b - n] += amount
            else:
                flow[b][a - n] -= amount
        left[path[0]] -= amount
        room[end] -= amount
        limit = max(x for x in far if x < float("inf"))
        for i in range(n):
            pot_old[i] += min(far[i], limit)
        for j in range(m):
            pot_new[j] += min(far[n + j], limit)
    return [(i, j, int(flow[i][j])) for i in range(n) for j in range(m) if flow[i][j]]


def blocks_of(transfers: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(old, first byte, end byte, new): each old shard's own block first, then by number."""
    out, at = [], {}
    for i, j, b in sorted(transfers, key=lambda t: (t[0], t[1] != t[0], t[1])):
        lo = at.get(i, 0)
        out.append((i, lo, lo + b, j))
        at[i] = lo + b
    return out


class Layout:
    """Where every row of an old sharding goes.

    ``rows`` has _id, _size, _crc (tells texts of equal ids apart) and _old.  The
    driver sees one row an old shard and one a block of the plan.
    """

    def __init__(self, rows: DataFrame, old_shards: int, capacities: list[int] | None, new_shards: int):
        rows = written(rows.select("_id", "_size", "_crc", "_old"), "rows")
        found = {r["_old"]: int(r["b"]) for r in rows.groupBy("_old").agg(F.sum("_size").alias("b")).collect()}
        sizes = [found.get(i, 0) for i in range(old_shards)]
        self.shares = [max(1, -(-b // SHARE_BYTES)) for b in sizes]
        self.capacities = capacities or equal_capacities(sum(sizes), new_shards)
        self.transfers = transfer_plan(sizes, self.capacities)
        by_old: dict[int, list] = {}
        for i, _, hi, j in blocks_of(self.transfers):
            by_old.setdefault(i, []).append((hi, j))
        self.blocks = rows.sparkSession.createDataFrame(sorted(by_old.items()), "_old int, _blocks array<struct<hi: long, shard: int>>")
        totals = self.shared(rows).groupBy("_old", "_share").agg(F.sum("_size").alias("_b"))
        before = Window.partitionBy("_old").orderBy("_share").rowsBetween(Window.unboundedPreceding, -1)
        self.starts = written(totals.select("_old", "_share", F.coalesce(F.sum("_b").over(before), F.lit(0)).alias("_start")), "starts")
        # Rows of one old shard's share that go to one new shard are numbered together.
        parts = self.placed(rows).groupBy("shard", "_old", "_share").agg(F.count(F.lit(1)).alias("_n"))
        before = Window.partitionBy("shard").orderBy("_old", "_share").rowsBetween(Window.unboundedPreceding, -1)
        self.slots = written(parts.select("shard", "_old", "_share", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_slot")), "slots")

    def shared(self, rows: DataFrame) -> DataFrame:
        count = F.element_at(F.array(*[F.lit(n) for n in self.shares]), F.col("_old") + 1)
        return rows.withColumn("_share", F.pmod(F.xxhash64("_id", "_crc"), count).cast("int"))

    def placed(self, rows: DataFrame) -> DataFrame:
        """Adds _share, _middle and shard.  The rows are dealt by (old shard, share)."""
        inside = Window.partitionBy("_old", "_share").orderBy("_id", "_size", "_crc").rowsBetween(Window.unboundedPreceding, 0)
        end = F.sum("_size").over(inside)
        rows = self.shared(rows).withColumn("_middle", end - F.col("_size") + F.floor(F.col("_size") / 2))
        rows = rows.join(self.starts, ["_old", "_share"], "left").withColumn("_middle", F.col("_middle") + F.col("_start"))
        rows = rows.join(F.broadcast(self.blocks), "_old", "left")        # at most old + new blocks
        hit = F.filter("_blocks", lambda b: b["hi"] > F.col("_middle"))
        shard = F.coalesce(F.get(hit, F.lit(0))["shard"], F.element_at(F.col("_blocks"), -1)["shard"])
        return rows.withColumn("shard", shard).drop("_blocks", "_start")

    def numbered(self, rows: DataFrame) -> DataFrame:
        """Adds shard and slot; needs no shuffle beyond that of ``placed``."""
        turn = F.row_number().over(Window.partitionBy("_old", "_share", "shard").orderBy("_middle", "_id", "_crc"))
        rows = self.placed(rows).withColumn("_turn", turn)
        rows = rows.join(self.slots, ["_old", "_share", "shard"], "left")
        return rows.withColumn("slot", (F.col("_slot") + F.col("_turn") - 1).cast("long")).drop("_slot", "_turn", "_middle")


def keyed(docs: DataFrame, old_shard: Column, id_col: str, text_col: str, overhead: int) -> DataFrame:
    text = F.col(text_col).cast("string")
    whole = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), F.coalesce(old_shard.cast("int"), F.lit(0)).alias("_old"))
    return whole.select("_id", "_old", (F.coalesce(F.octet_length("_text"), F.lit(0)) + overhead).cast("long").alias("_size"),
                        F.xxhash64("_text").alias("_crc"), "_text")


def reshard(docs: DataFrame, old_shard: Column, old_shards: int, new_shards: int, id_col: str = "doc_id", text_col: str = "text",
            overhead: int = 16, capacities: list[int] | None = None, path: str | None = None) -> tuple[DataFrame, str]:
    """Writes the rows of every shard that gains or loses some as path/shard=N, in
    slot order, and returns (id, text, shard, slot) of all rows and the path:
    rewritten shards are read back from their files, untouched ones from ``docs``.

    A task holds one share of an old shard, whose rows go to one new shard or a
    few neighbouring blocks, so it writes few files and the texts are shuffled once.
    """
    spark = docs.sparkSession
    rows = keyed(docs, old_shard, id_col, text_col, overhead)
    layout = Layout(rows.drop("_text"), old_shards, capacities, new_shards)
    changed = sorted({x for i, j, _ in layout.transfers if i != j for x in (i, j)})
    path = path or scratch_path(spark, "shards")
    whole = layout.numbered(rows).select(F.col("_id").alias(id_col), F.col("_text").alias(text_col), "shard", "slot")
    moved = F.col("shard").isin(changed) if changed else F.lit(False)
    whole.filter(moved).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    back = spark.read.schema(whole.schema).parquet(path)
    if len(changed) == new_shards:
        return back, path
    return back.unionByName(whole.filter(~moved)), path
