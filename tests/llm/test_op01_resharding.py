import random

import pytest
from pyspark.sql import functions as F

from mercato.llm import resharding as R


def test_plan_moves_the_fewest_bytes():
    rng = random.Random(0)
    for turn in range(150):
        n, m = rng.randint(1, 6), rng.randint(1, 6)
        sizes = [rng.randint(0, 30) for _ in range(n)]
        room = R.equal_capacities(sum(sizes), m) if turn % 2 else [rng.randint(0, 40) for _ in range(m)]
        room[0] += max(0, sum(sizes) - sum(room))
        plan = R.transfer_plan(sizes, room)
        assert [sum(b for i, _, b in plan if i == x) for x in range(n)] == sizes
        assert all(sum(b for _, j, b in plan if j == y) <= room[y] for y in range(m))
        # A shard keeps at most min(size, capacity) bytes, and all can at once.
        assert sum(b for i, j, b in plan if i != j) == sum(sizes) - sum(min(a, b) for a, b in zip(sizes, room))


def test_plan_with_costs():
    # Moving 0 -> 2 costs 5, through the cheap pairs 0 -> 1 and 1 -> 2 only 2.
    plan = R.transfer_plan([10, 10], [0, 10, 10], [[0, 1, 5], [1, 0, 1]])
    assert sorted(plan) == [(0, 1, 10), (1, 2, 10)]
    with pytest.raises(ValueError):
        R.transfer_plan([5], [4])


def test_rows_keep_the_plan(docs_of, odd_rows):
    rng = random.Random(2)
    rows = [r for r in odd_rows if r[1] is None or len(r[1]) < 1000]
    rows += [(i, "w" * rng.randrange(200)) for i in range(100, 1500)] + [(3000, "same text")] * 50
    docs = docs_of(rows)
    old = F.when(F.col("doc_id") % 3 > 0, F.lit(2)).otherwise(F.col("doc_id") % 7)
    back, path = R.reshard(docs, old, 7, 10)
    got = back.collect()
    assert sorted(str((r["doc_id"], r["text"])) for r in got) == sorted(str(r) for r in rows)
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append((r["slot"], len((r["text"] or "").encode()) + 16))
    assert sorted(slots) == list(range(10))
    assert all(sorted(s for s, _ in v) == list(range(len(v))) for v in slots.values())
    totals = [sum(b for _, b in v) for v in slots.values()]
    assert max(totals) - min(totals) <= 4 * 216
    files = docs.sparkSession.read.parquet(path)
    assert files.count() == len(rows)


def test_untouched_shards_are_not_written(docs_of):
    docs = docs_of([(i, "xxxx") for i in range(60)])
    back, path = R.reshard(docs, F.col("doc_id") % 3, 3, 3, capacities=[400, 400, 400])
    assert back.count() == 60
    assert [r["shard"] for r in back.filter("doc_id % 3 <> shard").collect()] == []


def test_empty_table(docs_of):
    assert R.reshard(docs_of([]), F.lit(0), 2, 3)[0].collect() == []
