import random
from collections import Counter

import pytest

from mercato.llm import line_runs as L

WS = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WS))


def brute(rows, least_docs=10, least_chars=1):
    docs = Counter()
    for _, t in rows:
        docs.update({key(x) for x in (t or "").split("\n")})
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < max(least_chars, 1) or docs[key(x)] < least_docs]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def run(docs, **how):
    return sorted((tuple(r) for r in L.drop_frequent_lines(docs, **how).collect()), key=str)


def case(n=160, seed=5):
    rng = random.Random(seed)
    common = ["Share this page", " share THIS page\t", "All rights reserved.", "É accent", "é accent", "x", "中文", "\x0b", ""]
    rows = []
    for i in range(n):
        lines = [rng.choice(common) if rng.random() < 0.4 else f"line {rng.randrange(40)}" if rng.random() < 0.3 else f"own {i} {k}"
                 for k in range(rng.choice([0, 1, 3, 12]))]
        rows.append((i, rng.choice(["\n", "\n", "\r\n"]).join(lines)))
    return rows + rows[:7] + [(None, rows[3][1]), (None, "Share this page\nShare this page"), (None, "x")]


@pytest.mark.parametrize("how", [{}, {"batches": 1}, {"batches": 7, "fanout": 2}, {"least_docs": 3, "least_chars": 3}, {"least_docs": 1}])
def test_equals_brute_force(spark, docs_of, how):
    rows = case()
    want = brute(rows, **{k: v for k, v in how.items() if k.startswith("least")})
    assert run(docs_of(rows).repartition(9), **how) == want


def test_nulls_empty_and_long_texts(spark, docs_of, odd_rows):
    rows = odd_rows + [(20 + k, "A\nb \n" + "\n".join(f"{k} {j}" for j in range(3000))) for k in range(10)] + [(50, "a\nA\nb")]
    assert run(docs_of(rows)) == brute(rows)


def test_empty_table(spark, docs_of):
    assert run(docs_of([])) == []


def test_runs_are_levelled_and_frequent_keys_join_no_more(spark):
    index = L.LineRuns(spark, least_docs=3, fanout=3, buckets=4)
    frame = lambda keys: spark.createDataFrame([(k, k * 7) for k in keys], "h1 long, h2 long")
    stored = lambda level: sorted((r["h1"], r["docs"]) for r in spark.table(index.levels[level].table).collect())
    index.add(frame([1, 1, 1, 2]))
    index.add(frame([1, 2, 3]))
    assert [x.runs for x in index.levels] == [2]
    assert stored(0) == [(1, 3), (2, 1), (2, 1), (3, 1)]      # 1 was frequent already
    index.add(frame([4]))
    assert [x.runs for x in index.levels] == [0, 1]
    assert stored(1) == [(1, 3), (2, 2), (3, 1), (4, 1)]
    index.add(frame([1, 2, 5]))
    assert stored(0) == [(2, 1), (5, 1)]
    assert {r["h1"] for r in index.frequent().collect()} == {1, 2}
    names = [x.table for x in index.levels]
    index.close()
    assert not any(spark.catalog.tableExists(n) for n in names)


def test_runs_merge_without_a_shuffle(spark):
    index = L.LineRuns(spark, least_docs=2, fanout=9, buckets=4)
    rows = spark.range(2000).selectExpr("id as h1", "id * 3 as h2")
    for _ in range(3):
        index.add(rows.limit(1500))
        index.add(rows)
    merged = index.merged(0)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    counts = merged.groupBy("docs").count().collect()
    index.close()
    assert "Exchange" not in plan and "SelectedBucketsCount: 4 out of 4" in plan, plan
    assert sum(r["count"] for r in counts) == 2000


def test_batches_do_not_change_counts(spark):
    rows = spark.range(5000).selectExpr("id % 211 as h1", "id % 7 as h2", "id as i")
    want = {(r[0], r[1]) for r in rows.groupBy("h1", "h2").count().filter("count >= 4").collect()}
    index = L.LineRuns(spark, least_docs=4, fanout=2, buckets=3)
    for b in range(7):
        index.add(rows.filter(f"pmod(xxhash64(i), 7) = {b}"))
    got = {(r[0], r[1]) for r in index.frequent().collect()}
    index.close()
    assert got == want
