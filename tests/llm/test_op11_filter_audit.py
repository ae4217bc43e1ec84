import random
import re
from itertools import permutations

import pytest

from mercato.llm import filter_audit as A

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fails(row, rows):
    i, t = row[0], row[1] or ""
    w = WORD.findall(t)
    return {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and any(r[0] is not None and r[0] < i and (r[1] or "") == t for r in rows)}


def brute(rows, labels):
    """One document after the other through every order."""
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, x in labels if x == 1}
    failing = [(r[2] or "", r[0], fails(r, rows)) for r in rows]
    out = {}
    for part in {p for p, _, _ in failing}:
        mine = [(i, f) for p, i, f in failing if p == part]
        removed_of = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for k, c in enumerate(order):
                lost = [d for d in left if d[1][c]]
                left = [d for d in left if not d[1][c]]
                removed_of[c] += len(lost)
                out[part, order, k + 1] = [
                    len(left), len(lost), sum(f[c] for _, f in mine) - len(lost), sum(f[c] and sum(f.values()) == 1 for _, f in mine),
                    sum(i in good for i, _ in lost), sum(i in toxic for i, _ in lost)]
        for (p, order, k), row in out.items():
            if p == part:
                row.append(removed_of[order[k - 1]])
    return out


def run(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, p, "x", 7, "y") for i, t, p in rows],
                                 "doc_id long, text string, source string, digest string, n int, part string").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = A.filter_audit(docs, marks).collect()
    have = {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in got}
    assert len(have) == len(got)
    return have


def case(seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(90):
        n = rng.choice([0, 3, 199, 200, 260])
        w = [f"w{rng.randrange(rng.choice([40, 120, 4000]))}" for _ in range(n)]
        if rng.random() < 0.3:
            w = [x.upper() for x in w]
        if rng.random() < 0.3:
            w.append(rng.choice("#$%&*|"))
        rows.append((i, rng.choice([" ", "\n", "\x0b "]).join(w), rng.choice(["s0", "s0", "s1", None, ""])))
    rows += [(200 + k, rows[k * 3][1], rng.choice(["s0", "s1"])) for k in range(20)] + [rows[4], rows[4], (4, rows[4][1], "s1")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 0, 1])) for i in range(0, 110, 2)] + [(2, 1, 1), (2, 0, 0), (None, 1, 1), (999, 1, 1)]
    return rows, labels


def test_equals_brute_force(spark):
    rows, labels = case()
    assert run(spark, rows, labels) == brute(rows, labels)


def test_nulls_empty_and_long_texts(spark, odd_rows):
    rows = [(i, t, s) for (i, t), s in zip(odd_rows, ["a", None, "", "a", "a", "b", "b", "a", "a", "a", "c"])]
    labels = [(1, 1, 1), (2, 1, None), (5, None, 1)]
    assert run(spark, rows, labels) == brute(rows, labels)


def test_empty_tables(spark):
    assert run(spark, [], [(1, 1, 1)]) == {}
    have = run(spark, [(1, "one", "s")], [])
    assert len(have) == 600 and have["s", "ABCDE", 1] == [0, 1, 0, 1, 0, 0, 120]


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_swaps_lead_through_all_orders(n):
    order = list(range(n))
    seen = {tuple(order)}
    for k in A.plain_changes(n):
        order[k], order[k + 1] = order[k + 1], order[k]
        seen.add(tuple(order))
    assert len(seen) == len(list(permutations(range(n)))) == len(A.plain_changes(n)) + 1


def test_swapped_diagram_equals_the_built_one():
    rng = random.Random(9)
    counts = {m: (rng.randrange(1, 5), rng.randrange(3), rng.randrange(3)) for m in rng.sample(range(32), 11)}
    d = A.Diagram(counts)
    for k in A.plain_changes(5):
        d.swap(k)
        assert d.all_pass_path() == A.Diagram(counts, "".join(d.order)).all_pass_path()
