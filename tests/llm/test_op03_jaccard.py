import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import jaccard_join as J


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", fold(text))
        sets.append({tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    out = []
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        out += [(rows[i][0], len(sets[i]), min(ids, default=None)) for i in members]
    return out, len(groups)


def key(row):
    return tuple((x is None, x or 0) for x in row)


def corpus(seed, n):
    """Copies with few to many edits of base texts of all sizes, half with a shared passage."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    base = [[rng.choice(words) for _ in range(rng.choice([3, 5, 6, 9, 12, 20, 40, 80, 200]))] for _ in range(30)]
    passage = [rng.choice(words) for _ in range(40)]
    rows = []
    for i in range(n):
        w = list(rng.choice(base)) + (passage if rng.random() < .5 else [])
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            p = rng.randrange(len(w))
            w[p:p + rng.randrange(2)] = [rng.choice(words)]
        rows.append((i, " ".join(w)))
    return rows


def test_equals_brute_force(docs_of, odd_rows):
    rows = corpus(1, 260) + [(i and i + 1000, t) for i, t in odd_rows if t is None or len(t) < 1000]
    rows += [(2000, rows[0][1].upper() + "  "), (2001, rows[0][1])]
    got = [tuple(r) for r in J.jaccard_classes(docs_of(rows)).collect()]
    want, _ = brute(rows)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_one_of_each_class(docs_of):
    rows = corpus(2, 120) + [(None, None), (300, ""), (400, "a b c"), (400, "a b c"), (None, "a b c")]
    kept = J.one_of_each_class(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    want, _ = brute(rows)
    classes = {c for _, n, c in want if n}
    assert sorted(i for i, t in got if t) == sorted(classes)
    assert sum(not t for _, t in got) == 2


def test_empty_table(docs_of):
    assert J.jaccard_classes(docs_of([])).collect() == []
    assert J.one_of_each_class(docs_of([])).collect() == []


def test_long_texts(docs_of, odd_rows):
    got = {r["doc_id"]: r["component_id"] for r in J.jaccard_classes(docs_of([r for r in odd_rows if r[0] in (5, 6, 7)])).collect()}
    assert got == {5: 5, 6: 5, 7: 7}


@pytest.mark.parametrize("size", [5, 9, 17, 40, 63, 200])
def test_signatures_meet_up_to_the_bound(size):
    """Any two sets within the difference bound share a signature, whatever the order of signatures."""
    rng = np.random.default_rng(size)
    for turn in range(60):
        a = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        extra = int(rng.integers(0, size // 4 + 1))
        cut = int(rng.integers(0, size // 5 + 1))
        b = np.concatenate([a[cut:], rng.integers(0, 1 << 63, extra, dtype=np.uint64)])
        common = size - cut
        if 5 * common < 4 * (size + extra) or cut + extra == 0:
            continue
        scarce = rng.integers(0, 4096 if turn % 2 else 3, 1 << J.COUNT_LOG_CELLS).astype(np.uint16)
        kept = []
        for h in (a, b):
            s = J.Sets.__new__(J.Sets)
            s.rows, s.row, s.h = 1, np.zeros(len(h), np.int64), h
            s.size = np.array([len(h)])
            kept.append(set(J.signatures(s, np.array([True]), scarce)[0].tolist()))
        assert kept[0] & kept[1]


def test_a_group_of_changed_copies_makes_few_candidates(spark, docs_of):
    """Copies changed in too many places to link, and texts around one passage, share no signatures."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 400):
        t = list(base)
        for _ in range(rng.choice([1, 2, 12, 14, 16])):
            t[rng.randrange(len(t))] = f"x{rng.randrange(10**9)}"
        rows.append((i, " ".join(t)))
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(1000 + i, " ".join(f"o{i} {j}" for j in range(20)) + " " + passage) for i in range(300)]
    sigs = J.signature_rows(docs_of(rows), "doc_id", "text", 5)
    held = sigs.groupBy("sig").count().filter("count > 1").agg(F.sum("count")).first()[0]
    far = sigs.select("node").distinct().count()
    assert far == len(rows) and held < 30 * len(rows)
    got = sorted(map(tuple, J.jaccard_classes(docs_of(rows)).collect()))
    assert got == sorted(brute(rows)[0])


def test_sketch_never_exceeds_the_difference():
    rng = np.random.default_rng(0)
    for n, m in ((10, 12), (100, 90), (700, 40)):
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        b = np.concatenate([a[:n // 2], rng.integers(0, 1 << 63, m, dtype=np.uint64)])
        sketches = []
        for h in (a, b):
            s = J.Sets.__new__(J.Sets)
            s.rows, s.row, s.h, s.size = 1, np.zeros(len(h), np.int64), h, np.array([len(h)])
            sketches.append(s.sketches()[0])
        assert J._sketch_distance(*sketches) <= len(set(a.tolist()) ^ set(b.tolist()))


def test_nodes_meet_nodes_only_where_their_hubs_leave_it_open(docs_of, monkeypatch):
    """Two groups of copies around texts that are a little too far apart: each node meets the other hub, not all its nodes."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(150)]
    other = list(base)
    for p in (40, 80, 120, 146):
        other[p] = f"v{p}"
    rows = []
    for i in range(240):
        t = list(base if i % 2 else other)
        if i > 1:
            t[rng.randrange(2)] = f"x{i}"
        rows.append((i, " ".join(t)))
    met = []
    bounded = J.bounded_pairs
    monkeypatch.setattr(J, "bounded_pairs", lambda pairs, nodes: met.append(pairs.count()) or bounded(pairs, nodes))
    got = sorted(map(tuple, J.jaccard_classes(docs_of(rows)).collect()))
    assert got == sorted(brute(rows)[0])
    assert sum(met) < 8 * len(rows), met


def test_holders_of_a_passage_meet_only_where_a_link_has_room(docs_of, monkeypatch):
    """Texts that hold one passage and a little too much of their own: no pair of them is compared."""
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, " ".join(f"o{i}_{j}" for j in range(8)) + " " + passage) for i in range(150)]
    rows += [(1000 + i, f"{passage} tail{i}") for i in range(3)]
    met = []
    bounded = J.bounded_pairs
    monkeypatch.setattr(J, "bounded_pairs", lambda pairs, nodes: met.append(pairs.count()) or bounded(pairs, nodes))
    got = sorted(map(tuple, J.jaccard_classes(docs_of(rows)).collect()))
    assert got == sorted(brute(rows)[0])
    assert sum(met) < 2 * len(rows), met
