import random
import re

from mercato.llm import decontaminate as D


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def grams(w, k):
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute(docs, items):
    out = set()
    for i, item in items:
        w = words(item)
        if not w:
            continue
        k = min(5, len(w))
        want = grams(w, k)
        for d, text in docs:
            n = len(want & grams(words(text), k))
            if 5 * n >= 4 * len(want):
                out.add((d, i, len(want), n))
    return out


def case(seed=4):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(2000)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(n))) for i, n in enumerate([1, 2, 4, 5, 6, 9, 15, 30, 59, 59, 120])]
    items += [(50, None), (51, ""), (52, items[7][1]), (52, items[7][1]), (53, items[8][1].upper().replace(" ", ", "))]
    docs = [(1100, None), (1101, ""), (None, items[6][1])]
    for d in range(120):
        w = [rng.choice(vocabulary) for _ in range(rng.choice([3, 40, 400]))]
        for _ in range(rng.randrange(3)):
            t = (rng.choice(items)[1] or "").split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                if t:
                    t[rng.randrange(len(t))] = "changed"
            at = rng.randrange(len(w))
            w[at:at] = t
        docs.append((d, " ".join(w)))
    return docs + docs[:10], items


def tables(spark, docs_of, docs, items):
    return docs_of(docs), spark.createDataFrame(items, "item_id long, text string")


def test_equals_brute_force(spark, docs_of):
    docs, items = case()
    got = D.contaminated(*tables(spark, docs_of, docs, items)).collect()
    have = [(r["doc_id"], r["item_id"], r["n_shingles"], r["n_shared"]) for r in got]
    assert len(have) == len(set(have))
    assert set(have) == brute(docs, items)


def test_clean_rows_stay(spark, docs_of):
    docs, items = case(7)
    frame, bench = tables(spark, docs_of, docs, items)
    left = D.without_contaminated(frame, bench)
    assert left.columns == frame.columns
    bad = {(r[0]) for r in brute(docs, items)}
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(str(d) for d, _ in docs if d not in bad)


def test_item_in_a_very_long_text(spark, docs_of, odd_rows):
    long = next(t for i, t in odd_rows if i == 5)
    item = " ".join(f"q{i}" for i in range(12))
    frame, bench = tables(spark, docs_of, [(1, long + " " + item), (2, long)], [(9, item)])
    assert [(r["doc_id"], r["containment"]) for r in D.contaminated(frame, bench).collect()] == [(1, 1.0)]


def test_empty_tables(spark, docs_of):
    docs, items = case()
    assert D.contaminated(*tables(spark, docs_of, [], items)).collect() == []
    assert D.contaminated(*tables(spark, docs_of, docs, [])).collect() == []
    assert D.without_contaminated(*tables(spark, docs_of, docs, [])).count() == len(docs)
