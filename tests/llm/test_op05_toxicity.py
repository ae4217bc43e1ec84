import math
import random
import re

from mercato.llm import toxicity as X


def corpus(n=600):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    bad = ["vile1", "vile2", "vile3"]
    rows, labels = [], []
    for i in range(n):
        toxic = int(i % 6 == 0)
        w = [rng.choice(words) for _ in range(rng.randrange(5, 60))] + ([rng.choice(bad)] * 2 if toxic else [])
        rng.shuffle(w)
        rows.append((i, " ".join(w)))
        labels.append((i, 1, toxic))
    return rows, labels


def frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark, docs_of):
    rows, labels = corpus()
    docs = docs_of(rows)
    got = X.toxicity_scores(docs, X.train(docs, frame(spark, labels))).collect()
    truth = dict((i, t) for i, _, t in labels)
    assert all(r["held_out"] == X.held_out_of(r["doc_id"]) for r in got)
    rest = [r for r in got if r["held_out"]]
    assert len(rest) > 80
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in rest) >= 0.98 * len(rest)
    assert all(r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in got)


def test_held_out_labels_are_not_used(spark, docs_of):
    rows, labels = corpus(300)
    docs = docs_of(rows)
    flipped = [(i, q, 1 - t if X.held_out_of(i) else t) for i, q, t in labels]
    a, b = (X.train(docs, frame(spark, x)) for x in (labels, flipped))
    assert (a.weights == b.weights).all() and a.bias == b.bias


def test_swaps_hold_scores_together():
    with_term, without = (X.fit([], [], swap_weight=s) for s in (20.0, 0.0))

    def spread(model):
        block = lambda s: next(X.V.blocks(X.pa.array([s])))
        scores = [model.scores(block(f"she met a {g} teacher"))[0] for kind in X.GROUPS.values() for g in kind]
        return max(scores) - min(scores), max(scores)

    # The fixed sentences give each group word the same share of abuse; this sample does not.
    rows = [(1, X._hash_words(f"those muslim folk {i}")) for i in range(60)] + [(0, X._hash_words(f"those christian folk {i}")) for i in range(60)]
    held, free = (X.fit(rows, [], swap_weight=s) for s in (200.0, 0.0))
    assert spread(held)[0] < 0.5 * spread(free)[0]
    assert spread(with_term)[1] < 0.5


def test_odd_rows(spark, docs_of, odd_rows):
    docs = docs_of(odd_rows)
    model = X.train(docs, frame(spark, [(1, 0, None), (None, 1, 1), (99, 1, 1)]))
    got = X.toxicity_scores(docs, model).collect()
    assert len(got) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (1, 2, 3)}) == 1
    assert X.toxicity_scores(docs_of([]), model).collect() == []


def test_group_words_outside_the_chosen_ones_are_swapped(spark, docs_of, monkeypatch):
    rows, labels = corpus(300)
    rows = [(i, t + " muslim") for i, t in rows]
    seen = {}
    monkeypatch.setattr(X, "calibrated", lambda data, words: seen.update(data=data, words=words))
    X.train(docs_of(rows), frame(spark, labels), max_words=3)
    kinds, word = X.group_kinds(), X._hash_words("muslim")[0]
    assert word not in seen["words"] and len(seen["data"]) == sum(not X.held_out_of(i) for i, _ in rows)
    assert all(len(X.swaps(ws, kinds)) == len(kinds[word]) - 1 for _, ws in seen["data"])


def test_scores_equal_a_plain_sum(spark, docs_of, odd_rows):
    """Every whole text's score is the logistic function of the bias and the weights of its distinct words."""
    rows, labels = corpus(300)
    rows = rows + [(1000 + (i or 0), t) for i, t in odd_rows] + [(2000, "Vile1 VILE1, vile2; w3 w3")]
    docs = docs_of(rows)
    model = X.train(docs, frame(spark, labels))
    weight = dict(zip(model.words.tolist(), model.weights.tolist()))
    for r in X.toxicity_scores(docs, model).collect():
        texts = [t for i, t in rows if i == r["doc_id"]]
        wanted = []
        for t in texts:
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
            words = set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low))
            z = model.bias + sum(weight.get(h, 0.0) for w in words for h in X._hash_words(w))
            wanted.append(1 / (1 + math.exp(-max(-40.0, min(40.0, z)))))
        assert any(abs(r["score"] - x) < 1e-9 for x in wanted)
