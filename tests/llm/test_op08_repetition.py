import random
import re
from collections import Counter

from mercato.llm import repetition as R


def brute(text, least):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = len(ws)
    windows = Counter(tuple(ws[i:i + 3]) for i in range(n - 2))
    mark = [False] * n
    for i in range(n - 2):
        if windows[tuple(ws[i:i + 3])] > 1:
            mark[i:i + 3] = [True] * 3
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    covered, longest = [False] * n, 0
    for i in range(n):
        for j in range(i + 1, n):
            k = 0
            while j + k < n and ws[i + k] == ws[j + k]:
                k += 1
            if k >= least:
                longest = max(longest, k)
                for q in range(k):
                    covered[i + q] = covered[j + q] = True
    return (n, sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), dup, sum(mark), sum(covered), longest)


def test_equals_brute_force(docs_of, odd_rows):
    rng = random.Random(3)
    rows = [r for r in odd_rows if r[1] is None or len(r[1]) < 1000]
    rows += [(100 + i, " ".join(rng.choice("abc#é") for _ in range(rng.randrange(70))) + rng.choice(["", "\nx y\nx y", "\n\n"]))
             for i in range(80)]
    got = R.repetition_figures(docs_of(rows), min_repeat=4).collect()
    names = [c.split()[0] for c in R.SCHEMA.split(", ")]
    have = sorted(((r["doc_id"] is None, r["doc_id"] or 0, tuple(r[c] for c in names)) for r in got))
    assert have == sorted(((i is None, i or 0, brute(t, 4)) for i, t in rows))


def test_verdicts(docs_of):
    rng = random.Random(1)
    clean = " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(9999)}" for _ in range(300))
    part = " ".join(f"w{i}" for i in range(80))
    rows = [(1, clean), (2, "too short"), (3, (part + " ") * 3), (4, clean + " " + part + " x " + part), (5, None)]
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in R.verdicts(R.repetition_figures(docs_of(rows))).collect()}
    assert got == {1: (False, True), 2: (True, False), 3: (True, False), 4: (False, True), 5: (True, False)}
    strict = R.verdicts(R.repetition_figures(docs_of(rows)), max_covered=0.2)
    assert {r["doc_id"]: r["kept"] for r in strict.collect()}[4] is False
    strict = R.verdicts(R.repetition_figures(docs_of(rows)), max_longest=79)
    assert {r["doc_id"]: r["kept"] for r in strict.collect()}[4] is False


def test_long_and_empty(docs_of, odd_rows):
    long = [r for r in odd_rows if r[0] == 5]
    r = R.repetition_figures(docs_of([(5, long[0][1] + " " + long[0][1])])).first()
    assert (r["n_words"], r["covered_words"], r["longest_repeat"]) == (120_000, 120_000, 60_000)
    assert R.repetition_figures(docs_of([])).collect() == []


def test_method_alone_rejects_at_default_limits(docs_of):
    fresh = iter(range(100_000))
    own = lambda n: " ".join(f"v{next(fresh)}" for _ in range(n))
    part, line = own(150), own(15)
    rows = [(1, f"{own(200)} {part} {own(100)} {part} {own(100)}"),         # 700 words, 43 % covered
            (2, "\n".join(f"{own(25)}\n{line}" for _ in range(10))),        # 400 words, 37.5 % covered
            (3, f"{own(745)} {' '.join([line] * 17)}"),                     # 1,000 words, one repeat of 240
            (4, f"{own(500)} {line} {own(300)} {line}"), (5, own(700))]
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in R.verdicts(R.repetition_figures(docs_of(rows))).collect()}
    assert got == {1: (False, False), 2: (False, False), 3: (False, False), 4: (False, True), 5: (False, True)}
