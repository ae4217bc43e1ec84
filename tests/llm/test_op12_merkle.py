import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from mercato.llm import merkle as M


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def climb(leaves):
    """Root of a list, and per leaf its siblings level by level."""
    paths = [[] for _ in leaves]
    groups, level = [[i] for i in range(len(leaves))], list(leaves)
    while len(level) > 1:
        up, over = [], []
        for s in range(0, len(level), 8):
            run = level[s:s + 8]
            up.append(H(*run))
            for k in range(len(run)):
                for i in groups[s + k]:
                    paths[i].append((run[:k], run[k + 1:]))
            over.append(sum(groups[s:s + 8], []))
        level, groups = up, over
    return level[0], paths


def brute(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    def leaf(r, text):
        return H(field(r[0]), field(r[3]), field(r[2]), field(r[4]), field(text))

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        mine = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees.append((mine, *climb([leaf(r, r[1]) for r in mine])))
    root, tops = climb([t[1] for t in trees])
    out = []
    for (mine, subroot, paths), top in zip(trees, tops):
        for r, path in zip(mine, paths):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            fold = leaf(r, lowered(r[1]) if hit else r[1])
            for left, right in path + top:
                fold = H(*left, fold, *right)
            proof = H(*[d for left, right in path + top for d in left + right])
            out.append((r[0], leaf(r, r[1]), subroot, root, proof, fold, fold == root))
    return sorted(out, key=str)


def run(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, "
                                 "leaf string, run int, id string").repartition(3)
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 0
    got = M.audit(docs, {"text": F.when(hit, M.ascii_lower(F.col("text"))).otherwise(F.col("text"))}).collect()
    return sorted((tuple(r) for r in got), key=str)


def case(sizes, first=0):
    rows = []
    for lang, n in sizes.items():
        for _ in range(n):
            i = first + 7 * len(rows)
            rows.append((i, ["Äpfel Und Birnen", "PLAIN Text", "all lower", "", None][i % 5], lang, [None, "s1"][i % 2], [None, i][i % 3 > 0]))
    return rows


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {"a": 2}, {"a": 8}, {"a": 9}, {"a": 65}, {"a": 1, "b": 1}, {"": 3, None: 12, "z": 1, "é": 70, "e": 600},
    {f"g{k}": k % 4 + 1 for k in range(80)}])
def test_equals_brute_force(spark, sizes):
    rows = case(sizes)
    assert run(spark, rows) == brute(rows)


def test_copies_of_high_nodes_serve_blocks(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 8)
    rows = case({"a": 1100, "b": 90, None: 1})
    assert run(spark, rows) == brute(rows)


def test_nulls_ties_repeated_and_long_rows(spark, odd_rows):
    rows = [(i, t, ["en", None][k % 2], "s", k % 3) for k, (i, t) in enumerate(odd_rows)]
    rows += [rows[0], rows[0], (None, None, None, None, None), (None, "-", "en", "", 0)] + [(30, "Same", "en", "s", 4)] * 11
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_recursion_limit_is_restored(spark):
    before = spark.conf.get(M._ROW_LIMIT)
    run(spark, case({"a": 20, "b": 2}))
    assert spark.conf.get(M._ROW_LIMIT) == before
