"""The review rules against plain Python, and that a filter on them does not evaluate them again."""

import re
from collections import Counter

from pyspark.sql import functions as F

from mercato.functions import text as T
from mercato.operators import sentiment as X
from mercato.plans import reviews as R

TEXTS = ["Not a good, great product", "pas tres rapide. Great", "never, great broken", "", None, " \u2003\n", "\x1f", "Déçu! Été GREAT",
         "no no great great great", "late late", "\u00a0great\u3000", "colis 中 great bad", "no mais great", "NO MAIS\tgréat ", "not a b c great", "İ great"]


def _plain(text):
    """(sentiment, themes, evidence) of the rules."""
    space = set(T.WHITE_SPACE)
    if all(ch in space for ch in text or ""):
        return X.NO_TEXT, [], []
    tk = re.findall(T.TOKEN_PATTERN, T.normalize_py(text))
    signs, seen = set(), []
    for i, t in enumerate(tk):
        if t in X.POSITIVE or t in X.NEGATIVE:
            sign = 1 if t in X.POSITIVE else -1
            for back in reversed(tk[max(0, i - 3):i]):
                if back in X.BREAKERS:
                    break
                if back in X.NEGATORS:
                    sign = -sign
                    break
            signs.add(sign)
            seen += [t] if t not in seen else []
    name = {(): X.UNDETERMINED, (1,): X.POS, (-1,): X.NEG}.get(tuple(sorted(signs)), X.MIXED)
    return name, [th for th, ws in X.THEMES.items() if set(ws) & set(tk)], seen


def _rows(spark):
    return spark.createDataFrame([(i, t, "1" if i % 2 else "5") for i, t in enumerate(TEXTS)], "row_id int, texte string, note string")


def test_rules_equal_plain_python(spark):
    got = R.analyze_reviews(_rows(spark), "texte", rating_col="note", duplicates=False).select("row_id", "sentiment", "themes", "evidence")
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == {i: _plain(t) for i, t in enumerate(TEXTS)}


def test_a_filter_on_the_rules_cuts_each_text_once(spark):
    rows = R.analyze_reviews(_rows(spark), "texte", rating_col="note", duplicates=False)
    for query in (rows.filter(X.rating_conflict(F.col("rating"), F.col("sentiment"))).select("row_id", "sentiment"),
                  rows.select(F.explode("themes").alias("theme")).groupBy("theme").count(),
                  rows.filter((F.col("sentiment") != X.NO_TEXT) & (F.col("sentiment") != X.POS)).select("row_id")):
        assert query._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1


def test_a_rule_that_nobody_reads_is_dropped(spark):
    rows = R.analyze_reviews(_rows(spark), "texte", rating_col="note", duplicates=False)
    assert "regexp_extract_all" not in rows.select("row_id", "rating")._jdf.queryExecution().optimizedPlan().toString()


def test_duplicate_key_is_worked_out_once(spark):
    from mercato.streaming import reviews as ST
    keys = ST._keyed(_rows(spark), "texte").select("dup_hash").filter(F.col("dup_hash").isNotNull()).groupBy("dup_hash").count()
    assert keys._jdf.queryExecution().optimizedPlan().toString().count("sha2") == 1
    plain = Counter(re.sub(f"[{T.WHITE_SPACE}]+", " ", T.normalize_py(t or "")).strip(" ") for t in TEXTS)
    assert sorted(r["count"] for r in keys.collect()) == sorted(n for k, n in plain.items() if k)


def test_models_score_without_a_second_pass(spark):
    from mercato.operators.scoring import LexiconScorer
    rows = R.analyze_reviews(_rows(spark), "texte", rating_col="note", duplicates=False,
                             scorer_factory=lambda: LexiconScorer(X.POSITIVE, X.NEGATIVE))
    got = rows.select("row_id", "chunks")
    assert {r[0]: r[1] for r in got.collect()} == {i: None if _plain(t)[0] == X.NO_TEXT else 1 for i, t in enumerate(TEXTS)}
    assert got._jdf.queryExecution().optimizedPlan().toString().count("MapInPandas") == 1
    assert got._jdf.queryExecution().optimizedPlan().toString().count("@user") == 1
