"""Review rules and text functions."""

import pytest
from pyspark.sql import functions as F

from mercato.functions import text as T
from mercato.operators import sentiment as X
from mercato.plans.reviews import analyze_reviews


def classify(spark, text):
    df = spark.createDataFrame([(1, text)], "row_id int, t string")
    return analyze_reviews(df, "t").select("sentiment", "themes", "evidence").first()


@pytest.mark.parametrize("text,label", [
    ("great", "Positif"), ("Bad!", "Négatif"), ("great, then bad", "Mixte"), ("table, chair", "Indéterminé"),
    ("\t", "Sans texte"), ("GREAT", "Positif"), ("not great", "Négatif"), ("日本語", "Indéterminé")])
def test_lexicon_rules(spark, text, label):
    assert classify(spark, text)["sentiment"] == label


def test_every_polarity_word_counts(spark):
    rows = [(i, w, "Positif" if w in X.POSITIVE else "Négatif") for i, w in enumerate([*X.POSITIVE, *X.NEGATIVE]) if w.isascii() and w.isalpha()]
    df = spark.createDataFrame(rows, "row_id int, t string, want string")
    wrong = analyze_reviews(df, "t", duplicates=False).filter("sentiment <> want").select("t", "sentiment").collect()
    assert wrong == []


def test_evidence_is_listed_once(spark):
    assert classify(spark, "great. great, bad")["evidence"] == ["great", "bad"]


@pytest.mark.parametrize("raw,value", [
    ("3", 3.0), (" 2,5 ", 2.5), ("4.0", 4.0), ("+1", 1.0), ("5\u00a0", 5.0), ("1e0", 1.0), (".5", 0.5), ("-2", -2.0),
    ("5d", None), ("4f", None), ("0x1p2", None), ("NaN", None), ("Infinity", None), ("1e999", None), ("1 2", None), ("", None),
    (None, None), ("cinq", None), ("1,2,3", None)])
def test_ratings(spark, raw, value):
    df = spark.createDataFrame([(raw,)], "r string")
    assert df.select(T.parse_rating("r")).first()[0] == value


def test_duplicates_over_all_rows(spark):
    texts = ["Bon  achat", "bon achat", "BÓN ACHAT ", "bon", "", None, "  "]
    df = spark.createDataFrame(list(enumerate(texts)), "row_id int, t string").repartition(3)
    got = {r["row_id"] for r in analyze_reviews(df, "t").filter("duplicate").collect()}
    assert got == {0, 1, 2}
    assert "duplicate" not in analyze_reviews(df, "t", duplicates=False).columns


def test_theme_phrases_match_whole_words(spark):
    df = spark.createDataFrame([(1, "la boîte à outils est là"), (2, "aboite a outilsx"), (3, "outils")], "row_id int, t string")
    rules = {"Atelier": ["boite a outils", "  "], "Rien": []}
    got = {r["row_id"]: r["themes"] for r in analyze_reviews(df, "t", theme_rules=rules, duplicates=False).collect()}
    assert got == {1: ["Atelier"], 2: [], 3: []}


def test_normalize_exact_for_non_latin(spark):
    vals = ["Ｆｕｌｌ ｗｉｄｔｈ", "ﬁne", "Ça VA", "naïve café", "Ελληνικά", None]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    got = [r[0] for r in df.select(T.normalize_text("t")).collect()]
    assert got == [T.normalize_py(v or "") for v in vals]


def test_compose_and_mask(spark):
    df = spark.createDataFrame([("  Titre ", " corps  ", "voir https://x.y/z et @bob, mail a@b")],
                               "ti string, tx string, m string")
    r = df.select(T.compose_text("ti", "tx").alias("c"), T.mask_handles_urls(F.col("m")).alias("k")).first()
    assert r["c"] == "Titre corps"
    assert r["k"] == "voir http et @user, mail a@b"


def test_rating_conflict(spark):
    df = spark.createDataFrame([(1.0, "Positif"), (5.0, "Négatif"), (3.0, "Positif"), (9.0, "Positif"),
                                (None, "Positif")], "r double, s string")
    got = [r[0] for r in df.select(X.rating_conflict(F.col("r"), F.col("s"), 5)).collect()]
    assert got == [True, True, False, False, False]
    got10 = [r[0] for r in df.select(X.rating_conflict(F.col("r"), F.col("s"), 10)).collect()]
    assert got10 == [True, False, False, False, False]


def test_summaries_keep_zero_classes_and_empty_selection(spark):
    df = spark.createDataFrame([(1, "ok great"), (2, "bad")], "row_id int, t string")
    rows = analyze_reviews(df, "t")
    s = {r["sentiment"]: (r["n"], r["share_pct"]) for r in X.sentiment_summary(rows).collect()}
    assert s["Positif"] == (1, 50.0) and s["Mixte"] == (0, 0.0) and len(s) == 6
    empty = X.sentiment_summary(rows.filter(F.lit(False))).collect()
    assert all(r["n"] == 0 and r["share_pct"] == 0.0 for r in empty)


def test_filters_sort_and_pages(spark):
    df = spark.createDataFrame([(i, "bad " * (i % 5) + "x", str(i % 6)) for i in range(36)],
                               "row_id int, t string, r string")
    rows = analyze_reviews(df, "t", None, "r").withColumn("language", F.lit("fr"))
    neg = X.review_filter(rows, X.ReviewFilter(sentiment="Négatif", language="fr", rating_min=1))
    assert neg.count() == len([i for i in range(36) if i % 5 and i % 6 >= 1])
    pages = [X.page(rows, k, 12, "low").select("row_id").collect() for k in range(3)]
    assert sum(len(p) for p in pages) == 36
    first = X.sort_reviews(rows, "high").first()
    assert first["rating"] == 5.0


def test_segment_text_modes(spark):
    from mercato.sources.reviews import segment_text
    df = spark.createDataFrame([("Premier avis\nSuite\n\nSecond avis",)], "text string")
    assert segment_text(df, "text", "lines").count() == 3
    assert segment_text(df, "text", "paragraphs").count() == 2


@pytest.mark.parametrize("bound", [0, 1_000_000], ids=["shuffle-join", "broadcast"])
def test_duplicate_paths(spark, monkeypatch, bound):
    monkeypatch.setattr(X, "BROADCAST_REPEATED_KEYS", bound)
    df = spark.createDataFrame([(1, "Très  bon"), (2, "tres bon"), (3, "autre"), (4, ""), (5, " ")],
                               "row_id int, t string")
    got = {r["row_id"]: r["duplicate"] for r in analyze_reviews(df, "t").collect()}
    assert got == {1: True, 2: True, 3: False, 4: False, 5: False}
