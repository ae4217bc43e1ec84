"""Exports: formula neutralization, name clashes, CSV and JSON shape, corrections."""

import json

from pyspark.sql import functions as F

from mercato.operators import sentiment as X
from mercato.plans.reviews import analyze_reviews
from mercato.sources import sinks


def test_neutralize_formulas(spark):
    df = spark.createDataFrame([("=1+1",), ("  +x",), ("-3",), ("@a",), ("ok=1",)], "c string")
    got = [r[0] for r in df.select(sinks.neutralize_formulas(F.col("c"))).collect()]
    assert got == ["'=1+1", "'  +x", "'-3", "'@a", "ok=1"]


def test_annotation_name_clash():
    names = sinks.annotation_names(["texte", "analyse_sentiment", "_analyse_sentiment"])
    assert names[0] == "__analyse_sentiment" and names[1] == "analyse_sentiment_initial"


def test_csv_and_json_export(spark, tmp_path):
    df = spark.createDataFrame([(1, "=1+1 super", "5"), (2, 'dit "bad"', "1")], "row_id int, texte string, note string")
    rows = analyze_reviews(df, "texte", None, "note")
    out = sinks.export_reviews_csv(rows, ["texte", "note"], str(tmp_path / "csv"))
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "csv").glob("part-*.txt")))
    assert data.startswith(b"\xef\xbb\xbf") and data.endswith(b"\r\n")
    text = data.decode("utf-8-sig")
    assert text.startswith('"texte";"note";"analyse_sentiment"') and text.count('"texte"') == 1
    assert [line.split(";")[1] for line in text.split("\r\n")[:3]] == ['"note"', '"5"', '"1"']
    assert "\"'=1+1 super\"" in text and '"dit ""bad"""' in text
    sinks.export_reviews_json(rows, ["texte", "note"], str(tmp_path / "json"))
    objs = [json.loads(line) for p in (tmp_path / "json").glob("part-*.json") for line in p.read_text().splitlines()]
    assert {o["source"]["texte"] for o in objs} == {"=1+1 super", 'dit "bad"'}
    assert all(o["analyse"]["avis_analyses"] == 2 for o in objs)
    assert out


def test_corrections_keep_initial(spark):
    df = spark.createDataFrame([(1, "bad"), (2, "great")], "row_id int, t string")
    rows = analyze_reviews(df, "t")
    corr = spark.createDataFrame([(1, "Positif")], "row_id int, sentiment string")
    got = {r["row_id"]: r for r in X.apply_corrections(rows, corr).collect()}
    assert got[1]["sentiment"] == "Positif" and got[1]["sentiment_initial"] == "Négatif"
    assert got[1]["corrected"] and not got[1]["uncertain"]
    assert got[2]["sentiment"] == "Positif" and not got[2]["corrected"]


def test_write_model_and_bi_star(spark, tmp_path, sf_small):
    from mercato.plans import measures as MS
    from mercato.plans import registry
    m = registry.full_model(spark, sf_small)
    paths = sinks.write_model({"fact_orders": m.fact_orders.select("order_id", "purchase_month", "item_value")},
                              str(tmp_path / "model"), partition_by={"fact_orders": ["purchase_month"]})
    back = spark.read.parquet(paths[0])
    assert back.count() == m.fact_orders.count()
    assert any(p.name.startswith("purchase_month=") for p in (tmp_path / "model" / "fact_orders").iterdir())
    star = sinks.export_bi_star(MS.bi_tables(m), str(tmp_path / "star"))
    assert len(star) == 7
    assert spark.read.parquet(str(tmp_path / "star" / "DimSellers")).filter(
        F.col("Vendeur") == "Vendeur 0001").count() == 1
