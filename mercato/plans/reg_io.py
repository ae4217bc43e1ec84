"""Round trips of readers and sinks over the driver's tables: written to the shared folder, read back, compared by SQL
with the table that was written (A01, A05-A09, A11, B01, B02, B04, B05)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.plans import measures as MS
from mercato.plans import reviews as R
from mercato.plans.model import with_written_orders
from mercato.plans.oracle_sql import q as sql
from mercato.plans.reg_reviews import analyzed, rsql
from mercato.plans.reg_study import RATED_SQL
from mercato.plans.registry import light_model, register
from mercato.session import scratch_path, table_path
from mercato.sources import sinks
from mercato.sources.raw import delimited_table
from mercato.sources.reviews import read_reviews_delimited, read_reviews_json, read_text

_TEXT_MD5 = "md5(coalesce(text, ''))"


def _documents(s, d) -> DataFrame:
    return s.read.parquet(table_path(d, "documents"))


def _delimited(s, d):
    """Texts with line ends, quotes and separators, as one CSV document in parts."""
    path = scratch_path(s, "csv")
    docs = _documents(s, d).select(F.col("doc_id").alias("_at"), F.col("doc_id").cast("string").alias("doc_id"), "text", "lang")
    sinks.export_lines(docs, ["_at"], path)
    back = read_reviews_delimited(s, path, ";", "utf-8", header="first")
    return back.select("doc_id", F.md5("text").alias("text_md5"), "lang", "row_id")


register("import_delimited_roundtrip", f"""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, {_TEXT_MD5} AS text_md5, lang, ROW_NUMBER() OVER (ORDER BY doc_id) AS row_id FROM documents
""")(_delimited)


def _raw(s, d):
    """Every part file with its own header, read as a raw all-string table."""
    path = scratch_path(s, "raw")
    docs = _documents(s, d).select(*[F.col(c).cast("string").alias(c) for c in ("doc_id", "text", "lang", "source", "n_chars")])
    docs.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    back = delimited_table(s, path)
    return back.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"), "lang", "source", "n_chars")


register("raw_table_roundtrip", f"""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, {_TEXT_MD5} AS text_md5, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents
""")(_raw)


def _json_lines(s, d):
    path = scratch_path(s, "jsonl")
    docs = _documents(s, d)
    docs.select("doc_id", "text", F.struct("lang", "n_chars").alias("about")).write.json(path)
    back = read_reviews_json(s, path, lines=True)
    return back.select("doc_id", F.md5("text").alias("text_md5"), "about")


register("import_json_roundtrip", f"""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, {_TEXT_MD5} AS text_md5,
       '{{"lang":"' || lang || '","n_chars":' || n_chars || '}}' AS about FROM documents
""")(_json_lines)


def _texts(s, d) -> str:
    """Every document as a paragraph or more of plain text, an empty line after each."""
    path = scratch_path(s, "txt")
    _documents(s, d).select(F.concat("text", F.lit("\n")).alias("value")).write.text(path)
    return path


def _counted(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.md5("texte").alias("texte_md5")).agg(F.count(F.lit(1)).alias("n"))


# ASCII white space and the other line ends of the reader at both ends of a part.
_TRIM = r"regexp_replace(x, '^[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+|[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+$', '', 'g')"

register("import_text_lines", rf"""
SELECT md5(t) AS texte_md5, COUNT(*) AS n FROM (
  SELECT {_TRIM} AS t FROM (SELECT unnest(regexp_split_to_array(text, '\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{{85}}\x{{2028}}\x{{2029}}]')) AS x FROM documents))
WHERE t <> '' GROUP BY 1
""")(lambda s, d: _counted(read_text(s, _texts(s, d))))

register("import_text_paragraphs", rf"""
SELECT md5(t) AS texte_md5, COUNT(*) AS n FROM (
  SELECT {_TRIM} AS t FROM (SELECT unnest(regexp_split_to_array(text, '\n\s*\n')) AS x FROM documents))
WHERE t <> '' GROUP BY 1
""")(lambda s, d: _counted(read_text(s, _texts(s, d), "paragraphs")))


def _export_csv(s, d):
    """Annotated reviews exported as one document and imported again."""
    path = scratch_path(s, "export")
    sinks.export_reviews_csv(analyzed(s, d, True), ["texte", "langue"], path)
    back = read_reviews_delimited(s, path, ";", "utf-8-sig", header="first")
    return back.select(F.md5("texte").alias("texte_md5"), "langue", "analyse_sentiment", "analyse_themes", "analyse_indices", "analyse_texte_repete",
                       "analyse_a_verifier", "analyse_avis_analyses", "row_id")


register("export_reviews_roundtrip", rsql(r"""
SELECT md5(regexp_replace(rv.texte, '^(\s*[=+@\-])', '''\1')) AS texte_md5, rv.langue, sentiment AS analyse_sentiment, themes AS analyse_themes,
       regexp_replace(evidence, '^(\s*[=+@\-])', '''\1') AS analyse_indices, CAST(duplicate AS VARCHAR) AS analyse_texte_repete,
       CAST(sentiment = 'Indéterminé' AS VARCHAR) AS analyse_a_verifier, CAST(COUNT(*) OVER () AS VARCHAR) AS analyse_avis_analyses,
       ROW_NUMBER() OVER (ORDER BY rv.row_id) AS row_id
FROM annot JOIN rv USING (row_id)
"""))(_export_csv)


def _export_json(s, d):
    path = scratch_path(s, "json")
    sinks.export_reviews_json(analyzed(s, d, True), ["row_id", "langue"], path)
    back = s.read.schema("source struct<row_id: bigint, langue: string>, analyse struct<sentiment: string, themes: array<string>, "
                         "texte_repete: boolean, avis_analyses: bigint>").json(path)
    return back.select("source.row_id", "source.langue", "analyse.sentiment", F.array_join("analyse.themes", " | ").alias("themes"),
                       "analyse.texte_repete", "analyse.avis_analyses")


register("export_json_roundtrip", rsql("""
SELECT row_id, langue, sentiment, themes, duplicate AS texte_repete, COUNT(*) OVER () AS avis_analyses FROM annot
"""))(_export_json)


def _model(s, d):
    """Facts and BI tables written side by side, the order fact by month, and read back."""
    path = scratch_path(s, "model")
    m = with_written_orders(light_model(s, d))
    names = sinks.write_model({"fact_orders": m.fact_orders.select("order_id", "purchase_month", "item_value")}, path,
                              partition_by={"fact_orders": ["purchase_month"]})
    star = MS.bi_tables(m)
    names += sinks.export_bi_star({k: star[k] for k in ("FactItems", "DimProducts", "DimSellers", "DimDate", "Cohorts", "ReviewAnalysis")}, path)
    out = None
    for name in names:
        row = s.read.parquet(name).agg(F.lit(name.rsplit("/", 1)[1]).alias("table"), F.count(F.lit(1)).alias("rows"))
        out = row if out is None else out.unionByName(row)
    by_month = s.read.parquet(names[0]).groupBy(F.col("purchase_month").cast("string").alias("month")).agg(F.count(F.lit(1)).alias("rows"))
    return out.unionByName(by_month.select(F.concat(F.lit("fact_orders "), "month").alias("table"), "rows"))


register("model_roundtrip", sql("""
SELECT 'fact_orders' AS "table", COUNT(*) AS rows FROM fact_base
UNION ALL SELECT 'FactItems', COUNT(*) FROM fact_items UNION ALL SELECT 'DimProducts', COUNT(*) FROM s_products
UNION ALL SELECT 'DimSellers', COUNT(*) FROM s_sellers
UNION ALL SELECT 'DimDate', date_diff('day', date_trunc('month', MIN(purchase_date)), last_day(MAX(purchase_date))) + 1 FROM fact_base
UNION ALL SELECT 'Cohorts', COUNT(*) FROM customer_cohorts UNION ALL SELECT 'ReviewAnalysis', COUNT(*) FROM rated
UNION ALL SELECT 'fact_orders ' || purchase_month, COUNT(*) FROM fact_base GROUP BY purchase_month
""", RATED_SQL))(_model)
