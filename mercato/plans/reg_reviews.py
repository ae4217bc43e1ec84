"""Registered review-triage queries over the driver's documents and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.functions import text as T
from mercato.operators import sentiment as X
from mercato.operators.scoring import LexiconScorer, score_texts, segments
from mercato.plans import reviews as R
from mercato.plans.registry import register
from mercato.session import table_path
from mercato.sources.sinks import neutralize_formulas

LX = R.FIXTURE_LEXICON


def _in(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


THEME_SQL = ", ".join(f"CASE WHEN list_has_any(tk, [{_in(ws)}]) THEN '{name}' END" for name, ws in LX.themes.items())

REVIEW_CTES = f"""
rv AS (SELECT d.doc_id AS row_id, d.text AS texte,
              CASE WHEN l.quality = 1 THEN '5' WHEN l.quality = 0 THEN '1' END AS note,
              d.lang AS langue, l.quality
       FROM documents d LEFT JOIN labels l USING (doc_id)),
an AS (SELECT *, length(regexp_replace(text, '\\s', '', 'g')) = 0 AS blank,
              TRY_CAST(trim(replace(coalesce(note, ''), ',', '.')) AS DOUBLE) AS rating0
       FROM (SELECT *, regexp_extract_all(nt, '[a-z]+|[.!?,;:]') AS tk
             FROM (SELECT *, strip_accents(lower(text)) AS nt
                   FROM (SELECT *, regexp_replace(coalesce(texte, ''), '^\\s+|\\s+$', '', 'g') AS text FROM rv)))),
toks AS (SELECT row_id, generate_subscripts(tk, 1) AS i, unnest(tk) AS t FROM an),
pol AS (SELECT row_id, i, t, CASE WHEN t IN ({_in(LX.positive)}) THEN 1 ELSE -1 END AS base
        FROM toks WHERE t IN ({_in(LX.positive)}) OR t IN ({_in(LX.negative)})),
flip AS (SELECT p.row_id, p.i,
                CASE WHEN EXISTS (SELECT 1 FROM toks n WHERE n.row_id = p.row_id AND n.i BETWEEN p.i - 3 AND p.i - 1
                                    AND n.t IN ({_in(LX.negators)})
                                    AND NOT EXISTS (SELECT 1 FROM toks b WHERE b.row_id = p.row_id AND b.i > n.i
                                                      AND b.i < p.i AND b.t IN ({_in(LX.breakers)})))
                     THEN -p.base ELSE p.base END AS final
         FROM pol p),
cnt AS (SELECT row_id, COUNT(*) FILTER (WHERE final > 0) AS np, COUNT(*) FILTER (WHERE final < 0) AS nn
        FROM flip GROUP BY row_id),
ev AS (SELECT row_id, string_agg(t, ' | ' ORDER BY fi) AS evidence
       FROM (SELECT row_id, t, MIN(i) AS fi FROM pol GROUP BY row_id, t) GROUP BY row_id),
dup AS (SELECT row_id, key <> '' AND COUNT(*) OVER (PARTITION BY key) > 1 AS duplicate
        FROM (SELECT row_id, trim(regexp_replace(nt, '\\s+', ' ', 'g')) AS key FROM an)),
annot AS (
  SELECT an.row_id, an.langue, an.quality, an.text, an.nt, an.tk,
         CASE WHEN blank THEN 'Sans texte' WHEN np > 0 AND nn > 0 THEN 'Mixte' WHEN np > 0 THEN 'Positif'
              WHEN nn > 0 THEN 'Négatif' ELSE 'Indéterminé' END AS sentiment,
         concat_ws(' | ', {THEME_SQL}) AS themes,
         coalesce(ev.evidence, '') AS evidence,
         CASE WHEN isnan(rating0) OR isinf(rating0) THEN NULL ELSE rating0 END AS rating,
         dup.duplicate
  FROM an LEFT JOIN cnt USING (row_id) LEFT JOIN ev USING (row_id) JOIN dup USING (row_id))
"""


def rsql(body: str, extra: str = "") -> str:
    ctes = REVIEW_CTES.strip() + ((",\n" + extra.strip()) if extra else "")
    return f"WITH {ctes}\n{body.strip()}"


def analyzed(s, d, duplicates=False):
    """Annotated fixture reviews; duplicates need a second look at all rows, so only
    the queries that show them ask for them."""
    return R.fixture_analyzed(s, d, duplicates=duplicates)


register("reviews_annotated", rsql("""
SELECT row_id, sentiment, themes, evidence, rating, duplicate, sentiment = 'Indéterminé' AS uncertain FROM annot
"""))(lambda s, d: analyzed(s, d, True).select(
    "row_id", "sentiment", F.array_join("themes", " | ").alias("themes"),
    F.array_join("evidence", " | ").alias("evidence"), "rating", "duplicate", "uncertain"))

register("review_tokens", rsql("""
SELECT row_id, len(tk) AS n_tokens, md5(array_to_string(tk, ' ')) AS token_hash FROM annot
"""))(lambda s, d: analyzed(s, d).select(
    "row_id", F.size("tokens").cast("bigint").alias("n_tokens"), F.md5(F.array_join("tokens", " ")).alias("token_hash")))

register("review_duplicates", rsql("""
SELECT COUNT(*) FILTER (WHERE duplicate) AS duplicate_rows, COUNT(*) AS rows FROM annot
"""))(lambda s, d: analyzed(s, d, True).agg(F.count_if("duplicate").alias("duplicate_rows"),
                                      F.count(F.lit(1)).alias("rows")))

SENT_VALUES = ", ".join(f"('{x}', {i})" for i, x in enumerate(X.SENTIMENTS))
register("sentiment_summary", rsql(f"""
SELECT c.sentiment, c.position, coalesce(n, 0) AS n,
       coalesce(coalesce(n, 0) * 100.0 / NULLIF(t.total, 0), 0.0) AS share_pct
FROM (VALUES {SENT_VALUES}) c(sentiment, position)
LEFT JOIN (SELECT sentiment, COUNT(*) AS n FROM annot GROUP BY 1) a USING (sentiment)
CROSS JOIN (SELECT COUNT(*) AS total FROM annot) t
"""))(lambda s, d: X.sentiment_summary(analyzed(s, d)))

THEME_VALUES = ", ".join(f"('{x}', {i})" for i, x in enumerate(LX.themes))
register("theme_summary", rsql(f"""
SELECT c.theme, c.position, coalesce(n, 0) AS n, coalesce(coalesce(n, 0) * 100.0 / NULLIF(t.total, 0), 0.0) AS share_pct
FROM (VALUES {THEME_VALUES}) c(theme, position)
LEFT JOIN (SELECT unnest(string_split(themes, ' | ')) AS theme, COUNT(*) AS n FROM annot WHERE themes <> ''
           GROUP BY 1) a USING (theme)
CROSS JOIN (SELECT COUNT(*) AS total FROM annot) t
"""))(lambda s, d: X.theme_summary(analyzed(s, d), list(LX.themes)))

register("review_kpis", rsql("""
SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE sentiment = 'Négatif') AS negatives,
       COUNT(*) FILTER (WHERE sentiment = 'Sans texte') AS no_text, AVG(rating) AS mean_rating,
       COUNT(*) FILTER (WHERE sentiment = 'Indéterminé') AS to_verify
FROM annot
"""))(lambda s, d: X.review_kpis(analyzed(s, d)))

register("evaluate_labels", rsql("""
SELECT langue AS language, COUNT(*) AS total,
       COUNT(*) FILTER (WHERE sentiment = CASE quality WHEN 1 THEN 'Positif' ELSE 'Négatif' END) AS correct,
       COUNT(*) FILTER (WHERE sentiment = 'Indéterminé') AS abstentions
FROM annot WHERE quality IS NOT NULL GROUP BY langue
"""))(lambda s, d: X.evaluate_labels(
    analyzed(s, d).filter(F.col("quality").isNotNull())
    .withColumn("expected", F.when(F.col("quality") == 1, "Positif").otherwise("Négatif"))
    .withColumnRenamed("langue", "language"), "expected", "language"))


def _filtered_page(s, d):
    rows = analyzed(s, d).withColumnRenamed("langue", "language")
    flt = X.ReviewFilter(language="en")
    return X.page(X.review_filter(rows, flt), 1, 12, "long").select(
        "row_id", F.length("text").alias("chars"))


register("review_filter_page", rsql("""
SELECT row_id, length(text) AS chars FROM annot WHERE langue = 'en'
ORDER BY length(text) DESC, row_id LIMIT 12 OFFSET 12
"""))(_filtered_page)


def _search_filter(s, d):
    rows = analyzed(s, d).withColumnRenamed("langue", "language")
    flt = X.ReviewFilter(search="Ème", sentiment="Indéterminé", rating_min=2.0, duplicates=False)
    return X.review_filter(rows, flt).select("row_id", "rating")


register("review_search_filter", rsql("""
SELECT row_id, rating FROM annot
WHERE contains(nt, 'eme') AND sentiment = 'Indéterminé' AND rating IS NOT NULL AND rating >= 2
"""))(_search_filter)

register("rating_conflicts", rsql("""
SELECT row_id, rating, sentiment FROM annot
WHERE rating BETWEEN 1 AND 5 AND (((rating - 1) / 4.0 <= 0.25 AND sentiment = 'Positif')
                                  OR ((rating - 1) / 4.0 >= 0.75 AND sentiment = 'Négatif'))
"""))(lambda s, d: analyzed(s, d).filter(X.rating_conflict(F.col("rating"), F.col("sentiment"), 5))
      .select("row_id", "rating", "sentiment"))


def _corrections(s, d):
    rows = analyzed(s, d)
    corr = (rows.filter(F.col("quality").isNotNull() & (F.col("sentiment") != "Sans texte"))
            .withColumn("_exp", F.when(F.col("quality") == 1, "Positif").otherwise("Négatif"))
            .filter(F.col("_exp") != F.col("sentiment")).select("row_id", F.col("_exp").alias("sentiment")))
    fixed = X.apply_corrections(rows, corr, "row_id")
    return fixed.groupBy("sentiment", "sentiment_initial", "corrected", "uncertain").agg(
        F.count(F.lit(1)).alias("n"))


register("apply_corrections", rsql("""
SELECT coalesce(c.manual, a.sentiment) AS sentiment, a.sentiment AS sentiment_initial,
       c.manual IS NOT NULL AS corrected,
       CASE WHEN c.manual IS NOT NULL THEN false ELSE a.sentiment = 'Indéterminé' END AS uncertain, COUNT(*) AS n
FROM annot a LEFT JOIN (
  SELECT row_id, CASE quality WHEN 1 THEN 'Positif' ELSE 'Négatif' END AS manual FROM annot
  WHERE quality IS NOT NULL AND sentiment <> 'Sans texte'
    AND sentiment <> CASE quality WHEN 1 THEN 'Positif' ELSE 'Négatif' END) c USING (row_id)
GROUP BY ALL
"""))(_corrections)


def _oversize(limit):
    def run(s, d):
        docs = s.read.parquet(table_path(d, "documents"))
        ok, rejected = X.reject_oversize(docs, "text", limit)
        return ok.agg(F.count(F.lit(1)).alias("accepted")).crossJoin(
            rejected.agg(F.count(F.lit(1)).alias("rejected")))
    return run


register("reject_oversize", f"""
SELECT COUNT(*) FILTER (WHERE length(text) <= 100000 OR text IS NULL) AS accepted,
       COUNT(*) FILTER (WHERE length(text) > 100000) AS rejected FROM documents
""")(_oversize(100_000))
register("reject_oversize_20k", """
SELECT COUNT(*) FILTER (WHERE length(text) <= 20000 OR text IS NULL) AS accepted,
       COUNT(*) FILTER (WHERE length(text) > 20000) AS rejected FROM documents
""")(_oversize(20_000))


def _segment_lines(mode):
    def run(s, d):
        from mercato.sources.reviews import segment_text
        docs = s.read.parquet(table_path(d, "documents")).select("doc_id", "text")
        seg = segment_text(docs, "text", mode, key="doc_id")
        return seg.groupBy("doc_id").agg(F.count(F.lit(1)).alias("parts"),
                                         F.sum(F.length("texte")).cast("bigint").alias("chars"))
    return run


register("segment_text_lines", r"""
SELECT doc_id, COUNT(*) AS parts, CAST(SUM(length(p)) AS BIGINT) AS chars FROM (
  SELECT doc_id, trim(regexp_replace(unnest(regexp_split_to_array(text, '\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85]')),
                                     '^\s+|\s+$', '', 'g')) AS p FROM documents)
WHERE p <> '' GROUP BY doc_id
""")(_segment_lines("lines"))
register("segment_text_paragraphs", r"""
SELECT doc_id, COUNT(*) AS parts, CAST(SUM(length(p)) AS BIGINT) AS chars FROM (
  SELECT doc_id, regexp_replace(unnest(regexp_split_to_array(text, '\n\s*\n')), '^\s+|\s+$', '', 'g') AS p
  FROM documents)
WHERE p <> '' GROUP BY doc_id
""")(_segment_lines("paragraphs"))

register("mask_handles_urls", r"""
SELECT doc_id, md5(regexp_replace(regexp_replace(text, 'https?://\S+', 'http', 'g'), '(^|[^\w])@\w+', '\1@user', 'g'))
       AS masked_hash FROM documents
""")(lambda s, d: s.read.parquet(table_path(d, "documents")).select(
    "doc_id", F.md5(T.mask_handles_urls(F.col("text"))).alias("masked_hash")))

register("review_segments", rsql(r"""
SELECT row_id, CAST(seg AS INTEGER) AS seg, CAST(greatest(1, len(tk[seg * 254 + 1: seg * 254 + 254])) AS INTEGER) AS weight
FROM (SELECT row_id, tk, unnest(range(0, greatest(1, CAST(ceil(len(tk) / 254) AS BIGINT)))) AS seg
      FROM (SELECT row_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS tk FROM annot
            WHERE NOT (length(regexp_replace(text, '\s', '', 'g')) = 0)))
"""))(lambda s, d: segments(analyzed(s, d).filter(~T.is_blank(F.col("text"))).withColumnRenamed("row_id", "_th"),
                            "text").select(F.col("_th").alias("row_id"), "seg", "weight"))


def _model(s, d):
    rows = R.fixture_analyzed(s, d, with_model=True)
    return rows.select("row_id", "sentiment", "confidence", "uncertain", "chunks",
                       F.round(F.col("probabilities")["Positif"], 4).alias("p_pos"))


MODEL_SQL = rsql(r"""
SELECT a.row_id,
       CASE WHEN m.row_id IS NULL THEN a.sentiment
            WHEN m.xn AND m.xp THEN 'Mixte'
            WHEN m.best < 0.6 OR m.margin < 0.15 THEN 'Indéterminé'
            WHEN m.q2 >= m.q1 AND m.q2 >= m.q0 THEN 'Positif' WHEN m.q1 >= m.q0 THEN 'Neutre' ELSE 'Négatif' END
         AS sentiment,
       round(m.best, 4) AS confidence,
       CASE WHEN m.row_id IS NULL THEN a.sentiment = 'Indéterminé'
            ELSE (m.best < 0.6 OR m.margin < 0.15 OR (m.xn AND m.xp)) END AS uncertain,
       m.chunks, round(m.q2, 4) AS p_pos
FROM annot a LEFT JOIN m USING (row_id)
""", r"""
mt AS (SELECT row_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS tk
       FROM annot WHERE NOT (length(regexp_replace(text, '\s', '', 'g')) = 0)),
ms AS (SELECT row_id, tk, unnest(range(0, greatest(1, CAST(ceil(len(tk) / 254) AS BIGINT)))) AS seg FROM mt),
mg AS (SELECT row_id, tk[seg * 254 + 1: seg * 254 + 254] AS sg FROM ms),
ml AS (SELECT row_id, CAST(greatest(1, len(sg)) AS DOUBLE) AS w,
              2.0 * len(list_filter(sg, lambda x: trim(strip_accents(lower(x)), '.,!?;:') IN ({neg}))) AS l0,
              1.0 AS l1,
              2.0 * len(list_filter(sg, lambda x: trim(strip_accents(lower(x)), '.,!?;:') IN ({pos}))) AS l2
       FROM mg),
me AS (SELECT row_id, w, exp(l0 - greatest(l0, l1, l2)) AS e0, exp(l1 - greatest(l0, l1, l2)) AS e1,
              exp(l2 - greatest(l0, l1, l2)) AS e2 FROM ml),
mp AS (SELECT row_id, w, e0 / (e0 + e1 + e2) AS p0, e1 / (e0 + e1 + e2) AS p1, e2 / (e0 + e1 + e2) AS p2 FROM me),
mc AS (SELECT *, greatest(p0, p1, p2) >= 0.6
                 AND greatest(p0, p1, p2) - list_sort([p0, p1, p2], 'DESC')[2] >= 0.15 AS clear FROM mp),
mq AS (SELECT row_id, SUM(p0 * w) / SUM(w) AS q0, SUM(p1 * w) / SUM(w) AS q1, SUM(p2 * w) / SUM(w) AS q2,
              COUNT(*) AS chunks,
              bool_or(clear AND NOT (p2 >= p1 AND p2 >= p0) AND NOT (p1 >= p0)) AS xn,
              bool_or(clear AND p2 >= p1 AND p2 >= p0) AS xp
       FROM mc GROUP BY row_id),
m AS (SELECT *, greatest(q0, q1, q2) AS best, greatest(q0, q1, q2) - list_sort([q0, q1, q2], 'DESC')[2] AS margin
      FROM mq)
""".replace("{neg}", _in(LX.negative)).replace("{pos}", _in(LX.positive)))

register("model_scores", MODEL_SQL)(_model)


register("neutralize_formulas", r"""
SELECT doc_id, md5(regexp_replace(text, '^(\s*[=+@\-])', '''\1')) AS cell_hash,
       regexp_matches(text, '^\s*[=+@\-]') AS neutralized FROM documents
""")(lambda s, d: s.read.parquet(table_path(d, "documents")).select(
    "doc_id", F.md5(neutralize_formulas(F.col("text"))).alias("cell_hash"), F.col("text").rlike(r"(?U)^\s*[=+@\-]").alias("neutralized")))

# Fixed values of the fixture: custom theme rules made of words that occur.
FIXTURE_THEME_RULES = {"Prix": ["cher", "trop cher"], "Insultes": ["idiot", "moron", "pathetic"]}


def _phrase_themes(s, d):
    rows = R.analyze_reviews(R.fixture_reviews(s, d), "texte", None, "note", LX, FIXTURE_THEME_RULES)
    return rows.select("row_id", F.array_join("themes", " | ").alias("themes"))


register("themes_by_phrase", rsql(r"""
SELECT row_id, concat_ws(' | ',
  CASE WHEN regexp_matches(nt, '(^|[^\pL\pN_])(cher|trop cher)([^\pL\pN_]|$)') THEN 'Prix' END,
  CASE WHEN regexp_matches(nt, '(^|[^\pL\pN_])(idiot|moron|pathetic)([^\pL\pN_]|$)') THEN 'Insultes' END)
  AS themes
FROM annot
"""))(_phrase_themes)


def _preview(s, d):
    from mercato.sources.reviews import preview_with_coverage
    imported = R.fixture_reviews(s, d)
    analysed = R.fixture_analyzed(s, d).filter(F.col("langue") == "fr")
    return preview_with_coverage(analysed, imported, 5).select("row_id", "sentiment", "analysed", "imported")


register("preview_with_coverage", rsql("""
SELECT row_id, sentiment, (SELECT COUNT(*) FROM annot WHERE langue = 'fr') AS analysed,
       (SELECT COUNT(*) FROM annot) AS imported
FROM annot WHERE langue = 'fr' ORDER BY row_id LIMIT 5
"""))(_preview)

_CODES = dict(zip(X.SENTIMENTS, X.CLASS_CODES))
register("confusion_matrix", rsql("SELECT CASE quality WHEN 1 THEN 'Positif' ELSE 'Négatif' END AS expected, "
                                  + ", ".join(f"COUNT(*) FILTER (WHERE sentiment = '{s}') AS {c}"
                                              for s, c in _CODES.items())
                                  + " FROM annot WHERE quality IS NOT NULL GROUP BY 1"))(
    lambda s, d: X.confusion_matrix(
        analyzed(s, d).filter(F.col("quality").isNotNull())
        .withColumn("expected", F.when(F.col("quality") == 1, "Positif").otherwise("Négatif"))))


# Every filter of the review list, alone and combined: rows and the sum of their numbers.
_FILTERS = {
    "theme": (X.ReviewFilter(theme=next(iter(LX.themes))), f"list_contains(string_split(themes, ' | '), '{next(iter(LX.themes))}')"),
    "no theme": (X.ReviewFilter(theme=X.NO_THEME), "themes = ''"),
    "duplicates": (X.ReviewFilter(duplicates=True), "duplicate"),
    "uncertain": (X.ReviewFilter(uncertain=True), "uncertain"),
    "corrected": (X.ReviewFilter(corrected=True), "corrected"),
    "conflict": (X.ReviewFilter(conflict=True), "((rating = 1 AND sentiment = 'Positif') OR (rating = 5 AND sentiment = 'Négatif'))"),
    "exact rating": (X.ReviewFilter(rating=5.0), "rating = 5"),
    "rating range": (X.ReviewFilter(rating_min=1.0, rating_max=4.0), "rating BETWEEN 1 AND 4"),
    "language and corrected": (X.ReviewFilter(language="en", corrected=True), "langue = 'en' AND corrected"),
    "search and duplicates": (X.ReviewFilter(search="Ème", duplicates=True), "contains(nt, 'eme') AND duplicate"),
}
_CORRECTED_SQL = """
fixed AS (SELECT a.* EXCLUDE (sentiment), coalesce(c.manual, a.sentiment) AS sentiment, c.manual IS NOT NULL AS corrected,
                 CASE WHEN c.manual IS NOT NULL THEN false ELSE a.sentiment = 'Indéterminé' END AS uncertain
          FROM annot a LEFT JOIN (SELECT row_id, CASE quality WHEN 1 THEN 'Positif' ELSE 'Négatif' END AS manual FROM annot
                                  WHERE quality IS NOT NULL AND sentiment <> 'Sans texte' AND row_id % 3 = 0) c USING (row_id))"""


def _corrected(s, d, duplicates):
    rows = analyzed(s, d, duplicates).withColumnRenamed("langue", "language")
    manual = rows.filter(F.col("quality").isNotNull() & (F.col("sentiment") != "Sans texte") & (F.col("row_id") % 3 == 0))
    return X.apply_corrections(rows, manual.select("row_id", F.when(F.col("quality") == 1, "Positif").otherwise("Négatif").alias("sentiment")))


def _all_filters(s, d):
    """One pass: a row counts in each filter that it passes."""
    met = F.array(*[F.when(F.coalesce(f.predicate(), F.lit(False)), F.lit(name)) for name, (f, _) in _FILTERS.items()])
    hits = _corrected(s, d, True).select("row_id", F.explode(F.array_compact(met)).alias("filter"))
    return hits.groupBy("filter").agg(F.count(F.lit(1)).alias("n"), F.sum("row_id").alias("row_ids"))


register("review_filters", rsql("\nUNION ALL\n".join(
    f"SELECT '{name}' AS filter, COUNT(*) AS n, CAST(SUM(row_id) AS BIGINT) AS row_ids FROM fixed WHERE {cond} HAVING COUNT(*) > 0"
    for name, (_, cond) in _FILTERS.items()), _CORRECTED_SQL))(_all_filters)


def _sort_modes(s, d):
    rows = _corrected(s, d, False)
    out = None
    for mode in ("original", "long", "low", "high"):
        part = X.page(rows, 2, 20, mode).select(F.lit(mode).alias("mode"), "row_id")
        out = part if out is None else out.unionByName(part)
    return out


register("review_sort_modes", rsql("\nUNION ALL\n".join(
    f"(SELECT '{mode}' AS mode, row_id FROM fixed ORDER BY {order} LIMIT 20 OFFSET 40)" for mode, order in (
        ("original", "row_id"), ("long", "length(text) DESC, row_id"), ("low", "rating NULLS LAST, row_id"),
        ("high", "rating DESC NULLS LAST, row_id"))), _CORRECTED_SQL))(_sort_modes)
