"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.decontaminate import contaminated
from mercato.llm.filter_audit import filter_audit
from mercato.llm.jaccard_join import jaccard_classes
from mercato.llm.license_scan import license_labels
from mercato.llm.line_runs import drop_frequent_lines
from mercato.llm.merkle import ascii_lower, audit
from mercato.llm.packing import pack
from mercato.llm.pii_crf import pii_spans
from mercato.llm.repetition import repetition_figures, verdicts
from mercato.llm.resharding import reshard
from mercato.llm.site_templates import article_texts
from mercato.llm.toxicity import toxicity_scores, train
from mercato.llm.warc_store import archive_and_read


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SHARDS = 40


def op1_flow_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The old layout has one shard a source (by a hash), so it is as uneven as the
    sources are; the new one has equal capacities."""
    old = F.pmod(F.crc32(F.encode(F.coalesce("source", F.lit("")), "UTF-8")), F.lit(SHARDS)).cast("int")
    rows, _ = reshard(table(spark, sf_dir, "documents"), old, SHARDS, SHARDS)
    text = F.coalesce("text", F.lit(""))
    return rows.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def op2_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_labels(table(spark, sf_dir, "documents"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"))


def op8_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    figures = repetition_figures(table(spark, sf_dir, "documents"))
    return verdicts(figures).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                    "base_failed", "kept", "covered_words", "longest_repeat")


def op4_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return article_texts(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op5_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity_scores(docs, train(docs, table(spark, sf_dir, "labels")))


def op6_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = pii_spans(table(spark, sf_dir, "documents"))
    return spans.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                        F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op7_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_minhash_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_warc_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = archive_and_read(table(spark, sf_dir, "pages"))
    return back.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_merkle_climb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows, told by the CRC of their ids, come with their texts' A-Z lower-cased."""
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 0
    text = F.when(tampered, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    return audit(table(spark, sf_dir, "documents"), {"text": text}).withColumnRenamed("id", "doc_id")


def op13_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_frequent_lines(table(spark, sf_dir, "documents"))
    return kept.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_flow_resharding, op2_license_diagonals, op3_ngram_jaccard_join, op4_site_templates, op5_counterfactual_toxicity, op6_pii_crf, op7_pattern_packing, op8_suffix_repetition, op9_minhash_containment,
        op10_warc_store, op11_filter_audit, op12_merkle_climb, op13_line_runs)}


# Words of the oracles: ASCII letters folded, then the pattern of each contract.
_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {}

ORACLES["op3_ngram_jaccard_join"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_FOLDED}, '[^\\x20\\x09-\\x0D]+') AS a FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(
        CASE WHEN len(a) = 0 THEN [] WHEN len(a) < 5 THEN [array_to_string(a, ' ')]
             ELSE list_transform(range(1, len(a) - 3), lambda i: array_to_string(a[i:i + 4], ' ')) END)) AS g FROM w),
n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
link AS (
  SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, COUNT(*) AS i
                        FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b
  WHERE 100 * p.i >= 80 * (na.n + nb.n - p.i)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT a, MIN(b) AS component_id FROM reach GROUP BY a) c ON c.a = d.doc_id
"""

ORACLES["op9_minhash_containment"] = """
WITH t AS (SELECT 'd' AS k, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
w AS (SELECT k, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS a FROM t),
s AS (SELECT k, id, unnest(list_distinct(CASE WHEN len(a) < 5 THEN [] ELSE
        list_transform(range(1, len(a) - 3), lambda i: array_to_string(a[i:i + 4], ' ')) END)) AS g FROM w),
n AS (SELECT id, COUNT(*) AS n FROM s WHERE k = 'i' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, CAST(n.n AS BIGINT) AS n_shingles, COUNT(*) AS n_shared,
       COUNT(*) / CAST(n.n AS DOUBLE) AS containment
FROM s i JOIN s d ON d.g = i.g AND d.k = 'd' AND i.k = 'i' JOIN n ON n.id = i.id
GROUP BY d.id, i.id, n.n HAVING 5 * COUNT(*) >= 4 * n.n
"""

ORACLES["op10_warc_store"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
f AS (SELECT page_id, strlen(h) AS payload_bytes, MAX(page_id) OVER (PARTITION BY h) AS best,
             array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               CAST((CAST('0x' || substr(x, 5 * (i // 4) + 1, 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS BIGINT) + 1, 1)), '')
             AS payload_digest FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = best THEN NULL ELSE best END AS refers_to
FROM f
"""

ORACLES["op11_filter_audit"] = """
WITH l AS (SELECT doc_id, MAX(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, MAX(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
           FROM labels GROUP BY doc_id),
w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
             regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS a,
             MIN(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least FROM documents),
f AS (SELECT w.part, coalesce(l.good, 0) AS good, coalesce(l.bad, 0) AS bad, [
        len(a) < 200, 100 * len(list_distinct(a)) < 50 * len(a),
        100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t),
        regexp_matches(t, '[#$%&*|]'), coalesce(w.doc_id > w.least, false)] AS fails
      FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
m AS (SELECT part, fails, COUNT(*) AS n, SUM(good) AS good, SUM(bad) AS bad FROM f GROUP BY part, fails),
x AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
o AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT o.o, x.i AS step, o.o[x.i] AS asked, o.o[1:x.i - 1] AS before FROM o, x),
r AS (SELECT m.part, s.o, s.step, s.asked, m.n, m.good, m.bad, m.fails[s.asked] AS failed,
             len(list_filter(s.before, lambda k: m.fails[k])) > 0 AS gone, len(list_filter(m.fails, lambda y: y)) AS n_failed
      FROM m, s),
g AS (SELECT part, o, step, asked, SUM(CASE WHEN NOT gone AND NOT failed THEN n ELSE 0 END) AS kept,
             SUM(CASE WHEN NOT gone AND failed THEN n ELSE 0 END) AS removed, SUM(CASE WHEN gone AND failed THEN n ELSE 0 END) AS redundant,
             SUM(CASE WHEN failed AND n_failed = 1 THEN n ELSE 0 END) AS unique_fails,
             SUM(CASE WHEN NOT gone AND failed THEN good ELSE 0 END) AS good_lost,
             SUM(CASE WHEN NOT gone AND failed THEN bad ELSE 0 END) AS toxic_lost FROM r GROUP BY part, o, step, asked)
SELECT part, array_to_string(list_transform(o, lambda i: substr('ABCDE', i, 1)), '') AS filter_order, step,
       CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(SUM(removed) OVER (PARTITION BY part, asked) AS BIGINT) AS shapley
FROM g
"""

# CRC-32 bit by bit: a byte joins with xor, then eight shifts (-1 marks a shift).
ORACLES["op12_merkle_climb"] = """
WITH RECURSIVE b AS (
  SELECT doc_id, lang, source, n_chars, text, flatten(list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i:
           [CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])) AS e FROM documents),
c AS (SELECT *, 4294967295 - list_reduce(e, lambda r, y: CASE WHEN y >= 0 THEN xor(r, y) WHEN r % 2 = 1 THEN xor(r // 2, 3988292384)
                                                              ELSE r // 2 END, CAST(4294967295 AS BIGINT)) AS crc FROM b),
f AS (SELECT doc_id, lang, crc, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
             || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head, text
      FROM c),
v AS (SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
             CASE WHEN crc % 3 = 0 THEN sha256(head || coalesce(strlen(text) || ':'
                  || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS changed FROM f),
p AS (SELECT doc_id, lang, leaf, coalesce(changed, leaf) AS present,
             ROW_NUMBER() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM v),
t AS (SELECT lang, 0 AS lev, list(leaf ORDER BY pos) AS l FROM p GROUP BY lang
      UNION ALL
      SELECT lang, lev + 1, list_transform(range(0, (len(l) + 7) // 8), lambda i: sha256(array_to_string(l[8 * i + 1:8 * i + 8], '')))
      FROM t WHERE len(l) > 1),
h AS (SELECT lang, MAX(lev) AS height, ROW_NUMBER() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM t GROUP BY lang),
r AS (SELECT t.lang, h.tree, l[1] AS subroot FROM t JOIN h ON t.lang IS NOT DISTINCT FROM h.lang AND t.lev = h.height),
u AS (SELECT 0 AS lev, list(subroot ORDER BY tree) AS l FROM r
      UNION ALL
      SELECT lev + 1, list_transform(range(0, (len(l) + 7) // 8), lambda i: sha256(array_to_string(l[8 * i + 1:8 * i + 8], '')))
      FROM u WHERE len(l) > 1),
a AS (SELECT p.doc_id, p.lang, p.pos AS row_at, h.height, h.tree, 0 AS lev, p.pos, p.present AS fold, '' AS path
      FROM p JOIN h ON p.lang IS NOT DISTINCT FROM h.lang
      UNION ALL
      SELECT a.doc_id, a.lang, a.row_at, a.height, a.tree, a.lev + 1, a.pos // 8,
             sha256(array_to_string(t.l[8 * (a.pos // 8) + 1:a.pos], '') || a.fold || array_to_string(t.l[a.pos + 2:8 * (a.pos // 8) + 8], '')),
             a.path || array_to_string(t.l[8 * (a.pos // 8) + 1:a.pos], '') || array_to_string(t.l[a.pos + 2:8 * (a.pos // 8) + 8], '')
      FROM a JOIN t ON t.lang IS NOT DISTINCT FROM a.lang AND t.lev = a.lev WHERE a.lev < a.height),
z AS (SELECT doc_id, lang, row_at, 0 AS lev, tree AS pos, fold, path FROM a WHERE lev = height
      UNION ALL
      SELECT z.doc_id, z.lang, z.row_at, z.lev + 1, z.pos // 8,
             sha256(array_to_string(u.l[8 * (z.pos // 8) + 1:z.pos], '') || z.fold || array_to_string(u.l[z.pos + 2:8 * (z.pos // 8) + 8], '')),
             z.path || array_to_string(u.l[8 * (z.pos // 8) + 1:z.pos], '') || array_to_string(u.l[z.pos + 2:8 * (z.pos // 8) + 8], '')
      FROM z JOIN u ON u.lev = z.lev WHERE len(u.l) > 1),
e AS (SELECT MAX(lev) AS top FROM u),
d AS (SELECT z.* FROM z JOIN e ON z.lev = e.top),
q AS (SELECT u.l[1] AS root FROM u JOIN e ON u.lev = e.top)
SELECT p.doc_id, p.leaf, r.subroot, q.root, sha256(d.path) AS proof_sha256, d.fold AS folded_root, d.fold = q.root AS verified
FROM p JOIN d ON d.lang IS NOT DISTINCT FROM p.lang AND d.row_at = p.pos JOIN r ON r.lang IS NOT DISTINCT FROM p.lang CROSS JOIN q
"""

ORACLES["op13_line_runs"] = """
WITH d AS (SELECT doc_id, ROW_NUMBER() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS a FROM documents),
l AS (SELECT r, unnest(a) AS line, unnest(range(0, len(a))) AS i FROM d),
k AS (SELECT r, i, line, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
                                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING COUNT(DISTINCT r) >= 10),
g AS (SELECT r, COUNT(*) AS n, list(line ORDER BY i) FILTER (WHERE key NOT IN (SELECT key FROM f)) AS kept FROM k GROUP BY r)
SELECT doc_id, CAST(len(a) AS BIGINT) AS n_lines, CAST(len(a) - coalesce(len(kept), 0) AS BIGINT) AS n_dropped,
       sha256(coalesce(array_to_string(kept, chr(10)), '')) AS kept_sha256
FROM d JOIN g ON g.r = d.r
"""


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
