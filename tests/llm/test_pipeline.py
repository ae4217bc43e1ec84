"""The pipeline's stages against brute force, on the smallest driver tables."""

import corpus_pipeline as C
import public_tokenizers
from pyspark.sql import functions as F
from test_op03_jaccard import brute as classes_of
from test_op08_repetition import brute as figures_of
from test_op09_decontaminate import grams, words
from tokenizers import Tokenizer

from mercato.llm import pii_crf as P
from mercato.llm import repetition as R


def kept_by_rules(text):
    n, _, _, _, repeat, covered, longest = figures_of(text, R.MIN_REPEAT)
    return n >= 50 and 100 * repeat <= 50 * n and covered <= R.MAX_COVERED * n and longest <= R.MAX_LONGEST


def test_stages(spark, docs_of, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").filter("n_chars < 2500")
    items = [words(r["text"]) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    names = [n for n, _ in C.STAGES]
    assert names == ["quality_rules", "near_duplicates", "decontamination", "personal_data", "packing"]
    out, now = {}, docs
    for name, stage in C.STAGES:
        now = spark.createDataFrame(stage(spark, now, sf_small).toArrow())
        out[name] = now
        if name != "packing":
            assert now.columns == docs.columns
    left = {i: t for i, t in rows.items() if kept_by_rules(t)}
    assert {r["doc_id"] for r in out["quality_rules"].collect()} == set(left) and 0 < len(left) < len(rows)
    found, _ = classes_of(list(left.items()))
    left = {i: left[i] for i in {c for _, n, c in found}}
    assert {r["doc_id"] for r in out["near_duplicates"].collect()} == set(left)
    wanted = [grams(w, 5) for w in items]
    left = {i: t for i, t in left.items() if not any(5 * len(g & grams(words(t), 5)) >= 4 * len(g) for g in wanted)}
    assert {r["doc_id"] for r in out["decontamination"].collect()} == set(left)
    model = P.train()
    want = {}
    for i, t in left.items():
        base = P.base_spans(t)
        want[i] = P.mask(t, base + P.field_spans([t], [base], model)[0])
    masked = {r["doc_id"]: r for r in out["personal_data"].collect()}
    assert {i: r["text"] for i, r in masked.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in masked.values())
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {}
    for r in out["packing"].collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == {i: len(tok.encode(t, add_special_tokens=False).ids) + 1 for i, t in want.items()}


def test_run(spark, sf_small):
    pieces = C.run(spark, sf_small)
    assert {"doc_id", "piece", "start", "length", "sequence_id", "offset"} <= set(pieces.columns) and pieces.count() > 0


def test_stages_carry_extra_and_clashing_columns(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").filter("n_chars between 400 and 900").limit(40)
    clash = ("id n n_words n_symbols n_email base_spans spans base_failed kept _id _text _masked _node _content _shared _keep "
             "_winner _rn node class a.b").split()
    for c in clash:
        docs = docs.withColumn(c, F.concat(F.lit(c + " of "), F.col("doc_id").cast("string")))
    docs = spark.createDataFrame(docs.withColumn("_row", F.struct(F.col("doc_id").alias("x y"))).toArrow())
    now = docs
    for name, stage in C.STAGES:
        now = spark.createDataFrame(stage(spark, now, sf_small).toArrow())
        if name != "packing":
            assert now.columns == docs.columns
            rows = now.collect()
            assert rows and all(r[c] == f"{c} of {r['doc_id']}" for r in rows for c in clash)
            assert all(r["_row"]["x y"] == r["doc_id"] and r["n_chars"] == len(r["text"]) for r in rows)
    assert now.count()
