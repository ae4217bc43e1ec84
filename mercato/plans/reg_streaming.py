"""Registered streaming queries: the stream result must equal the batch one.

The driver's documents (with a rating from labels) are staged as several
files in the shared checkpoint folder and consumed two files per
micro-batch with ``availableNow``."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from mercato.plans import reviews as R
from mercato.plans.reg_reviews import rsql
from mercato.plans.registry import register
from mercato.session import checkpoint_dir
from mercato.streaming import reviews as ST


def _staged(s, d):
    src = R.fixture_reviews(s, d).select("row_id", "texte", "note")
    path = os.path.join(checkpoint_dir(s), "streams", f"arrivals-{uuid.uuid4().hex[:8]}")
    ST.stage_as_files(src, path, files=8)
    return path, src.schema


def _stream_rules(s, d):
    path, schema = _staged(s, d)
    out = ST.stream_analyze_reviews(s, path, schema, "texte", "note", R.FIXTURE_LEXICON, files_per_trigger=2)
    return s.read.parquet(out).select(
        "row_id", "sentiment", F.array_join("themes", " | ").alias("themes"),
        F.array_join("evidence", " | ").alias("evidence"), "rating", "uncertain")


register("stream_review_sentiments", rsql("""
SELECT row_id, sentiment, themes, evidence, rating, sentiment = 'Indéterminé' AS uncertain FROM annot
"""))(_stream_rules)


def _stream_dups(s, d):
    path, schema = _staged(s, d)
    snap_dir = ST.stream_duplicate_counts(s, path, schema, "texte", files_per_trigger=2)
    snapshot = s.read.parquet(snap_dir)
    rows = R.fixture_reviews(s, d).select("row_id", "texte")
    return ST.flag_with_snapshot(rows, snapshot, "texte").select("row_id", "duplicate")


register("stream_duplicate_flags", rsql("SELECT row_id, duplicate FROM annot"))(_stream_dups)
