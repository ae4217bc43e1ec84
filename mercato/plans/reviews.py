"""Review triage pipeline (X18) and the fixture's review table.

``analyze_reviews`` is one lazy plan: compose, normalize, tokenize, rules,
themes, rating, duplicates over all rows and, with a scorer, the model path.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.functions import text as T
from mercato.operators import sentiment as X
from mercato.operators.scoring import MODEL_METHOD, LexiconScorer, score_texts
from mercato.session import checkpoint_dir, table_path

# Fixed values of the fixture: polarity words that occur in the driver's
# documents, added to the default lexicons.
FIXTURE_POSITIVE = ["best"]
FIXTURE_NEGATIVE = ["worthless", "pathetic", "stupid", "idiot", "moron"]
FIXTURE_LEXICON = X.Lexicon(positive=tuple(X.POSITIVE + FIXTURE_POSITIVE),
                            negative=tuple(X.NEGATIVE + FIXTURE_NEGATIVE))


def fixture_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews from the driver tables: documents are the comments; a rating
    (as raw text) comes from labels.quality where present (1 -> '5', 0 -> '1')."""
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    labels = spark.read.parquet(table_path(sf_dir, "labels")).select("doc_id", "quality")
    return (docs.join(labels, "doc_id", "left")
            .select(F.col("doc_id").alias("row_id"), F.col("text").alias("texte"),
                    F.when(F.col("quality") == 1, "5").when(F.col("quality") == 0, "1").alias("note"),
                    F.col("lang").alias("langue"), "source", "quality"))


def analyze_reviews(df: DataFrame, text_col: str, title_col: str | None = None, rating_col: str | None = None,
                    lexicon: X.Lexicon = X.Lexicon(), theme_rules: dict | None = None,
                    scorer_factory: Callable | None = None, duplicates: bool = True, materialize: bool = True,
                    most_chars: int | None = None) -> DataFrame:
    """One annotated row per input row (input columns kept).  A text over
    ``most_chars`` characters fails the job (X24); None sets no limit.

    Duplicates are judged over all rows, which needs a second look at the
    data; without ``duplicates`` the plan is lazy, writes nothing and has no such
    column.  With ``materialize`` (default) the annotations, with the hash
    of their duplicate key and the input columns, are written once as a Parquet
    table in the shared ``spark.checkpoint.dir``, without the texts derived from
    them; the repeated hashes are then counted from one narrow column and joined
    back."""
    composed = df.withColumn("text", T.compose_text(title_col, text_col))
    if most_chars is not None:
        composed, _ = X.reject_oversize(composed, "text", most_chars, raise_error=True)
    out = T.with_normalized(composed, "text", "normalized").withColumn("_blank", T.is_blank(F.col("text")))
    themes = X.themes_by_phrase(F.col("normalized"), theme_rules) if theme_rules else None
    out = (X.with_rules(out, F.col("_blank"), lexicon, themes)
           .withColumn("rating", T.parse_rating(F.col(rating_col)) if rating_col else F.lit(None).cast("double"))
           .withColumn("method", F.lit(X.RULES_METHOD))
           .withColumn("confidence", F.lit(None).cast("double"))
           .withColumn("uncertain", F.col("sentiment") == X.UNDETERMINED)
           .withColumn("corrected", F.lit(False)))
    if scorer_factory is not None:
        keys = [c for c in out.columns if c != "confidence"]
        scored = score_texts(out.filter(~F.col("_blank")).drop("confidence"), "text", scorer_factory)
        extra = scored.select(*keys, "model_sentiment", F.col("confidence").alias("_conf"),
                              "model_uncertain", "probabilities", "chunks")
        blank = out.filter(F.col("_blank")).select(
            *keys, F.lit(None).cast("string").alias("model_sentiment"), F.lit(None).cast("double").alias("_conf"),
            F.lit(None).cast("boolean").alias("model_uncertain"),
            F.lit(None).cast("map<string,double>").alias("probabilities"), F.lit(None).cast("long").alias("chunks"))
        out = (extra.unionByName(blank)
               .withColumn("sentiment", F.coalesce("model_sentiment", "sentiment"))
               .withColumn("confidence", F.col("_conf"))
               .withColumn("uncertain", F.coalesce("model_uncertain", "uncertain"))
               .withColumn("evidence", F.when(F.col("model_sentiment").isNotNull(),
                                              F.array().cast("array<string>")).otherwise(F.col("evidence")))
               .withColumn("method", F.when(F.col("model_sentiment").isNotNull(), F.lit(MODEL_METHOD))
                           .otherwise(F.col("method")))
               .drop("model_sentiment", "_conf", "model_uncertain"))
    out = (out.withColumn("sentiment_initial", F.col("sentiment"))
           .withColumn("_dup_hash", T.computed_once(X.duplicate_hash(F.col("normalized")))).drop("_blank"))
    if not duplicates:
        return out.drop("_dup_hash")
    if materialize:
        spark = out.sparkSession
        path = os.path.join(checkpoint_dir(spark), "reviews", f"annotated-{uuid.uuid4().hex[:12]}")
        # The derived texts are not written: what reads them later derives them again, for the rows it still has.
        given = "text" in (text_col, title_col)
        stored = out.drop("normalized", "tokens", *([] if given else ["text"]))
        stored.write.mode("overwrite").parquet(path)
        back = spark.read.schema(stored.schema).parquet(path)
        if not given:
            back = back.withColumn("text", T.compose_text(title_col, text_col))
        back = T.with_normalized(back, "text", "normalized").withColumn("tokens", T.tokenize(F.col("normalized")))
        out = back.select(*out.columns)
    return X.flag_duplicates(out, "normalized", "duplicate", hash_col="_dup_hash")


def fixture_analyzed(spark: SparkSession, sf_dir: str, with_model: bool = False, duplicates: bool = False) -> DataFrame:
    lx = FIXTURE_LEXICON
    factory = (lambda: LexiconScorer(lx.positive, lx.negative)) if with_model else None
    return analyze_reviews(fixture_reviews(spark, sf_dir), "texte", None, "note", lx, None, factory, duplicates)
