"""Structured Streaming versions of the review operators (ST1, ST2).

ST1 applies the stateless rules of the triage (compose, normalize, tokenize,
sentiment, themes, evidence, rating) to review files as they arrive.
ST2 keeps a count per duplicate key in the state store across micro-batches
(complete mode) and publishes a snapshot of the keys seen more than once, so
duplicates are judged over all history, as the batch operator judges them
over all rows.  The reference has no watermark for this, so the state grows
with the number of distinct texts; use the RocksDB state store at scale.

Sinks and checkpoints live under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.functions import text as T
from mercato.operators import sentiment as X
from mercato.session import checkpoint_dir


def _work_dir(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "streams", f"{name}-{uuid.uuid4().hex[:8]}")


def stage_as_files(df: DataFrame, path: str, files: int = 8, key: str = "row_id") -> str:
    """Write a table as several files (arriving batches for a file stream)."""
    df.repartitionByRange(files, key).write.mode("overwrite").parquet(path)
    return path


def rules_columns(df: DataFrame, text_col: str, rating_col: str | None, lexicon: X.Lexicon) -> DataFrame:
    """The stateless part of X18."""
    out = T.with_normalized(df.withColumn("text", T.compose_text(None, text_col)), "text", "normalized")
    return (X.with_rules(out, T.is_blank(F.col("text")), lexicon)
            .withColumn("rating", T.parse_rating(F.col(rating_col)) if rating_col else F.lit(None).cast("double"))
            .withColumn("uncertain", F.col("sentiment") == X.UNDETERMINED))


def stream_analyze_reviews(spark: SparkSession, source_dir: str, schema, text_col: str, rating_col: str | None,
                           lexicon: X.Lexicon = X.Lexicon(), files_per_trigger: int = 2,
                           out_dir: str | None = None) -> str:
    """ST1: incremental rules scoring of arriving review files; parquet sink,
    exactly-once through the checkpoint.  Runs to the end of the available
    files (``availableNow``) and returns the output folder."""
    out_dir = out_dir or _work_dir(spark, "reviews-out")
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
              .parquet(source_dir))
    annotated = rules_columns(stream, text_col, rating_col, lexicon).drop("tokens")
    q = (annotated.writeStream.format("parquet").option("path", out_dir)
         .option("checkpointLocation", out_dir + "-ckpt").outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return out_dir


def _keyed(df: DataFrame, text_col: str) -> DataFrame:
    """Adds the hash of the duplicate key (null for an empty key)."""
    key = T.duplicate_key(F.col("_nk"))
    hashed = T.computed_once(F.when(key != "", F.sha2(key, 256)))
    return T.with_normalized(df, T.compose_text(None, text_col), "_nk").withColumn("dup_hash", hashed).drop("_nk")


def stream_duplicate_counts(spark: SparkSession, source_dir: str, schema, text_col: str,
                            files_per_trigger: int = 2, out_dir: str | None = None) -> str:
    """ST2: running count per duplicate key (hash of the normalized,
    space-collapsed text) across all micro-batches; after each batch the keys
    with a count above one are written as a snapshot (idempotent overwrite)."""
    out_dir = out_dir or _work_dir(spark, "dup-keys")
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
              .parquet(source_dir))
    counts = (_keyed(stream, text_col).select("dup_hash").filter(F.col("dup_hash").isNotNull()).groupBy("dup_hash")
              .agg(F.count(F.lit(1)).alias("n")))

    def publish(batch: DataFrame, epoch: int) -> None:
        batch.filter(F.col("n") > 1).write.mode("overwrite").parquet(out_dir)

    q = (counts.writeStream.outputMode("complete").foreachBatch(publish)
         .option("checkpointLocation", out_dir + "-ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    return out_dir


def flag_with_snapshot(df: DataFrame, snapshot: DataFrame, text_col: str) -> DataFrame:
    """Join at read: rows whose key is in the duplicate snapshot are flagged.
    The snapshot (keys seen more than once) is broadcast when a bounded count
    proves it small, as in the batch operator; otherwise a shuffle join."""
    from mercato.operators.ranks import is_small
    keyed = _keyed(df, text_col)
    snap = snapshot.select("dup_hash", F.lit(True).alias("_d"))
    if is_small(snap, X.BROADCAST_REPEATED_KEYS):
        snap = F.broadcast(snap)
    return (keyed.join(snap, "dup_hash", "left")
            .withColumn("duplicate", F.coalesce("_d", F.lit(False))).drop("_d", "dup_hash"))
