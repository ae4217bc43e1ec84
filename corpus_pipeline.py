"""A corpus from raw documents to packed training sequences.

Each stage gets (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and reread as the next stage's docs.  All but the last return the
columns of their docs, whatever others stand beside those of ``documents``.

Defined results.  Null and empty texts fail the quality rules.  A null id comes
last where one document of a group stays; rows of one id are documents of their
own in every stage but the deduplication, where equal rows count as one.  Ties
and repeated rows are decided by id, then text.  Very long texts are read whole.
An empty table passes every stage and gives no pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.decontaminate import without_contaminated
from mercato.llm.jaccard_join import one_of_each_class
from mercato.llm.packing import pack
from mercato.llm.pii_crf import pii_spans
from mercato.llm.repetition import repetition_figures, verdicts
from mercato.llm.shared import written


def packed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, _row: all other columns), so no column's name meets an operator's own."""
    quoted = ["`" + c.replace("`", "``") + "`" for c in docs.columns if c != "text"]
    return docs.select("doc_id", "text", F.struct(*quoted).alias("_row"))


def unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The rows of ``packed`` with the columns of ``docs``."""
    return rows.select(*[F.col("text") if c == "text" else F.col("_row").getField(c).alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the repetition rules reject."""
    figures = repetition_figures(packed(docs), passed=("text", "_row"))
    return unpacked(verdicts(figures).filter("kept"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of the n-gram Jaccard join stays."""
    return unpacked(one_of_each_class(packed(docs)), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return unpacked(without_contaminated(packed(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet")), docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind."""
    masked = pii_spans(packed(docs), passed=("_row",), masked=True).withColumnRenamed("_masked", "text")
    rows = unpacked(masked, docs)
    if "n_chars" not in docs.columns:
        return rows
    return rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in training sequences."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal_data", personal_data), ("packing", packing)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
