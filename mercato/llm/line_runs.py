"""Removal of lines that many documents hold, over levelled sorted runs of
line hashes (operator 13).

A line's key is the line without ASCII white space at both ends, A-Z folded; it
is known by its 128-bit BLAKE2b digest.  ``LineRuns`` is an index that grows by
batches: a run is a Parquet table of (digest, documents), bucketed and sorted by
digest.  A new batch is counted per key, merge-anti-joined with the keys that
the runs already know as frequent (their count cannot change a verdict any
more), and the rest becomes a run of level 0.  When a level has ``fanout``
runs they are merged into one of the next level, counts added up; so a key is
rewritten once a level, and every join and merge finds the runs bucketed.  The
runs of a level are the files of one bucketed table, so that one scan merges
them (a union of bucketed tables takes part in Spark's partitioning too, but
Spark 4.1 adds up wrong counts over one of columnar scans).  What a batch
holds does not change the result.

``drop_frequent_lines`` reads the texts once for their lines, adds them in
batches (an input split belongs to one batch), and deletes the lines of
frequent keys from every document.  Counts are summed map-side, so a line that
a third of all documents hold is one row a task; its places go back to the
documents by a join on the digest that AQE splits, then by document.

Defined results.  Null or empty text: one line, which is empty.  Lines whose key
is shorter than ``least_chars`` code points, empty ones always, stay.  Every
row is a document of its own, equal rows and equal or null ids too; a line
that a document repeats counts once for it and is dropped at each place.  If
all lines go the text is empty.  An empty table gives no rows.  Very long
texts are cut into lines whole; a task holds one text's lines and one block of
rows.  Other columns are kept or ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm.shared import scratch_path, written

LEAST_DOCS = 10
LEAST_CHARS = 1
BATCHES = 8
FANOUT = 4
KEYS_PER_BUCKET = 16_000_000
KEY = ("h1", "h2")
_SPACE = b" \t\n\x0b\x0c\r"
_BLOCK_LINES = 200_000


@dataclass
class Level:
    """The runs of one level: appended to one table, each sorted by digest in every bucket."""
    table: str
    runs: int = 0


class LineRuns:
    """Index of line digests with the number of documents that hold them, in levelled sorted runs.

    A count that reaches ``least_docs`` is final: its key is frequent, later batches do not add to it."""

    def __init__(self, spark: SparkSession, least_docs: int = LEAST_DOCS, fanout: int = FANOUT, buckets: int = 8):
        if least_docs < 1 or fanout < 2 or buckets < 1:
            raise ValueError("least_docs and buckets must be 1 or more, fanout 2 or more")
        self.spark, self.least_docs, self.fanout, self.buckets = spark, least_docs, fanout, buckets
        self.levels: list[Level] = []

    def _write(self, counts: DataFrame, level: int) -> None:
        """Adds a run to a level."""
        while len(self.levels) <= level:
            self.levels.append(Level(f"line_runs_{len(self.levels)}_{uuid.uuid4().hex}"))
        to = self.levels[level]
        # Rows come dealt by digest into as many partitions as there are buckets: one file a bucket.
        writer = counts.write.mode("append").bucketBy(self.buckets, *KEY).sortBy(*KEY)
        if not to.runs:
            writer = writer.option("path", scratch_path(self.spark, to.table))
        writer.saveAsTable(to.table)
        to.runs += 1

    def merged(self, level: int) -> DataFrame:
        """The runs of a level with their counts added up: bucket by bucket, without a shuffle."""
        return self.spark.table(self.levels[level].table).groupBy(*KEY).agg(F.sum("docs").alias("docs"))

    def add(self, lines: DataFrame) -> None:
        """Adds the batch ``lines`` (h1, h2, one row per document and key) and compacts where a level is full."""
        batch = lines.groupBy(*KEY).agg(F.count(F.lit(1)).alias("docs")).repartition(self.buckets, *KEY)
        for level in self.levels:
            if level.runs:
                known = self.spark.table(level.table).filter(F.col("docs") >= self.least_docs)
                batch = batch.join(known.hint("merge"), list(KEY), "left_anti")
        self._write(batch, 0)
        level = 0
        while self.levels[level].runs >= self.fanout:
            self._compact(level)
            level += 1

    def _compact(self, level: int) -> None:
        """Merges the runs of a level into one run of the next."""
        self._write(self.merged(level), level + 1)
        self._forget(self.levels[level])
        self.levels[level] = Level(f"line_runs_{level}_{uuid.uuid4().hex}")

    def _forget(self, level: Level) -> None:
        """Takes the table's name from the catalog; the files stay in the shared folder."""
        self.spark.sql(f"DROP TABLE IF EXISTS {level.table}")

    def frequent(self) -> DataFrame:
        """(h1, h2, docs) of the keys that ``least_docs`` documents or more hold; docs is the count when the key got there, at least.
        Compacts all levels into the last one."""
        if not self.levels:
            return self.spark.createDataFrame([], "h1 long, h2 long, docs long")
        for level in range(len(self.levels) - 1):
            if self.levels[level].runs:
                self._compact(level)
        return written(self.merged(len(self.levels) - 1).filter(F.col("docs") >= self.least_docs), "frequent-lines")

    def close(self) -> None:
        for level in self.levels:
            self._forget(level)
        self.levels = []


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= 4 * least or (len(key) >= least and len(key.decode("utf-8", "replace")) >= least)


def _lines(least: int):
    """(id, row, text) to one row per line that has a key: h1, h2, id, row, its place and whether it is the key's first in the row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, digests, rows, places, firsts = batch.column("text").cast(pa.large_binary()), bytearray(), [], [], []

            def block():
                key = np.frombuffer(bytes(digests), "<i8").reshape(-1, 2)
                at = pa.array(rows, pa.int64())
                return pa.RecordBatch.from_arrays(
                    [pa.array(key[:, 0]), pa.array(key[:, 1]), batch.column("id").take(at), batch.column("row").take(at),
                     pa.array(places, pa.int32()), pa.array(firsts, pa.bool_())], ["h1", "h2", "id", "row", "place", "first"])

            for r in range(batch.num_rows):
                seen = set()
                for place, line in enumerate((texts[r].as_py() or b"").lower().split(b"\n")):
                    key = line.strip(_SPACE)
                    if key and _long_enough(key, least):
                        digest = hashlib.blake2b(key, digest_size=16).digest()
                        digests += digest
                        rows.append(r)
                        places.append(place)
                        firsts.append(digest not in seen)
                        seen.add(digest)
                if len(rows) >= _BLOCK_LINES:
                    yield block()
                    digests, rows, places, firsts = bytearray(), [], [], []
            if rows:
                yield block()
    return run


def lines_of(docs: DataFrame, id_col: str, text_col: str, least_chars: int) -> DataFrame:
    """All lines with a key.  ``row`` is a hash of the text: with the id it names the row, up to equal rows, which have equal lines."""
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("row"), text.alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(_lines(least_chars), f"h1 long, h2 long, id {kind}, row long, place int, first boolean")


@F.pandas_udf(T.StringType())
def _without(text: pd.Series, places: pd.Series) -> pd.Series:
    def kept(t, drop):
        if drop is None:
            return None
        gone = set(drop)
        return "\n".join(line for k, line in enumerate(t.split("\n")) if k not in gone)
    return pd.Series([kept(t, p) for t, p in zip(text, places)], dtype=object)


def drop_frequent_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_docs: int = LEAST_DOCS,
                        least_chars: int = LEAST_CHARS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """(id, n_lines, n_dropped, kept): the texts without the lines whose key ``least_docs`` documents or more hold."""
    spark = docs.sparkSession
    path = scratch_path(spark, "lines")
    # An input split is in one batch, so every task writes one file.
    lines = lines_of(docs, id_col, text_col, least_chars).withColumn("batch", F.pmod(F.spark_partition_id(), F.lit(batches)))
    lines.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(lines.schema).parquet(path)
    index = LineRuns(spark, least_docs, fanout, 8 + lines.count() // KEYS_PER_BUCKET)
    try:
        for b in range(batches):
            index.add(lines.filter((F.col("batch") == b) & F.col("first")))
        frequent = index.frequent()
    finally:
        index.close()
    places = (lines.join(frequent.select(*KEY), list(KEY)).groupBy("id", "row")
              .agg(F.collect_set("place").alias("places")).withColumnsRenamed({"id": "_id", "row": "_row"}))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("row"), text.alias("text"))
    met = rows.join(places, F.col("id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row")), "left")
    # Texts that keep all lines do not go to Python.
    cut = _without(F.when(F.col("places").isNotNull(), F.col("text")), F.col("places"))
    return met.select("id", (F.regexp_count("text", F.lit("\n")) + 1).cast("long").alias("n_lines"),
                      F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_dropped"), F.coalesce(cut, "text").alias("kept"))
