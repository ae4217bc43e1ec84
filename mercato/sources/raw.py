"""Raw sources: read, fingerprint, profile, type (A01-A04) and the SQL
catalog of model tables (A12)."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.sources.records import Delimited, read_records


def table_name(filename: str, strip: Iterable[str] = ()) -> str:
    """The file's name without its ending and the parts ``strip``."""
    stem = os.path.splitext(os.path.basename(filename))[0]
    for part in strip:
        stem = stem.replace(part, "")
    return stem


def delimited_table(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A CSV file or folder with header records as all-string columns, empty cells null; a large file is read by all tasks,
    whatever line ends its quoted fields hold.  A row with more cells than the header raises."""
    records = read_records(spark, path, Delimited(sep))
    head = records.rows(records.first_blocks()).filter("number = 0").select("cells").distinct().limit(2).collect()
    if len(head) > 1:
        raise ValueError(f"the files of {path} have different headers")
    names = head[0]["cells"] if head else []
    fits = F.when(F.size("cells") <= len(names), F.lit(True)).otherwise(
        F.raise_error(F.lit("a row has more values than the header")).cast("boolean"))
    rows = records.rows().filter("number > 0").filter(fits)
    return rows.select(*[F.nullif(F.get("cells", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)])


def read_raw_tables(spark: SparkSession, directory: str, expected: Iterable[str] | None = None,
                    fmt: str = "csv", strip: Iterable[str] = ()) -> dict[str, DataFrame]:
    """Every file of a folder as an all-string DataFrame, keyed by the
    cleaned table name.  CSV is read with header, quoted multi-line fields and
    doubled quotes, without type inference.  ``expected`` asserts the set."""
    # Listed by Spark's own file source (paths only, no bytes), so any store will do.
    found = (spark.read.format("binaryFile").option("pathGlobFilter", f"*.{fmt}").load(directory).select("path").collect())
    out = {}
    for path in sorted(r["path"] for r in found):
        if fmt == "csv":
            df = delimited_table(spark, path)
        else:
            df = spark.read.format(fmt).load(path)
            df = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
        out[table_name(path, strip)] = df
    if expected is not None:
        missing = set(expected) - set(out)
        if missing:
            raise ValueError(f"missing source tables: {sorted(missing)}")
    return out


def parquet_tables(spark: SparkSession, directory: str) -> list[str]:
    """Names of the Parquet tables of a folder, each one file or a folder of files."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
             .load(directory).select(F.regexp_extract("path", r"^.*?/([^/]+)\.parquet(?:/|$)", 1).alias("table")))
    return sorted(r["table"] for r in files.distinct().collect())


def source_manifest(spark: SparkSession, directory: str, glob: str = "*.csv",
                    tables: dict[str, DataFrame] | None = None, strip: Iterable[str] = ()) -> DataFrame:
    """Per file: name, size, SHA-256 of the bytes, and rows/columns when
    the parsed table is given.  Hashing is per file (one task per file)."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(directory)
             .select(F.element_at(F.split("path", "/"), -1).alias("file"), "length",
                     F.sha2("content", 256).alias("sha256")))
    if not tables:
        return files
    counts = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("columns"))
        counts = row if counts is None else counts.unionByName(row)
    name = F.col("file")
    for part in strip:
        name = F.replace(name, F.lit(part), F.lit(""))
    files = files.withColumn("table", F.regexp_replace(name, r"\.[^.]+$", ""))
    return files.join(counts, "table", "left")


def _cells(df: DataFrame, table: str) -> DataFrame:
    """(table, column, h1, h2): a 128-bit hash of every non-null value, and one row of column -1 per row of ``df``.

    The values themselves, texts and vectors, stay where they are read."""
    cells = [F.struct(F.lit(-1).alias("column"), F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"))]
    for i, c in enumerate(df.columns):
        value = F.col(f"`{c}`")
        cells.append(F.when(value.isNotNull(), F.struct(F.lit(i).alias("column"), F.xxhash64(value).alias("h1"),
                                                        F.xxhash64(F.lit(1), value).alias("h2"))))
    return df.select(F.explode(F.array(*cells)).alias("x")).filter("x IS NOT NULL").select(F.lit(table).alias("table"), "x.*")


def _united(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _profile_rows(counts: DataFrame, tables: dict[str, list[str]]) -> DataFrame:
    """Counts (table, column, present, distinct) to one row per column; a column without values has no count.  Both sides
    have one row a column."""
    places = [(t, i, c) for t, columns in tables.items() for i, c in enumerate(columns)]
    names = counts.sparkSession.createDataFrame(places, "table string, column int, name string")
    of_table = F.max(F.when(F.col("column") == -1, F.col("present"))).over(Window.partitionBy("table"))
    whole = names.join(counts, ["table", "column"], "full_outer").withColumn("rows", F.coalesce(of_table, F.lit(0)))
    missing = F.col("rows") - F.coalesce("present", F.lit(0))
    return whole.filter("column >= 0").select(
        "table", F.col("name").alias("column"), "rows", missing.alias("missing"), F.try_divide(missing, F.col("rows")).alias("missing_rate"),
        F.coalesce("distinct", F.lit(0)).alias("unique_non_null"))


def profile_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """A03 of several tables: per table and column: rows, missing, missing rate, distinct non-null values.

    One pass over each table and one shuffle for all: (table, column, 128-bit hash) is counted map-side, so only one short
    row per distinct value is moved."""
    cells = _united([_cells(df, name) for name, df in tables.items()])
    seen = cells.groupBy("table", "column", "h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    counts = seen.groupBy("table", "column").agg(F.sum("n").alias("present"), F.count(F.lit(1)).alias("distinct"))
    return _profile_rows(counts, {name: list(df.columns) for name, df in tables.items()})


def column_profile(df: DataFrame, table: str, approx: bool = False) -> DataFrame:
    """A03 of one table; ``approx=True`` counts distinct values by sketches."""
    if approx:
        return profile_of_sketches(column_sketches(df, table), {table: list(df.columns)})
    return profile_tables({table: df})


def column_sketches(df: DataFrame, table: str, log_buckets: int = 14) -> DataFrame:
    """(table, column, present, sketch): a profile to store and add to.  Sketches of more rows of the same table are united
    with these by ``united_sketches``; a column is known by its place."""
    return _cells(df, table).groupBy("table", "column").agg(F.count(F.lit(1)).alias("present"), F.hll_sketch_agg("h1", F.lit(log_buckets)).alias("sketch"))


def united_sketches(*sketches: DataFrame) -> DataFrame:
    return _united(list(sketches)).groupBy("table", "column").agg(F.sum("present").alias("present"), F.hll_union_agg("sketch").alias("sketch"))


def profile_of_sketches(sketches: DataFrame, tables: dict[str, list[str]]) -> DataFrame:
    """A03 from stored sketches: counts exact, distinct values estimated."""
    return _profile_rows(sketches.select("table", "column", "present", F.hll_sketch_estimate("sketch").alias("distinct")), tables)


def coerce_types(df: DataFrame, types: dict[str, str], policy: str = "raise",
                 row_id: str | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Declared conversion of string columns.

    ``raise``: ANSI ``cast`` (a bad value fails the job).  ``quarantine``:
    ``try_cast``; rows with a value that does not convert go to a reject frame
    (column, value) and the typed frame keeps the row with null there."""
    if policy not in ("raise", "quarantine"):
        raise ValueError("policy must be 'raise' or 'quarantine'")
    conv = {c: (F.col(c).cast(t) if policy == "raise" else F.col(c).try_cast(t)) for c, t in types.items()}
    typed = df.select(*[conv.get(c, F.col(c)).alias(c) for c in df.columns])
    if policy == "raise":
        return typed, None
    keep = [F.col(row_id)] if row_id else []
    bad = [F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.struct(F.lit(c).alias("column"), F.col(c).alias("value")))
           for c, t in types.items()]
    rejects = df.select(*keep, F.explode(F.array(*bad)).alias("_bad")).filter("_bad IS NOT NULL").select(*keep, "_bad.column", "_bad.value")
    return typed, rejects


def model_catalog(tables: dict[str, DataFrame]) -> list[str]:
    """Expose tables to SQL by name (session temp views)."""
    for name, df in tables.items():
        if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):
            raise ValueError(f"bad view name: {name}")
        df.createOrReplaceTempView(name)
    return sorted(tables)
