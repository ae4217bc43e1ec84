"""Sinks (B01-B05): model tables, review exports and the BI star."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

# Annotation fields of the review export, in export order.
ANNOTATION_KEYS = ["sentiment", "sentiment_initial", "score_modele", "a_verifier", "correction_manuelle", "themes",
                   "indices", "texte_repete", "methode", "avis_analyses", "avis_importes"]
LIST_SEPARATOR = " | "
FORMULA_PATTERN = r"(?U)^(\s*[=+@\-])"


def write_model(tables: dict[str, DataFrame], path: str, fmt: str = "parquet",
                partition_by: dict[str, Sequence[str]] | None = None, mode: str = "overwrite") -> list[str]:
    """Write facts, dimensions and aggregates; facts may be partitioned
    (e.g. fact_orders by purchase_month) for partition pruning later."""
    written = []
    for name, df in tables.items():
        w = df.write.mode(mode)
        parts = (partition_by or {}).get(name)
        if parts:
            w = w.partitionBy(*parts)
        target = os.path.join(path, name)
        if fmt == "csv":
            w.option("header", True).csv(target)
        else:
            w.format(fmt).save(target)
        written.append(target)
    return written


def neutralize_formulas(c: Column) -> Column:
    """Prefix a quote when a cell starts with optional spaces then = + @ -."""
    return F.regexp_replace(c, FORMULA_PATTERN, "'$1")


def annotation_names(columns: Sequence[str]) -> list[str]:
    """Export names analyse_<key>, prefixed with '_' while the name is taken."""
    out = []
    for k in ANNOTATION_KEYS:
        name = f"analyse_{k}"
        while name in columns:
            name = "_" + name
        out.append(name)
    return out


def annotation_struct(rows: DataFrame, analysed: Column, imported: Column) -> Column:
    return F.struct(F.col("sentiment").alias("sentiment"),
                    F.coalesce(F.col("sentiment_initial"), F.col("sentiment")).alias("sentiment_initial"),
                    F.col("confidence").alias("score_modele"),
                    F.coalesce(F.col("uncertain"), F.lit(False)).alias("a_verifier"),
                    F.coalesce(F.col("corrected"), F.lit(False)).alias("correction_manuelle"),
                    F.col("themes").alias("themes"), F.col("evidence").alias("indices"),
                    F.col("duplicate").alias("texte_repete"), F.col("method").alias("methode"),
                    analysed.alias("avis_analyses"), imported.alias("avis_importes"))


def export_cells(rows: DataFrame, source_columns: Sequence[str], imported: DataFrame | None = None,
                 carried: Sequence[str] = ()) -> DataFrame:
    """B02 cells: source columns then the 11 annotation columns as text; lists
    joined with ' | ', formulas neutralized, nulls as ''.  ``carried`` columns go along, untouched, as _<name>."""
    n_rows = rows.agg(F.count(F.lit(1)).alias("_analysed"))
    n_imp = (imported if imported is not None else rows).agg(F.count(F.lit(1)).alias("_imported"))
    base = rows.crossJoin(F.broadcast(n_rows)).crossJoin(F.broadcast(n_imp))
    ann = annotation_struct(base, F.col("_analysed"), F.col("_imported"))
    base = base.withColumn("_a", ann)
    names = annotation_names(source_columns)
    cells = [F.col(c).cast("string").alias(c) for c in source_columns]
    for key, name in zip(ANNOTATION_KEYS, names):
        v = F.col("_a")[key]
        field = [f for f in base.schema["_a"].dataType.fields if f.name == key][0]
        if isinstance(field.dataType, ArrayType):
            v = F.array_join(v, LIST_SEPARATOR)
        cells.append(v.cast("string").alias(name))
    kept = [F.col(c).alias(f"_{c}") for c in carried]
    out = base.select(*cells, *kept)
    shown = [c for c in out.columns if c not in {f"_{x}" for x in carried}]
    return out.select(*[neutralize_formulas(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in shown], *[f"_{c}" for c in carried])


def export_lines(cells: DataFrame, order: Sequence[str], path: str, sep: str = ";", mark: bool = True) -> str:
    """Writes all-string ``cells`` as text files that make one document when joined by name: one header record, at the start
    and after a UTF-8 byte-order mark; every field quoted, quotes doubled; records end with CR LF and follow ``order``, the
    columns of which are not written."""
    shown = [c for c in cells.columns if c not in order]
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    rows = cells.select(F.lit(1).alias("_part"), *order, F.concat_ws(sep, *[quoted(F.coalesce(F.col(f"`{c}`"), F.lit(""))) for c in shown]).alias("value"))
    head = sep.join('"' + c.replace('"', '""') + '"' for c in shown)
    first = cells.sparkSession.range(1).select(F.lit(0).alias("_part"), *[F.lit(None).cast(cells.schema[c].dataType).alias(c) for c in order],
                                               F.lit(("\ufeff" if mark else "") + head).alias("value"))
    lines = first.unionByName(rows).repartitionByRange("_part", *order).sortWithinPartitions("_part", *order).select("value")
    lines.write.mode("overwrite").option("lineSep", "\r\n").text(path)
    return path


def export_reviews_csv(rows: DataFrame, source_columns: Sequence[str], path: str,
                       imported: DataFrame | None = None, order: str = "row_id") -> str:
    """B02: ';' separated, every field quoted, quotes doubled, UTF-8 with its mark, CR LF, one header, in the order of ``order``
    (``export_lines``)."""
    cells = export_cells(rows, source_columns, imported, carried=[order])
    return export_lines(cells, [f"_{order}"], path)


def export_reviews_json(rows: DataFrame, source_columns: Sequence[str], path: str,
                        imported: DataFrame | None = None) -> str:
    """One object per row {source: {...}, analyse: {...}}; texts kept as is."""
    n_rows = rows.agg(F.count(F.lit(1)).alias("_analysed"))
    n_imp = (imported if imported is not None else rows).agg(F.count(F.lit(1)).alias("_imported"))
    base = rows.crossJoin(F.broadcast(n_rows)).crossJoin(F.broadcast(n_imp))
    out = base.select(F.struct(*[F.col(c) for c in source_columns]).alias("source"),
                      annotation_struct(base, F.col("_analysed"), F.col("_imported")).alias("analyse"))
    out.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def export_bi_star(tables: dict[str, DataFrame], path: str) -> list[str]:
    """The seven BI tables, typed, written side by side."""
    return write_model(tables, path, "parquet")
