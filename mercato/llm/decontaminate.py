"""Benchmark decontamination by size-partitioned MinHash containment search
(operator 9).

Words are runs of ASCII letters (case folded), digits and non-ASCII characters.
A test item is its set of 5-word shingles (fewer words: its one whole
sequence, looked for as a run of that many words).  An item of n shingles is
contained in a document if at least 4/5 of them occur there.

* The items are partitioned by set size.  Each partition's MinHash sketch is
  the s smallest hashes of an item, with s = floor(top / 5) + 1 for the
  partition's largest size: a document that holds 4/5 of an item misses at
  most n / 5 of its shingles, so it holds one of any s of them.  Candidate
  search loses nothing, however long the document.
* A fixed-size bit filter of the sketches is tested inside the scan of the
  documents; only those that hit it give out rows: the hashes that hit the
  filter of all item shingles.  Candidates come from the join of these hashes
  with the sketches, and each is verified by the exact count of shared
  shingles over the whole document.

Equal texts are searched once.

Defined results.  Null or empty texts and items without words match nothing.
Repeated rows and repeated items give their pair once per distinct (id, item
id).  Null ids are kept as they are.  A very long text is searched whole.  An
empty table on either side gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm import vectext as V
from mercato.llm.shared import BitFilter, written

SHINGLE_WORDS = 5
#: Containment 4/5 as a fraction.
NUM, DEN = 4, 5
FILTER_LOG_BITS = 24


def size_tops(largest: int) -> np.ndarray:
    """Largest item size of each partition."""
    tops = [4]
    while tops[-1] < largest:
        tops.append(tops[-1] * 5 // 4 + 1)
    return np.array(tops, np.int64)


def item_shingles(items: DataFrame, id_col: str = "item_id", text_col: str = "text", k: int = SHINGLE_WORDS) -> DataFrame:
    """(item, set, width, n, h, in_sketch) for every distinct shingle of every item;
    ``set`` names the whole set, so items with one id and several texts stay apart."""
    id_type = items.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block in V.blocks(b.column("_text")):
                w = V.words(block, V.ALNUM, V.FOLDED)
                out_row, out_h, out_width = [], [], []
                for width in range(1, k + 1):
                    pos, h = V.grams(w, width)
                    fits = (w.counts()[w.row[pos]] >= k) if width == k else (w.counts()[w.row[pos]] == width)
                    row, h = V._distinct(w.row[pos][fits], h[fits])
                    out_row.append(row)
                    out_h.append(h)
                    out_width.append(np.full(len(row), width, np.int32))
                row, h, width = map(np.concatenate, (out_row, out_h, out_width))
                n = np.bincount(row, minlength=block.rows)
                tops = size_tops(int(n.max(initial=1)))
                least = tops[np.searchsorted(tops, n)] * (DEN - NUM) // DEN + 1
                order = np.lexsort((h, row))
                row, h, width = row[order], h[order], width[order]
                rank = np.arange(len(row)) - (np.cumsum(n) - n)[row]
                name = np.zeros(block.rows, np.uint64)
                np.add.at(name, row, V.mix(h))
                yield pa.RecordBatch.from_arrays(
                    [b.column("_id").take(pa.array(row + block.first)), pa.array(name.view(np.int64)[row]), pa.array(width), pa.array(n[row]),
                     pa.array(h.view(np.int64)), pa.array(rank < least[row])], names=["item", "set", "width", "n", "h", "in_sketch"])

    rows = items.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(run, f"item {id_type}, set long, width int, n long, h long, in_sketch boolean")


def _content(block: V.Block) -> np.ndarray:
    return V.span_hashes(block.data, block.offsets[:-1], block.offsets[1:]).view(np.int64)


def _scan(docs: DataFrame, id_col: str, text_col: str, widths: list[int], sketch: BitFilter, known: BitFilter) -> DataFrame:
    """(id, content, hashes) of the rows that hit the sketch filter: their distinct
    shingle hashes that hit the filter of all item shingles."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block in V.blocks(b.column("_text")):
                w = V.words(block, V.ALNUM, V.FOLDED)
                rows, hashes = [], []
                for width in widths:
                    pos, h = V.grams(w, width)
                    hit = known.may_hold(h)
                    rows.append(w.row[pos[hit]])
                    hashes.append(h[hit])
                row, h = V._distinct(np.concatenate(rows), np.concatenate(hashes))
                found = np.unique(row[sketch.may_hold(h)])
                if not len(found):
                    continue
                sel = np.isin(row, found)
                row, h = row[sel], h[sel]
                order = np.argsort(row, kind="stable")
                row, h = row[order], h[order]
                ends = np.searchsorted(row, found, "right")
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [b.column("_id").take(pa.array(found + block.first)), pa.array(_content(block)[found]), lists],
                    names=["_id", "content", "hashes"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(run, f"_id {id_type}, content long, hashes array<long>")


def _matches(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str,
             k: int) -> DataFrame:
    """(_id, content, item, n, shared) of every verified pair."""
    known = written(item_shingles(items, item_col, item_text, k).distinct(), "items")
    widths = sorted(r[0] for r in known.select("width").distinct().collect())   # at most k values
    if not widths:
        widths = [k]
    scan = _scan(docs, id_col, text_col, widths, BitFilter(known.filter("in_sketch"), "h", FILTER_LOG_BITS),
                 BitFilter(known, "h", FILTER_LOG_BITS))
    scan = written(scan, "scan")
    held = scan.groupBy("content").agg(F.first("hashes").alias("hashes")).select("content", F.explode("hashes").alias("h"))
    key = ["item", "set", "n"]
    candidates = held.join(known.filter("in_sketch").select(*key, "h"), "h").select("content", *key).distinct()
    shared = (held.join(known.select(*key, "h"), "h").join(candidates, ["content", *key], "left_semi")
              .groupBy("content", *key).agg(F.count(F.lit(1)).alias("shared"))
              .filter(F.col("shared") * DEN >= F.col("n") * NUM))
    return scan.select("_id", "content").distinct().join(shared, "content").select("_id", "content", "item", "n", "shared")


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", k: int = SHINGLE_WORDS) -> DataFrame:
    """(id, item id, n_shingles, n_shared, containment), one row per pair."""
    found = _matches(docs, items, id_col, text_col, item_col, item_text, k)
    return (found.groupBy("_id", "item").agg(F.max(F.struct(F.col("shared") / F.col("n"), "n", "shared")).alias("m"))
            .select(F.col("_id").alias(id_col), F.col("item").alias(item_col), F.col("m.n").alias("n_shingles"),
                    F.col("m.shared").alias("n_shared"), (F.col("m.shared") / F.col("m.n")).alias("containment")))


def without_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         item_col: str = "item_id", item_text: str = "text", k: int = SHINGLE_WORDS) -> DataFrame:
    """The input rows whose text holds no item.  Rows that miss a bit filter of the
    contaminated texts pass without a shuffle, the others are matched exactly."""
    bad = written(_matches(docs, items, id_col, text_col, item_col, item_text, k).select("content").distinct(), "bad")
    bits = BitFilter(bad, "content", FILTER_LOG_BITS)
    place = docs.columns.index(text_col)

    def split(clean: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for block in V.blocks(b.column(place)):
                    name = _content(block)
                    hit = bits.may_hold(name)
                    at = np.flatnonzero(~hit if clean else hit)
                    if len(at):
                        part = b.slice(block.first, block.rows).take(pa.array(at))
                        yield part if clean else pa.RecordBatch.from_arrays(
                            [*part.columns, pa.array(name[at])], names=[*b.schema.names, "_content"])
        return run

    clean = docs.mapInArrow(split(True), docs.schema)
    unsure = docs.mapInArrow(split(False), T.StructType([*docs.schema.fields, T.StructField("_content", T.LongType())]))
    unsure = unsure.join(bad.withColumnRenamed("content", "_content"), "_content", "left_anti")
    return clean.unionByName(unsure.select(*docs.columns))
