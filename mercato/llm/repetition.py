"""Quality rules with suffix-array repetition (operator 8).

Words are `[^\\x20\\x09-\\x0D]+` of the whole text.  Beside four plain counts, the
operator finds the maximal repeated word sequences of a document: a suffix
array over the words (prefix doubling) with its longest-common-prefix values.
A suffix whose neighbour in the array shares ``l >= min_repeat`` words starts a
repeated sequence of l words; the union of these spans is the covered part.
A document is rejected when the covered share or the longest repeat, in words
or as a share of the text, is over its limit.  A covered word also lies in a
3-word window found twice, so the covered limit is below the base limit.

Only documents in which some run of ``min_repeat`` words occurs twice can have
such a span, so the array is built for those alone; the others get 0.

Defined results.  Null or empty text: no words, all counts 0, base_failed.
Repeated rows are judged one by one.  A very long text is one block and is
read whole.  Columns other than the id and the text are ignored, so clashing
names do no harm.  A null id stays null.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm import vectext as V

#: Characters counted as symbols: fixed values.
SYMBOLS = b"#*$%&|<>"
MIN_REPEAT = 10
MAX_COVERED = 0.35
MAX_LONGEST = 200
MAX_LONGEST_SHARE = 0.20
#: Base limits: fixed values.
MIN_WORDS = 50
MAX_REPEAT_WORDS_PERCENT = 50

_symbol = np.zeros(256, bool)
_symbol[list(SYMBOLS)] = True

SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "covered_words long, longest_repeat long")


def suffix_order(ids: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of word ids, suffixes ending with their row, and the rank
    arrays of the prefix lengths 1, 2, 4, ... used on the way."""
    n = len(ids)
    last = np.zeros(n, np.int64)     # words from here to the row's end
    ends = np.flatnonzero(np.concatenate([row[1:] != row[:-1], [True]]))
    last = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n) + 1
    _, rank = np.unique(ids, return_inverse=True)
    rank = rank.astype(np.int64) + 1
    levels, width = [], 1
    while True:
        levels.append(rank)
        nxt = np.zeros(n, np.int64)
        have = last > width
        nxt[have] = rank[np.flatnonzero(have) + width]
        # A suffix that ends inside the compared prefix differs from every other row's.
        nxt[~have] = -1 - row[~have]
        low = nxt - nxt.min()
        key = rank * (low.max() + 1) + low
        order = np.argsort(key)
        k = key[order]
        new = np.concatenate([[True], k[1:] != k[:-1]])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        width *= 2
        if new.all() or width > last.max():
            return order, levels


def longest_common_prefixes(order: np.ndarray, levels: list[np.ndarray], row: np.ndarray) -> np.ndarray:
    """LCP in words of each suffix with its predecessor in the array, inside one row."""
    n = len(order)
    ends = np.flatnonzero(np.concatenate([row[1:] != row[:-1], [True]]))
    stop = ends[np.searchsorted(ends, np.arange(n))] + 1
    a, b = order[1:].copy(), order[:-1].copy()
    same = row[a] == row[b]
    stop_a, stop_b = stop[a], stop[b]
    lcp = np.zeros(n - 1, np.int64)
    for j in range(len(levels) - 1, -1, -1):
        width = 1 << j
        fit = same & (a + width <= stop_a) & (b + width <= stop_b)
        at = np.flatnonzero(fit)
        at = at[levels[j][a[at]] == levels[j][b[at]]]
        lcp[at] += width
        a[at] += width
        b[at] += width
    return np.concatenate([[0], lcp])


def repeat_lengths(ids: np.ndarray, row: np.ndarray) -> np.ndarray:
    """For each word, the length of the longest sequence that starts there and
    occurs again (overlapping or not) in the same row."""
    # The row is the leading part of the key, so suffixes of one row are neighbours.
    z = ids ^ V.mix(row.astype(np.uint64) + np.uint64(1))
    order, levels = suffix_order(z, row)
    lcp = longest_common_prefixes(order, levels, row)
    best = np.maximum(lcp, np.concatenate([lcp[1:], [0]]))
    out = np.zeros(len(ids), np.int64)
    out[order] = best
    return out


def covered_by(start: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """Mask of the n places lying in the union of the spans."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + length, -1)
    return np.cumsum(edge[:-1]) > 0


def _sum_by_row(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    return np.bincount(row, values, rows).astype(np.int64)


def block_figures(block: V.Block, min_repeat: int) -> dict[str, np.ndarray]:
    data, rows = block.data, block.rows
    w = V.words(block)
    n_words = w.counts()
    inside = V.NOT_SPACE[data] & ((data & 0xC0) != 0x80)
    out = {"n_words": n_words, "word_chars": V.per_row(inside, block.offsets),
           "n_symbols": V.per_row(_symbol[data], block.offsets)}
    # Lines: spans between line feeds and row edges that hold a word's start.
    feeds = np.flatnonzero(data == 10)
    inner = block.offsets[:-1]
    start = np.unique(np.concatenate([inner[inner < len(data)], feeds + 1]))
    start = start[start < len(data)]
    end = np.concatenate([start[1:], [len(data)]]) if len(start) else start
    has_feed = np.zeros(len(start), np.int64)
    if len(start):
        has_feed = (data[end - 1] == 10).astype(np.int64)
    line_end = end - has_feed
    with_word = np.searchsorted(w.start, line_end) > np.searchsorted(w.start, start)
    start, line_end = start[with_word], line_end[with_word]
    line_row = np.searchsorted(block.offsets, start, "right") - 1
    lh = V.span_hashes(data, start, line_end)
    distinct_row, _ = V._distinct(line_row, lh)
    out["n_dup_lines"] = np.bincount(line_row, minlength=rows) - np.bincount(distinct_row, minlength=rows)
    # Words in 3-word windows found twice or more.
    pos, h = V.grams(w, 3)
    twice = pos[V.repeated(w.row[pos], h)] if len(pos) else pos
    mark = covered_by(twice, np.full(len(twice), 3), len(w.start)) if len(twice) else np.zeros(len(w.start), bool)
    out["n_repeat_words"] = _sum_by_row(mark, w.row, rows)
    # Repeats of min_repeat words or more, for rows that hold one.
    covered, longest = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    pos, h = V.grams(w, min_repeat)
    if len(pos):
        hit = np.unique(w.row[pos[V.repeated(w.row[pos], h)]])
        if len(hit):
            sel = np.zeros(rows, bool)
            sel[hit] = True
            at = np.flatnonzero(sel[w.row])
            row = w.row[at]
            length = repeat_lengths(w.hash[at], row)
            long = length >= min_repeat
            mark = covered_by(np.flatnonzero(long), length[long], len(at))
            covered = _sum_by_row(mark, row, rows)
            np.maximum.at(longest, row, np.where(long, length, 0))
    out["covered_words"], out["longest_repeat"] = covered, longest
    return out


def repetition_figures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       min_repeat: int = MIN_REPEAT, passed: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: the id, the columns named in ``passed``, and the figures of SCHEMA."""
    keep = [id_col, *passed]
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(c, T.LongType()) for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column("_text")
            for block in V.blocks(text):
                fig = block_figures(block, min_repeat)
                part = b.slice(block.first, block.rows)
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + [pa.array(fig[c], pa.int64()) for c in names],
                                                 names=keep + names)

    rows = docs.select(*keep, F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(run, schema)


def verdicts(figures: DataFrame, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST,
             max_longest_share: float = MAX_LONGEST_SHARE) -> DataFrame:
    """Adds base_failed and kept."""
    base = ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_WORDS_PERCENT * F.col("n_words")))
    repeats = ((F.col("covered_words") > F.lit(max_covered) * F.col("n_words"))
               | (F.col("longest_repeat") > max_longest)
               | (F.col("longest_repeat") > F.lit(max_longest_share) * F.col("n_words")))
    return figures.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & ~repeats)
