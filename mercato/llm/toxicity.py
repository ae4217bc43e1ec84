"""Toxicity scores from a counterfactually regularised classifier (operator 5).

A logistic model over the distinct words of a text.  The words that it weighs are
chosen by a Spark count over a bounded sample of labelled rows (``max_rows``, a
parameter); the weights are fitted in numpy on that sample.

Counterfactual term: in every labelled sentence that names a group of people the
group word is swapped for others of its kind, and the squared change of the score
is penalised.  The few sentences in NEUTRAL and HOSTILE name groups without and
with abuse; they join the labelled rows, so the weights of group words are held
together and near 0 whether or not the sample names any group.

Scores use the whole text and nothing but the text.

Defined results.  Null or empty text: the score of a text without known words.
Repeated rows get equal scores.  A label that is null, or whose document is not
there, is not used.  Without labelled rows of both classes the fixed sentences
alone are fitted.  Null ids are kept and count as not held out.  A very long text
is read whole.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm import vectext as V
from mercato.llm.shared import written

#: Group words by kind; swapped inside their kind.
GROUPS = {
    "people": ("women", "men", "girls", "boys", "gay", "lesbian", "straight", "trans", "queer"),
    "faith": ("muslim", "muslims", "christian", "christians", "jewish", "jews", "hindu", "buddhist", "atheist"),
    "origin": ("black", "white", "asian", "african", "european", "american", "mexican", "arab", "immigrant", "immigrants"),
    "body": ("blind", "deaf", "disabled", "old", "young"),
}
NEUTRAL = ("my neighbour is {} and works at the school", "a group of {} people came to the market", "she wrote about {} life in the city",
           "the {} community opened a library", "he is proud to be {}")
HOSTILE = ("you are a stupid {} idiot", "{} people are disgusting trash", "shut up you worthless {} moron")

MAX_ROWS = 20_000
MAX_WORDS = 4_000
MIN_ROWS = 4
HOLDOUT_PARTS = 5


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % HOLDOUT_PARTS == 0, F.lit(False))


def _distinct_words(w: V.Words) -> tuple[np.ndarray, np.ndarray]:
    return V._distinct(w.row, w.hash)


def _hash_words(text: str) -> list[int]:
    block = next(V.blocks(pa.array([text])), None)
    return [] if block is None else np.unique(V.words(block, V.ALNUM, V.FOLDED).hash).view(np.int64).tolist()


@dataclass
class Model:
    words: np.ndarray      # sorted word hashes (int64)
    weights: np.ndarray
    bias: float

    def scores(self, block: V.Block) -> np.ndarray:
        row, h = _distinct_words(V.words(block, V.ALNUM, V.FOLDED))
        h = h.view(np.int64)
        z = np.full(block.rows, self.bias)
        if len(self.words) and len(h):
            at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
            hit = self.words[at] == h
            z += np.bincount(row[hit], self.weights[at[hit]], block.rows)
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def labelled_words(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_rows: int) -> DataFrame:
    """(label, words: distinct word hashes) of at most ``max_rows`` labelled rows, the
    first by a hash of their id; held-out rows are never among them."""
    usable = (labels.filter(~held_out(F.col(id_col)) & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(id_col).agg(F.max(label_col).cast("int").alias("label")))
    sample = usable.orderBy(F.xxhash64(id_col), id_col).limit(max_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block in V.blocks(b.column("_text")):
                row, h = _distinct_words(V.words(block, V.ALNUM, V.FOLDED))
                ends = np.searchsorted(row, np.arange(block.rows), "right")
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([b.column("label").slice(block.first, block.rows), lists], names=["label", "words"])

    # At most max_rows pairs of an id and a label: a broadcast of bounded size.
    rows = docs.select(id_col, F.col(text_col).cast("string").alias("_text")).join(F.broadcast(sample), id_col)
    return rows.select("label", "_text").mapInArrow(run, "label int, words array<long>")


def chosen_words(rows: DataFrame, max_words: int, min_rows: int) -> list[int]:
    """The words whose share of rows differs most between the classes, by z-score."""
    n1, n0 = rows.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first()
    if not n0 or not n1:
        return []
    counts = (rows.select("label", F.explode("words").alias("w")).groupBy("w")
              .agg(F.sum("label").alias("a"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_rows))
    p = F.col("n") / (n0 + n1)
    spread = F.sqrt(p * (1 - p) * (1.0 / n0 + 1.0 / n1) + 1e-12)
    z = F.abs(F.col("a") / n1 - (F.col("n") - F.col("a")) / n0) / spread
    return [r["w"] for r in counts.withColumn("z", z).orderBy(F.col("z").desc(), "w").limit(max_words).collect()]


def swaps(words: list[int], kinds: dict[int, tuple[int, ...]]) -> list[tuple[int, int]]:
    """Each group word of the sentence with each other one of its kind."""
    return [(w, other) for w in words for other in kinds.get(w, ()) if other != w]


def group_kinds() -> dict[int, tuple[int, ...]]:
    """Hash of each group word -> hashes of its kind."""
    kinds = [tuple(_hash_words(x)[0] for x in kind) for kind in GROUPS.values()]
    return {h: kind for kind in kinds for h in kind}


def fit(rows: list[tuple[int, list[int]]], words: list[int], swap_weight: float = 1.0, l2: float = 0.5, steps: int = 400,
        rate: float = 0.05) -> Model:
    """Minimises weighted mean log-loss + swap_weight * mean squared score change under swaps +
    l2 / rows * |weights|^2 by Adam from zero; the same each time."""
    kinds = group_kinds()
    sentences = [(label, _hash_words(s.format(g))) for label, forms in ((0, NEUTRAL), (1, HOSTILE)) for s in forms
                 for kind in GROUPS.values() for g in kind]
    allowed = np.array(sorted(set(words) | set(kinds) | {w for _, s in sentences for w in s}), np.int64)
    index = {int(w): i for i, w in enumerate(allowed)}
    data = [(y, [index[w] for w in ws if w in index]) for y, ws in rows] + [(y, [index[w] for w in ws]) for y, ws in sentences]
    # A swap as (row, group word, the other word): the rest of the sentence is the row's own.
    pairs = np.array([(i, index[w], index[other]) for i, (_, ws) in enumerate([*rows, *sentences]) for w, other in swaps(ws, kinds)], np.int64)
    pair_row, left, put = pairs.T
    y = np.array([d[0] for d in data], float)
    at = np.array([i for _, ws in data for i in ws], np.int64)
    row = np.repeat(np.arange(len(data)), [len(ws) for _, ws in data])

    n, m, d = len(data), len(pairs), len(allowed)
    # The rarer class counts more, by the root of the ratio.
    ones = max(1.0, y.sum())
    weight = np.where(y == 1, np.sqrt(max(1.0, n - ones) / ones), 1.0)
    weight /= weight.sum()
    w, bias = np.zeros(d), 0.0
    mom, var = np.zeros(d + 1), np.zeros(d + 1)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for step in range(1, steps + 1):
        z = np.bincount(row, w[at], n) + bias
        p = sig(z)
        err = weight * (p - y)
        g = np.bincount(at, err[row], d) + l2 / n * w
        gb = err.sum()
        za = z[pair_row]
        pa_, pb_ = sig(za), sig(za - w[left] + w[put])
        diff = 2 * swap_weight * (pa_ - pb_) / m
        da, db = diff * pa_ * (1 - pa_), diff * pb_ * (1 - pb_)
        g += np.bincount(at, np.bincount(pair_row, da - db, n)[row], d) + np.bincount(left, db, d) - np.bincount(put, db, d)
        gb += (da - db).sum()
        full = np.append(g, gb)
        mom = 0.9 * mom + 0.1 * full
        var = 0.999 * var + 0.001 * full * full
        move = rate * (mom / (1 - 0.9 ** step)) / (np.sqrt(var / (1 - 0.999 ** step)) + 1e-10)
        w, bias = w - move[:-1], bias - move[-1]
    return Model(allowed, w, float(bias))


def calibrated(rows: list[tuple[int, list[int]]], words: list[int], folds: int = 3) -> Model:
    """The fitted model with its bias moved so that score 0.5 is where rows that a
    model has not seen are told apart best (F1 over ``folds`` cross fits)."""
    model = fit(rows, words)
    logits, labels = [], []
    for k in range(folds):
        part = [r for i, r in enumerate(rows) if i % folds != k]
        if not {0, 1} <= {y for y, _ in part}:
            return model
        own = fit(part, words, steps=200)
        weight = dict(zip(own.words.tolist(), own.weights, strict=True))
        for y, ws in rows[k::folds]:
            logits.append(own.bias + sum(weight.get(w, 0.0) for w in ws))
            labels.append(y)
    order = np.argsort(logits)[::-1]
    z, y = np.array(logits)[order], np.array(labels)[order]
    hits = np.cumsum(y)
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    best = int(f1.argmax())
    below = z[best + 1] if best + 1 < len(z) else z[best] - 1
    model.bias -= float(z[best] + below) / 2
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          max_rows: int = MAX_ROWS, max_words: int = MAX_WORDS) -> Model:
    rows = written(labelled_words(docs, labels, id_col, text_col, label_col, max_rows), "labelled")
    words = chosen_words(rows, max_words, MIN_ROWS)
    # At most max_rows lists of at most max_words chosen words and the group words each.
    data = [(r["label"], r["words"]) for r in _only(rows, [*words, *group_kinds()]).collect()] if words else []
    return calibrated(data, words)


def _only(rows: DataFrame, words: list[int]) -> DataFrame:
    """The rows with the given words alone."""
    keep = rows.sparkSession.sparkContext.broadcast(np.sort(np.array(words, np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            known, out = keep.value, []
            for ws in b.column("words"):
                h = ws.values.to_numpy(zero_copy_only=False)
                out.append(h[np.isin(h, known)].tolist())
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(out, pa.list_(pa.int64()))], names=["label", "words"])

    return rows.mapInArrow(run, rows.schema)


def toxicity_scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, held_out, score, predicted (1 from score 0.5 on)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block in V.blocks(b.column("_text")):
                yield pa.RecordBatch.from_arrays([b.column("_id").slice(block.first, block.rows), pa.array(shared.value.scores(block))],
                                                 names=[id_col, "score"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).mapInArrow(run, schema)
    return rows.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def held_out_of(doc_id: int) -> bool:
    """``held_out`` for one id, as a plain check."""
    return zlib.crc32(str(doc_id).encode()) % HOLDOUT_PARTS == 0
