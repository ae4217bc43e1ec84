"""Audit of how filters act on each other (operator 11).

Five filters look at every whole text and give a failure mask, one bit a
filter.  Spark counts the masks per part (documents, good ones, toxic ones); a
part then has at most 32 rows, whatever its size, so no part is ever gathered.

Per part the counts become a decision diagram whose edges weigh the documents
below them: each level asks one filter, the pass edge leads to the documents
that pass it.  Equal subdiagrams are one node, empty ones are left out.  All
120 orders are met by swapping neighbouring levels, one swap an order (the
plain-changes sequence), so the diagram is never built anew.  For each order
the path of pass edges from the root gives the five steps: the fail edge that
leaves the path weighs what the step removes.

Filters (words: maximal runs without ASCII white space, case-sensitive):
  A  under 200 words
  B  distinct words below half of all words
  C  ``A``-``Z`` above 2 % of the code points
  D  holds one of ``# $ % & * |``
  E  a smaller id has the identical text, in any part, removed or not

Defined results.  Null text: empty; it fails A, passes B, C and D, and is
identical to every other null or empty text.  Null part: the empty string.  A
null id is smaller than none and has no smaller one, so it never fails E.
Repeated rows count one by one; rows of one id with the same text are not
copies of a smaller id.  Several label rows of an id: good (toxic) if one says
1; no label row: neither.  An empty table has no parts and gives no rows.  Very
long texts are read whole, by JVM expressions.  Other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DISTINCT = 50      # percent of the words
MOST_CAPITALS = 2        # percent of the code points
SIGNS = "[#$%&*|]"
_SPACES = r"[\x20\x09-\x0D]+"

STEPS = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
         "good_lost long, toxic_lost long, shapley long")


def own_mask(text: Column) -> Column:
    """Bits of the filters that see one text only: 1 for A, 2 for B, 4 for C, 8 for D."""
    words = F.array_remove(F.split(text, _SPACES), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    bits = [n < LEAST_WORDS, 100 * distinct < LEAST_DISTINCT * n, 100 * capitals > MOST_CAPITALS * F.length(text), text.rlike(SIGNS)]
    mask = F.lit(0)
    for k, failed in enumerate(bits):
        mask = mask + F.when(failed, 1 << k).otherwise(0)
    return mask.cast("int")


def mask_counts(docs: DataFrame, labels: DataFrame, part: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, mask, n, good, toxic): documents per failure mask.

    Only (id, part, text digest, mask) leave the scan.  Copies are told apart by
    counts per (digest, part), summed map-side, so a text that a third of all
    rows hold is one row a task: of each digest all rows fail E but those of
    its smallest id.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text, 256)).alias("digest"), own_mask(text).alias("own"))
    rows = rows.groupBy("id", "part", "digest", "own").agg(F.count(F.lit(1)).alias("n"))
    marks = labels.groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    rows = rows.join(marks, "id", "left").select(
        "id", "part", "digest", "own", "n", (F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        (F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"))
    figures = ("n", "good", "toxic")
    known = F.col("id").isNotNull()
    texts = rows.groupBy("digest", "part", "own").agg(
        *[F.sum(c).alias(c) for c in figures], *[F.sum(F.when(~known, F.col(c)).otherwise(0)).alias(f"idless_{c}") for c in figures],
        F.min(F.when(known, F.struct("id", *figures))).alias("least"))
    first = texts.groupBy("digest").agg(F.min("least.id").alias("first"))
    whole = texts.join(first, "digest")
    mine = F.col("least.id") == F.col("first")
    original = {c: F.col(f"idless_{c}") + F.when(mine, F.col(f"least.{c}")).otherwise(0) for c in figures}
    both = F.array(F.struct(F.col("own").alias("mask"), *[original[c].alias(c) for c in figures]),
                   F.struct((F.col("own") + 16).alias("mask"), *[(F.col(c) - original[c]).alias(c) for c in figures]))
    return (whole.select("part", F.inline(both)).filter("n > 0")
            .groupBy("part", "mask").agg(*[F.sum(c).cast("long").alias(c) for c in figures]))


class Diagram:
    """Count-weighted decision diagram over failure masks.

    A node is (id, pass child, fail child, weights); terminals are weights
    alone.  ``order`` names the filter of each level, from the root down.
    """

    def __init__(self, counts: dict[int, tuple[int, ...]], order: str = FILTERS):
        self.order = list(order)
        self._nodes: dict[tuple, tuple] = {}
        self.root = self._build(counts, 0)

    def _build(self, counts: dict[int, tuple[int, ...]], level: int):
        if not counts:
            return None
        if level == len(self.order):
            return self._leaf(next(iter(counts.values())))
        bit = 1 << FILTERS.index(self.order[level])
        return self._node(self._build({m: w for m, w in counts.items() if not m & bit}, level + 1),
                          self._build({m: w for m, w in counts.items() if m & bit}, level + 1))

    def _leaf(self, weights: tuple[int, ...]):
        return self._nodes.setdefault(("leaf", weights), (None, None, weights))

    def _node(self, passed, failed):
        """The one node with these children; None if both are empty."""
        if passed is None and failed is None:
            return None
        key = (id(passed) if passed else 0, id(failed) if failed else 0)
        if key not in self._nodes:
            self._nodes[key] = (passed, failed, tuple(map(sum, zip(self.weights(passed), self.weights(failed)))))
        return self._nodes[key]

    @staticmethod
    def weights(node) -> tuple[int, ...]:
        return node[2] if node else (0, 0, 0)

    def swap(self, level: int) -> None:
        """Swaps the filters of ``level`` and the one below it: the four grandchildren of a node
        of that level change places; levels above keep their weights, levels below their nodes."""
        changed: dict[int, tuple] = {}

        def rebuilt(node, depth):
            if node is None:
                return None
            if id(node) not in changed:
                if depth < level:
                    new = self._node(rebuilt(node[0], depth + 1), rebuilt(node[1], depth + 1))
                else:
                    pp, pf = node[0][:2] if node[0] else (None, None)
                    fp, ff = node[1][:2] if node[1] else (None, None)
                    new = self._node(self._node(pp, fp), self._node(pf, ff))
                changed[id(node)] = new
            return changed[id(node)]

        self.root = rebuilt(self.root, 0)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def all_pass_path(self) -> list[tuple[tuple[int, ...], tuple[int, ...]]]:
        """Per level: the weights that stay on the path and those that leave it."""
        out, node = [], self.root
        for _ in self.order:
            passed, failed = node[:2] if node else (None, None)
            out.append((self.weights(passed), self.weights(failed)))
            node = passed
        return out


def plain_changes(n: int) -> list[int]:
    """Places of the neighbouring swaps that lead through all orders of n things."""
    if n < 2:
        return []
    inner, out, down = plain_changes(n - 1), [], True
    for k in range(len(inner) + 1):
        out += range(n - 2, -1, -1) if down else range(n - 1)
        if k < len(inner):
            out.append(inner[k] + (1 if down else 0))
        down = not down
    return out


def steps_of(counts: dict[int, tuple[int, ...]]) -> list[tuple]:
    """(filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of every order and step."""
    diagram = Diagram(counts)
    paths = {"".join(diagram.order): diagram.all_pass_path()}
    for place in plain_changes(len(FILTERS)):
        diagram.swap(place)
        paths["".join(diagram.order)] = diagram.all_pass_path()
    shapley, failing, alone = dict.fromkeys(FILTERS, 0), {}, {}
    for order, path in paths.items():
        for letter, (_, lost) in zip(order, path):
            shapley[letter] += lost[0]
        failing[order[0]] = path[0][1][0]        # asked first, a filter removes all that fail it
        alone[order[-1]] = path[-1][1][0]        # asked last, only those that fail nothing else
    out = []
    for order in map("".join, permutations(FILTERS)):
        for k, (letter, (kept, lost)) in enumerate(zip(order, paths[order])):
            out.append((order, k + 1, kept[0], lost[0], failing[letter] - lost[0], alone[letter], lost[1], lost[2], shapley[letter]))
    return out


def _steps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in STEPS.split(", ")]
    for batch in batches:
        for part, masks in zip(batch["part"], batch["masks"]):
            rows = steps_of({m["mask"]: (m["n"], m["good"], m["toxic"]) for m in masks})
            yield pd.DataFrame([(part, *r) for r in rows], columns=names)


def filter_audit(docs: DataFrame, labels: DataFrame, part: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per part, order of the filters and step, with the columns of ``STEPS``."""
    counts = mask_counts(docs, labels, part, id_col, text_col)
    # At most 32 masks a part.
    diagrams = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    return diagrams.mapInPandas(_steps, STEPS)
