"""N-gram Jaccard join by prefixes of the scarcest shingles (operator 3).

Documents are sets of word shingles.  Two sets of sizes a and b have Jaccard
similarity >= 4/5 only if 9 times their intersection is at least 4 (a + b), so
either holds four fifths of the other.

* All shingles have one global order, and a set signs with its first a / 5 + 1
  (prefix filter): two linked sets share a signature.  Any order that all sets
  share loses no pair; this one puts shingles of few sets first, by a table of
  fixed size that counts the shingles of all sets by hash.  Copies that were
  changed in too many places sign with their own changes alone, and a passage
  that many documents hold is a signature only of documents that hold little else.
* A signature goes with its place in the set.  If it is the first that two sets
  share, they share nothing before it, so the rest of each set must be large
  enough for the intersection (positional filter).  A linked pair passes at the
  first signature that it shares.

Candidates are not all pairs of a signature's holders.  Each holder is first
compared with one centre, the holder with the earliest place, which joins copies
to components.  A linked node has its closest
centre as hub, at a known difference.  Where components still meet in a
signature their hubs are compared: by the triangle inequality the hubs'
distance rules out most pairs of hubs with all their nodes.  Of the others each
node is compared with the other hub, and nodes with nodes only where that leaves
a link possible.  In a signature the first 3, the next 12, 48, ... hubs
meet all later ones, until no pair of different components is left unseen.  A pair is first tested on parity sketches (two to four bits a
shingle; they bound the difference from below, so nothing is lost), then
exactly, on the shingles of both whole texts.

Equal sets are one node from the start: the join runs over distinct sets.

Defined results.  Null or empty text, or one without words: no shingles,
linked with nothing, its own class.  Fewer than k words: one shingle, the whole
sequence.  Repeated rows come back as often as they came, all in one class; a
null id counts as no id (a class of null ids alone has component_id null).
Columns other than the id and the text are ignored.  An empty table gives an
empty result.  Sets are named by a 64-bit hash: N distinct sets collide with
probability N^2 / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm import vectext as V
from mercato.llm.shared import BitFilter, written

SHINGLE_WORDS = 5
#: Similarity 4/5 as a fraction.
NUM, DEN = 4, 5
#: Cells (as a power of 2) of the table of signature counts.
COUNT_LOG_CELLS = 20
#: Cells that come to the driver as one row of bytes.
_RUN = 4096
#: Bits (as a power of 2) of the filter that picks the texts to verify.
FILTER_LOG_BITS = 23


# ---------------------------------------------------------------- sets

class Sets:
    """The shingle sets of a block's rows."""

    def __init__(self, block: V.Block, k: int):
        w = V.words(block, V.NOT_SPACE, V.FOLDED)
        self.rows = block.rows
        self.row, self.h = V.shingle_sets(w, k)
        self.size = np.bincount(self.row, minlength=block.rows).astype(np.int64)
        self.name = V.mix(_sums(self.row, V.mix(self.h ^ np.uint64(0x5851F42D4C957F2D)), block.rows)
                          + self.size.astype(np.uint64)).view(np.int64)

    def sketches(self) -> list[bytes]:
        """Parity sketch of each set: bit h mod b of its hashes, b a power of two,
        two to four times the size."""
        bits = np.maximum(64, 2 << np.ceil(np.log2(np.maximum(self.size, 1))).astype(np.int64))
        at = np.concatenate([[0], np.cumsum(bits)])
        low = (self.h & (bits[self.row] - 1).astype(np.uint64)).astype(np.int64)
        odd = (np.bincount(at[self.row] + low, minlength=int(at[-1])) & 1).astype(np.uint8)
        packed = np.packbits(odd, bitorder="little").tobytes()
        edge = at // 8
        return [packed[edge[i]:edge[i + 1]] for i in range(self.rows)]


def _sums(slot: np.ndarray, values: np.ndarray, slots: int) -> np.ndarray:
    """Wrapping 64-bit sums by slot (two exact sums of 32-bit halves)."""
    low = np.bincount(slot, (values & np.uint64(0xFFFFFFFF)).astype(np.float64), slots).astype(np.uint64)
    high = np.bincount(slot, (values >> np.uint64(32)).astype(np.float64), slots).astype(np.uint64)
    return (high << np.uint64(32)) + low


def _cells(sig: np.ndarray) -> np.ndarray:
    return (sig >> np.uint64(64 - COUNT_LOG_CELLS)).astype(np.int64)


def signatures(sets: Sets, wanted: np.ndarray, scarce: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, row, place) of the wanted rows.  ``scarce``: the place in the order (0 to 4095) of each cell of signatures."""
    # A set that no larger set can link to links with equal ones only, which are one node already.
    signs = wanted & (sets.size * DEN // NUM > sets.size)
    prefix = np.where(signs, sets.size * (DEN - NUM) // DEN + 1, 0)
    use = np.flatnonzero(signs[sets.row])
    row, sig = sets.row[use], sets.h[use]
    # The order of signatures, scarce ones first, then by value; inside its row.
    order = np.argsort((scarce[_cells(sig)].astype(np.uint64) << np.uint64(52)) | (sig & np.uint64((1 << 52) - 1)))
    order = order[np.argsort(row[order], kind="stable")]
    row, sig = row[order], sig[order]
    held = np.bincount(row, minlength=sets.rows)
    place = np.arange(len(row)) - (np.cumsum(held) - held)[row]
    kept = place < prefix[row]
    return sig[kept].view(np.int64), row[kept], place[kept]


def document_sets(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """Per row: id, n (set size), node (the set's name), sketch."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block in V.blocks(b.column("_text")):
                s = Sets(block, k)
                yield pa.RecordBatch.from_arrays(
                    [b.column("_id").slice(block.first, block.rows), pa.array(s.size), pa.array(s.name),
                     pa.array(s.sketches(), pa.binary())], names=["_id", "n", "node", "sketch"])

    return _id_text(docs, id_col, text_col).mapInArrow(run, f"_id {id_type}, n long, node long, sketch binary")


def _id_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))


def signature_counts(docs: DataFrame, id_col: str, text_col: str, k: int) -> np.ndarray:
    """The order of signatures: for each cell of signature hashes its count over all sets, on a logarithmic scale of 0 to 4095.

    The table has a fixed size; in a full one a signature of many sets still stands out from the others of its cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        counts = np.zeros(1 << COUNT_LOG_CELLS, np.int64)
        for b in batches:
            for block in V.blocks(b.column("_text")):
                sets = Sets(block, k)
                counts += np.bincount(_cells(sets.h[_first_seen(sets.name, seen)[sets.row]]), minlength=len(counts))
        runs = counts.reshape(-1, _RUN)
        at = np.flatnonzero(runs.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array([runs[i].astype("<u4").tobytes() for i in at], pa.binary())],
                                         names=["run", "counts"])

    def scaled(parts: pd.DataFrame) -> pd.DataFrame:
        """The scaled sums of one run of cells as bytes."""
        total = np.zeros(_RUN, np.int64)
        for part in parts["counts"]:
            total += np.frombuffer(part, "<u4")
        return pd.DataFrame({"run": [parts["run"].iloc[0]], "scaled": [np.minimum(4095, 128 * np.log2(1.0 + total)).astype("<u2").tobytes()]})

    counts = _id_text(docs, id_col, text_col).mapInArrow(run, "run int, counts binary")
    runs = counts.groupBy("run").applyInPandas(scaled, "run int, scaled binary").collect()     # 2 MB in all
    table = np.zeros((1 << COUNT_LOG_CELLS) // _RUN * _RUN, "<u2").reshape(-1, _RUN)
    for r in runs:
        table[r["run"]] = np.frombuffer(r["scaled"], "<u2")
    return table.reshape(-1)


def signature_rows(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(sig, node, n, place) of every set; a task signs a set that it meets again once only."""
    scarce = docs.sparkSession.sparkContext.broadcast(signature_counts(docs, id_col, text_col, k))     # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            for block in V.blocks(b.column("_text")):
                s = Sets(block, k)
                sig, row, place = signatures(s, _first_seen(s.name, seen), scarce.value)
                yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(s.name[row]), pa.array(s.size[row]), pa.array(place)],
                                                 names=["sig", "node", "n", "place"])

    return _id_text(docs, id_col, text_col).mapInArrow(run, "sig long, node long, n long, place long")


def _first_seen(names: np.ndarray, seen: set[int], among: np.ndarray | None = None) -> np.ndarray:
    out = np.zeros(len(names), bool)
    for i in (range(len(names)) if among is None else np.flatnonzero(among)):
        x = int(names[i])
        if x not in seen:
            seen.add(x)
            out[i] = True
    return out


# ---------------------------------------------------------------- verification

def _sketch_distance(a: bytes, b: bytes) -> int:
    """Places in which two sketches differ, the longer one folded; the sets differ
    in at least as many features."""
    if len(a) > len(b):
        a, b = b, a
    x, y, bits = int.from_bytes(a, "little"), int.from_bytes(b, "little"), 8 * len(b)
    while bits > 8 * len(a):
        bits //= 2
        y = (y >> bits) ^ (y & ((1 << bits) - 1))
    return (x ^ y).bit_count()


def bounded_pairs(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes with their sizes and a lower bound of their difference."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = [_sketch_distance(x, y) for x, y in
                   zip(batch.column("asketch").to_pylist(), batch.column("bsketch").to_pylist(), strict=True)]
            kept = batch.select(["a", "b", "an", "bn"])
            far = np.maximum(np.array(far, np.int64), np.abs(kept.column(2).to_numpy() - kept.column(3).to_numpy()))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(far)], names=["a", "b", "an", "bn", "least"])

    side = lambda s: nodes.select(F.col("node").alias(s), F.col("n").alias(s + "n"), F.col("sketch").alias(s + "sketch"))
    return (pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "an", "bn", "asketch", "bsketch")
            .mapInArrow(run, "a long, b long, an long, bn long, least long"))


#: Whether a difference (or a lower bound of it) allows a link: 9 d <= a + b at 4/5.
_ALLOWED = f"least * {DEN + NUM} <= (an + bn) * {DEN - NUM}"


def node_texts(docs: DataFrame, id_col: str, text_col: str, k: int, wanted: DataFrame) -> DataFrame:
    """A text for each node in ``wanted``, once from each task that meets it: a fixed-size
    bit filter picks rows inside the scan, the exact match follows as a join."""
    bits = BitFilter(wanted, "node", FILTER_LOG_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            for block in V.blocks(b.column("_text")):
                s = Sets(block, k)
                keep = _first_seen(s.name, seen, bits.may_hold(s.name) & (s.size > 0))
                if keep.any():
                    at = np.flatnonzero(keep)
                    text = b.column("_text").slice(block.first, block.rows).take(pa.array(at))
                    yield pa.RecordBatch.from_arrays([pa.array(s.name[at]), text], names=["node", "text"])

    rows = _id_text(docs, id_col, text_col).select("_text").mapInArrow(run, "node long, text string")
    return rows.join(wanted, "node", "left_semi")


def exact_differences(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """(a, b, d, linked): the difference of the whole shingle sets, and whether
    100 * intersection >= 80 * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [_compare(batch.column("ta").slice(i, 64), batch.column("tb").slice(i, 64), k)
                     for i in range(0, batch.num_rows, 64)]
            if parts:
                ok, apart = (np.concatenate(x) for x in zip(*parts, strict=True))
                kept = batch.select(["a", "b"])
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(apart), pa.array(ok, pa.bool_())],
                                                 names=["a", "b", "d", "linked"])

    ta = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    tb = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    return pairs.join(ta, "a").join(tb, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long, d long, linked boolean")


def _compare(left: pa.Array, right: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether the texts of each row are linked, and how many shingles they differ in."""
    n = len(left)
    parts = []
    for col in (left, right):
        row, h = [], []
        for block in V.blocks(col):
            r, x = V.shingle_sets(V.words(block, V.NOT_SPACE, V.FOLDED), k)
            row.append(r + block.first)
            h.append(x)
        parts.append((np.concatenate(row), np.concatenate(h)))
    row = np.concatenate([parts[0][0], parts[1][0]])
    z = np.concatenate([parts[0][1], parts[1][1]]) ^ V.mix(row.astype(np.uint64) + np.uint64(1))
    order = np.argsort(z)
    same = z[order][1:] == z[order][:-1]
    common = np.bincount(row[order[1:][same]], minlength=n)
    union = np.bincount(row, minlength=n) - common
    return (DEN * common >= NUM * union) & (union > 0), (union - common).astype(np.int64)


# ---------------------------------------------------------------- components

def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each node's component, for nodes with
    links (alternating large-star and small-star steps)."""
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .filter("u <> v").distinct(), "edges")
    state = _checksum(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        edges, before = written(small, "edges"), state
        state = _checksum(edges)
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.hash("v", "u"))).first())


def _labelled(rows: DataFrame, labels: DataFrame, node: str, out: str) -> DataFrame:
    lab = labels.select(F.col("node").alias(node), F.col("label").alias(out))
    return rows.join(lab, node, "left").withColumn(out, F.coalesce(F.col(out), F.col(node)))


# ---------------------------------------------------------------- the join

class _Join:
    def __init__(self, docs: DataFrame, id_col: str, text_col: str, k: int):
        self.docs, self.id_col, self.text_col, self.k = docs, id_col, text_col, k
        self.rows = written(document_sets(docs, id_col, text_col, k), "sets")
        self.nodes = self.rows.filter("n > 0").groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
        self.texts: DataFrame | None = None
        self.links: DataFrame | None = None
        self.labels: DataFrame | None = None

    def differences(self, pairs: DataFrame) -> DataFrame:
        """Exact differences of the pairs, from whole texts."""
        wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        texts = self.texts.join(wanted, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))
        return written(exact_differences(pairs, texts, self.k), "differences")

    def likely(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b, least) whose sketches allow a link."""
        return written(bounded_pairs(pairs, self.nodes).filter(_ALLOWED).select("a", "b", "least"), "likely")

    def verify(self, likely: DataFrame) -> None:
        """Tests the pairs exactly and adds the links found."""
        if likely.isEmpty():
            return
        links = self.differences(likely).filter("linked").select("a", "b", "d")
        if links.isEmpty():
            return
        self.links = links if self.links is None else self.links.union(links)
        self.labels = written(components(self.links), "labels")

    def split(self, rows: DataFrame, left: str, right: str) -> DataFrame:
        """Rows whose two nodes are not in one component yet."""
        if self.labels is None:
            return rows
        rows = _labelled(_labelled(rows, self.labels, left, "_l"), self.labels, right, "_r")
        return rows.filter("_l <> _r").drop("_l", "_r")

    def run(self) -> None:
        sigs = signature_rows(self.docs, self.id_col, self.text_col, self.k)
        sigs = sigs.withColumn("room", (DEN + NUM) * (F.col("n") - F.col("place")) - NUM * F.col("n"))
        w = Window.partitionBy("sig")
        several = lambda rows: (rows.withColumn("_lo", F.min("node").over(w)).withColumn("_hi", F.max("node").over(w))
                                .filter("_lo <> _hi").drop("_lo", "_hi"))
        held = several(sigs.withColumn("_room", F.max("room").over(w)))
        # Holders that another's size and some room in the signature allow to link, if two are left.
        by_size = w.orderBy("n")
        other = F.when(F.row_number().over(by_size) == 1, F.lead("n").over(by_size)).otherwise(F.first("n").over(by_size))
        held = several(held.withColumn("_n", other).filter(f"room >= {NUM} * _n and _room >= {NUM} * n").drop("_n", "_room"))
        held = held.withColumn("centre", F.min(F.struct("place", "node", "n", "room")).over(w))
        held = written(held.select("sig", "node", "n", "room", "centre"), "held")
        # Only what holders need is read from here on.
        self.nodes = written(self.nodes.join(held.select("node").distinct(), "node", "left_semi"), "nodes")
        self.texts = written(node_texts(self.docs, self.id_col, self.text_col, self.k, self.nodes.select("node")), "texts")
        # First each holder's centres alone, and of those the closest one first: one pair a node joins most copies.
        near = held.filter("node <> centre.node").filter(_meet("room", "n", "centre.room", "centre.n"))
        likely = self.likely(near.select(F.col("node").alias("a"), F.col("centre.node").alias("b")).distinct())
        first = likely.groupBy("a").agg(F.min(F.struct("least", "b")).alias("m")).select("a", F.col("m.b").alias("b"))
        first = written(first, "pairs")
        self.verify(first)
        rest = written(self.split(likely.select("a", "b").join(first, ["a", "b"], "left_anti"), "a", "b"), "pairs")
        self.verify(rest)
        self.finish(held.drop("centre"))

    def finish(self, held: DataFrame) -> None:
        """Compares the components that still meet in a signature."""
        scale = DEN + NUM
        rows = held.withColumn("class", F.col("node")) if self.labels is None else _labelled(held, self.labels, "node", "class")
        rows = open_holders(rows.repartition("sig").distinct())
        if self.links is None:
            rows = rows.withColumn("hub", F.col("node")).withColumn("reach", F.col("n"))
        else:
            # A node's hub is the centre that it is closest to; a centre is its own.
            centres = self.links.select(F.col("b").alias("a")).distinct()
            best = (self.links.join(centres, "a", "left_anti").groupBy("a").agg(F.min(F.struct("d", "b")).alias("m"))
                    .select(F.col("a").alias("node"), F.col("m.b").alias("_hub"), F.col("m.d").alias("_d")))
            rows = (rows.join(best, "node", "left").withColumn("hub", F.coalesce("_hub", "node"))
                    .withColumn("reach", F.coalesce("_d", F.lit(0)) * scale + F.col("n")).drop("_hub", "_d"))
        rows = written(rows, "rows")
        if rows.isEmpty():
            return
        reach = rows.groupBy("hub").agg(F.max("reach").alias("reach"))
        met = rows.select("sig", "hub", "room", "n").repartition("sig").groupBy("sig", "hub").agg(F.max("room").alias("room"), F.min("n").alias("n"))
        met = written(met.withColumn("rank", F.row_number().over(Window.partitionBy("sig").orderBy("hub")))
                      .withColumn("of", F.count(F.lit(1)).over(Window.partitionBy("sig"))), "met")
        side = lambda c: reach.select(F.col("hub").alias(c), F.col("reach").alias(c + "_reach"))
        lo = 1
        while True:
            met = met.filter(F.col("of") > lo)
            if met.isEmpty():
                return
            centres = (met.filter(F.col("rank").between(lo, 4 * lo - 1))
                       .select("sig", F.col("hub").alias("_c"), F.col("rank").alias("_cr"), F.col("room").alias("_room"), F.col("n").alias("_n")))
            pairs = (met.join(centres, "sig").filter("rank > _cr").filter(_meet("room", "n", "_room", "_n"))
                     .select(F.greatest("hub", "_c").alias("a"), F.least("hub", "_c").alias("b")).distinct())
            # H(x, y) >= H(hub, hub') - d(x) - d(y): if 9 times that is over n(x) + n(y) for
            # all members, no member of one component links to one of the other.
            bounded = bounded_pairs(self.split(pairs, "a", "b").select("a", "b"), self.nodes).join(side("a"), "a").join(side("b"), "b")
            unclear = bounded.filter(F.col("least") * scale <= F.col("a_reach") + F.col("b_reach"))
            unclear = written(unclear.select("a", "b", "an", "bn", "least"), "unclear")
            lo *= 4
            if unclear.isEmpty():
                continue
            # The hubs themselves first: that joins most of what belongs together.
            self.verify(unclear.filter(_ALLOWED).select("a", "b"))
            hubs = written(self.split(unclear, "a", "b").select("a", "b", "least"), "hubs")
            if hubs.isEmpty():
                continue
            pairs = self.unclear_nodes(hubs, rows, met, reach)
            self.verify(self.likely(self.split(pairs, "a", "b").select("a", "b")).select("a", "b"))

    def unclear_nodes(self, hubs: DataFrame, rows: DataFrame, met: DataFrame, reach: DataFrame) -> DataFrame:
        """Pairs (a, b) of nodes that may still link, of the pairs (a, b, least) of hubs.

        Each node is first compared with the other hub, which makes one pair a node and hub: a link there joins the
        components, and H(x, y) >= H(x, hub') - d(y) rules most of the others out before nodes meet nodes."""
        scale = DEN + NUM
        both = hubs.union(hubs.select(F.col("b").alias("a"), F.col("a").alias("b"), "least"))
        beyond = reach.select(F.col("hub").alias("b"), F.col("reach").alias("b_reach"))
        members = rows.select("sig", F.col("hub").alias("a"), F.col("node").alias("x"), "n", "room", "reach")
        others = met.select("sig", F.col("hub").alias("b"), F.col("room").alias("_room"), F.col("n").alias("_n"))
        # Few hubs are unclear: only their holders are dealt by signature.
        members = members.join(both.select("a").distinct(), "a", "left_semi")
        others = others.join(both.select("b").distinct(), "b", "left_semi")
        near = (members.join(others, "sig").filter("a <> b").filter(_meet("room", "n", "_room", "_n"))
                .groupBy("a", "b", "x").agg(F.first("reach").alias("reach"))
                .join(both, ["a", "b"]).join(beyond, "b").filter(F.col("least") * scale <= F.col("reach") + F.col("b_reach"))
                .select(F.col("x").alias("a"), "b").distinct())
        far = bounded_pairs(near, self.nodes).join(beyond, "b").filter(F.col("least") * scale <= F.col("an") + F.col("b_reach"))
        far = written(far.select("a", "b", "an", "bn", "least"), "far")
        self.verify(far.join(hubs.select("a", "b").union(hubs.select("b", "a")), ["a", "b"], "left_anti").filter(_ALLOWED).select("a", "b"))
        far = self.split(far, "a", "b").select(F.col("a").alias("x"), F.col("b").alias("to"), "least")
        held = rows.select("sig", "hub", F.col("node").alias("x"), "reach", "n", "room").join(far, "x")
        held = held.join(others.withColumnRenamed("b", "to"), ["sig", "to"]).filter(_meet("room", "n", "_room", "_n"))
        left = held.filter("hub < to").select("sig", F.col("hub").alias("a"), F.col("to").alias("b"), "x", "n", "room", "reach", "least")
        right = held.filter("hub > to").select("sig", F.col("to").alias("a"), F.col("hub").alias("b"), F.col("x").alias("y"), F.col("n").alias("yn"),
                                               F.col("room").alias("y_room"), F.col("reach").alias("y_reach"), F.col("least").alias("y_least"))
        return (left.join(right, ["sig", "a", "b"]).filter(_meet("room", "n", "y_room", "yn"))
                .filter((F.col("least") * scale <= F.col("n") + F.col("y_reach")) & (F.col("y_least") * scale <= F.col("yn") + F.col("reach")))
                .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct())


def _meet(room: str, n: str, other_room: str, other_n: str) -> str:
    """Whether two holders of a signature can link if it is the first that they share."""
    return f"{room} >= {NUM} * {other_n} and {other_room} >= {NUM} * {n}"


def open_holders(rows: DataFrame) -> DataFrame:
    """The holders (sig, node, n, room) of signatures in which holders of two classes still meet."""
    w = Window.partitionBy("sig")
    rows = rows.withColumn("_lo", F.min("class").over(w)).withColumn("_hi", F.max("class").over(w))
    return rows.filter("_lo <> _hi").drop("_lo", "_hi", "class")


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS) -> DataFrame:
    """Per input row: the id, n_shingles, and component_id, the smallest id that
    links lead to (each row's own included)."""
    rows = _classes(docs, id_col, text_col, k)
    full = rows.filter("n > 0")
    least = full.groupBy("class").agg(F.min("_id").alias("component_id"))
    return (full.join(least, "class").unionByName(rows.filter("n = 0").withColumn("component_id", F.col("_id")))
            .select(F.col("_id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), "component_id"))


def _classes(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """Per input row: _id, n, node, class (the smallest node of its component)."""
    join = _Join(docs, id_col, text_col, k)
    join.run()
    rows = join.rows.select("_id", "n", "node")
    if join.labels is None:
        return rows.withColumn("class", F.col("node"))
    return _labelled(rows, join.labels, "node", "class")


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS) -> DataFrame:
    """The input rows without near copies: of each class the row with the smallest
    id stays (no id comes last; equal rows count as one).  Rows without words all
    stay.  Rows alone in their class pass without a shuffle; a bit filter tells
    the others, whose texts are then matched exactly."""
    rows = written(_classes(docs, id_col, text_col, k), "classes")
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("node").alias("node")))
    groups = (rows.filter("n > 0").groupBy("class").agg(first.alias("keep"), F.count(F.lit(1)).alias("rows"))
              .filter("rows > 1"))
    groups = written(groups, "groups")
    shared = rows.join(groups.select("class"), "class", "left_semi").select("node").distinct()
    bits = BitFilter(shared, "node", FILTER_LOG_BITS)
    cols = docs.columns
    place = cols.index(text_col)

    def split(alone: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for block in V.blocks(b.column(place)):
                    s = Sets(block, k)
                    near = bits.may_hold(s.name) & (s.size > 0)
                    at = np.flatnonzero(~near if alone else near)
                    if len(at):
                        part = b.slice(block.first, block.rows).take(pa.array(at))
                        yield part if alone else pa.RecordBatch.from_arrays(
                            [*part.columns, pa.array(s.name[at])], names=[*b.schema.names, "_node"])
        return run

    if len(set(cols)) < len(cols):
        raise ValueError("column names must be unique")
    alone = docs.mapInArrow(split(True), docs.schema)
    near = docs.mapInArrow(split(False), T.StructType([*docs.schema.fields, T.StructField("_node", T.LongType())]))
    keep = groups.select(F.col("keep.node").alias("_node"), F.col("keep.id").alias("_keep"), F.lit(True).alias("_winner"))
    near = near.join(shared.select(F.col("node").alias("_node"), F.lit(True).alias("_shared")), "_node", "left")
    near = near.join(keep, "_node", "left").filter(
        F.col("_shared").isNull() | (F.col("_winner") & F.col(id_col).eqNullSafe(F.col("_keep"))))
    turn = Window.partitionBy("_node", "_shared").orderBy(F.xxhash64(text_col))
    near = near.withColumn("_rn", F.when(F.col("_shared").isNotNull(), F.row_number().over(turn)).otherwise(1)).filter("_rn = 1")
    return alone.unionByName(near.select(*cols))
