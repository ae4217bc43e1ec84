"""Best-fit packing by patterns from non-negative least squares (operator 7).

Documents are tokenized, closed with an end id, and cut into pieces of at most
``length`` ids (only longer ones are cut).  The histogram of piece lengths has at
most ``length`` entries, whatever the corpus; the plan is made from it alone:

1. Lengths are grouped in buckets of BUCKET ids.  All patterns of two or three
   pieces whose bucket sizes fill a sequence are listed, and their repeat
   counts are fitted to the bucket histogram by non-negative least squares.
2. Counts are rounded down, and the buckets' lengths are dealt to the patterns,
   long against short.  Short pieces (up to FILLER ids) are kept back.
3. Residual pieces are packed best-fit, longest first, into the space that the
   patterns leave and into new sequences.  Pattern sequences that are filled badly
   are taken apart first where that makes fewer sequences.

The plan is a table of (length, first rank, sequences, offset); pieces of one
length are interchangeable, so each piece finds its place by its rank among the
pieces of its length.  The ranks are counted in salted shares.

Defined results.  Null or empty text: one piece holding the end id alone.
Repeated rows are separate documents.  A very long text is cut into as many
pieces as it needs.  Null ids are kept.  An empty table gives an empty result.
Columns other than the id and the text are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm.shared import numbered, written

SEQUENCE_IDS = 2048
END_ID = 0
BUCKET = 8
#: Pieces up to this many ids stay out of the patterns: they fill gaps.
FILLER = 400
#: Pieces a share of one length's ranking holds about.
SHARE_ROWS = 200_000
CACHE_WORDS = 300_000

#: What the tokenizer's own rules do to these characters is known exactly:
#: lower case, then words, single digits and runs of signs.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-įı-ſ]*")
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^\sa-z0-9ß-öø-ſ]+")


def _byte_signs() -> dict[int, str]:
    """The sign that a byte-level vocabulary writes for each byte: printable ones as they are, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


class Encoder:
    """Token ids of whole texts as little-endian 32-bit bytes.

    The tokenizer merges inside words only, so what stands between white space is
    encoded once and kept, as are the words in it.  When CACHE_WORDS are kept they
    become the older half: what is met again moves to the new one, the rest goes.
    Texts with characters outside Latin scripts go through the tokenizer whole.
    """

    _SIGNS = _byte_signs()

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(path)
        self._tok.encode_special_tokens = True
        self._merge = self._tok.model.tokenize
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def __call__(self, text: str) -> bytes:
        if _PLAIN.fullmatch(text) is None:
            return np.array(self._tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        chunks = text.lower().split()
        known = self._known
        try:
            return b"".join(map(known.__getitem__, chunks))
        except KeyError:
            if len(known) > CACHE_WORDS:
                self._older, self._known = known, {}
                known = self._known
            for c in chunks:
                if c not in known:
                    known[c] = self._older.get(c) or (self._word(c) if c.isalpha() else self._parts(c))
            return b"".join(map(known.__getitem__, chunks))

    def _parts(self, chunk: str) -> bytes:
        out, known = [], self._known
        for w in _PIECE.findall(chunk):
            ids = known.get(w)
            if ids is None:
                ids = known[w] = self._older.get(w) or self._word(w)
            out.append(ids)
        return b"".join(out)

    def _word(self, word: str) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self._SIGNS)
        ids = [t.id for t in self._merge(word)]
        return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
           length: int = SEQUENCE_IDS, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every piece of every row."""
    end = np.array([end_id], "<u4").tobytes()
    fields = [T.StructField(id_col, docs.schema[id_col].dataType)] + [
        T.StructField(n, T.IntegerType() if n == "piece" else T.LongType()) for n in ("piece", "start", "length", "ids_crc32")]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                at, out = [], []
                for i, text in enumerate(part.column("_text").to_pylist()):
                    ids = encode(text or "") + end
                    for k in range(0, len(ids), 4 * length):
                        piece = ids[k:k + 4 * length]
                        at.append(i)
                        out.append((k // (4 * length), k // 4, len(piece) // 4, zlib.crc32(piece), piece))
                cols = list(zip(*out, strict=True))
                arrays = [part.column("_id").take(pa.array(at)), pa.array(cols[0], pa.int32()),
                          *[pa.array(c, pa.int64()) for c in cols[1:4]]]
                if with_ids:
                    arrays.append(pa.array(cols[4], pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in fields])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(run, T.StructType(fields))


# ---------------------------------------------------------------- the plan

def nnls(a: np.ndarray, b: np.ndarray, most: int = 2000) -> np.ndarray:
    """min |a x - b| over x >= 0 by an active set of columns."""
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, bool)
    target = a.T @ b
    tol = 1e-9 * max(1.0, float(np.abs(target).max(initial=0)))
    for _ in range(most):
        slope = a.T @ (b - a @ x)
        slope[active] = -np.inf
        j = int(slope.argmax()) if n else 0
        if not n or slope[j] <= tol:
            break
        active[j] = True
        while True:
            at = np.flatnonzero(active)
            part = a[:, at].T @ a[:, at]
            z = np.linalg.solve(part + 1e-9 * np.trace(part) / len(at) * np.eye(len(at)), target[at])
            if (z > 0).all():
                x[:] = 0
                x[at] = z
                break
            low = z <= 0
            step = np.min(x[at][low] / np.maximum(x[at][low] - z[low], 1e-300))
            x[at] = x[at] + step * (z - x[at])
            gone = at[low & (x[at] <= 1e-12)]
            if not len(gone):
                gone = at[low][:1]
            x[gone] = 0
            active[gone] = False
            if not active.any():
                break
    return x


def patterns(buckets: int) -> list[tuple[int, ...]]:
    """Bucket sizes of two or three pieces that together fill a sequence, largest first."""
    out = [(a, buckets - a) for a in range((buckets + 1) // 2, buckets)]
    for a in range((buckets + 2) // 3, buckets - 1):
        for b in range((buckets - a + 1) // 2, min(a, buckets - a - 1) + 1):
            out.append((a, b, buckets - a - b))
    return out


def fit(hist: np.ndarray, length: int, bucket: int, filler: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of piece lengths with their repeat counts, from the histogram
    ``hist`` (index: length), which is lowered by what they use."""
    n = length // bucket
    sizes = np.arange(length + 1)
    by_bucket = np.bincount(-(-sizes // bucket), np.where(sizes > filler, hist, 0), n + 1)[:n + 1]
    have = by_bucket > 0
    listed = [p for p in patterns(n) if all(have[i] for i in p)]
    if not listed:
        return []
    a = np.zeros((n + 1, len(listed)))
    for j, p in enumerate(listed):
        for i in p:
            a[i, j] += 1
    # Long pieces are the hard ones to place.
    weight = np.sqrt(np.arange(n + 1) / n)
    x = nnls(a * weight[:, None], by_bucket * weight)
    out: dict[tuple[int, ...], int] = {}
    stock = {i: [[int(s), int(hist[s])] for s in sizes[(i - 1) * bucket + 1:i * bucket + 1] if s > filler and hist[s]]
             for i in range(1, n + 1)}
    left = by_bucket.astype(np.int64)
    for j in np.argsort(-x, kind="stable"):
        count, p = int(x[j]), listed[j]
        for i in set(p):
            count = min(count, int(left[i]) // p.count(i))
        if count <= 0:
            continue
        runs = []
        for turn, i in enumerate(p):
            left[i] -= count
            runs.append(_take(stock[i], count, longest=turn == 0))
        for parts, c in _aligned(runs):
            out[parts] = out.get(parts, 0) + c
    hist[filler + 1:n * bucket + 1] = 0
    for entries in stock.values():
        for s, c in entries:
            hist[s] = c
    return list(out.items())


def _take(stock: list[list[int]], count: int, longest: bool) -> list[tuple[int, int]]:
    """(length, count) runs of ``count`` pieces out of the stock of a bucket."""
    out = []
    while count:
        entry = stock[-1 if longest else 0]
        c = min(count, entry[1])
        out.append((entry[0], c))
        entry[1] -= c
        count -= c
        if not entry[1]:
            stock.remove(entry)
    return out


def _aligned(runs: list[list[tuple[int, int]]]) -> Iterator[tuple[tuple[int, ...], int]]:
    """Runs of equal total count, cut where any of them changes its length."""
    at = [0] * len(runs)
    left = [r[0][1] for r in runs]
    while True:
        c = min(left)
        yield tuple(sorted((r[k][0] for r, k in zip(runs, at, strict=True)), reverse=True)), c
        for i, r in enumerate(runs):
            left[i] -= c
            if not left[i]:
                at[i] += 1
                if at[i] == len(r):
                    return
                left[i] = r[at[i]][1]


def best_fit(hist: np.ndarray, length: int, opened: list[tuple[tuple[int, ...], int]]) -> list[tuple[tuple[int, ...], int]]:
    """Packs the histogram's pieces, longest first, each into the fullest sequence
    that it fits in; counts of equal sequences move together."""
    space: list[dict[tuple[int, ...], int]] = [{} for _ in range(length + 1)]

    def put(parts: tuple[int, ...], count: int) -> None:
        free = space[length - sum(parts)]
        free[parts] = free.get(parts, 0) + count

    for parts, count in opened:
        put(parts, count)
    for size in range(length, 0, -1):
        todo, room = int(hist[size]), size
        while todo:
            while room <= length and not space[room]:
                room += 1
            if room > length:
                each = length // size
                full, rest = divmod(todo, each)
                if full:
                    put((size,) * each, full)
                if rest:
                    put((size,) * rest, 1)
                break
            parts, count = space[room].popitem()
            # As many pieces as fit go into one sequence before the next is touched.
            each = room // size
            full = min(count, todo // each)
            if full:
                put(parts + (size,) * each, full)
                todo -= full * each
                count -= full
            if count and todo and todo < each:
                put(parts + (size,) * todo, 1)
                todo, count = 0, count - 1
            if count:
                put(parts, count)
    return [(p, c) for free in space for p, c in free.items()]


#: Free ids up to which a pattern's sequences stay closed to the residual step, in the order tried; -1 opens all.
REOPENED = (SEQUENCE_IDS, 8, 2, 0, -1)


def plan(hist: np.ndarray, length: int = SEQUENCE_IDS, bucket: int = BUCKET,
         filler: int = FILLER) -> list[tuple[tuple[int, ...], int]]:
    """(piece lengths, repeat count) of all sequences; ``hist[n]`` pieces have n ids.

    The worst-filled pattern sequences are taken apart and packed with the residual
    pieces where that saves sequences, so there are never more than best-fit makes by itself."""
    rest = hist.astype(np.int64).copy()
    least = -(-int(np.arange(length + 1) @ hist) // length)
    opened = fit(rest, length, bucket, filler)
    best, fewest = [], None
    for free in REOPENED:
        left, kept = rest.copy(), []
        for parts, count in opened:
            if length - sum(parts) <= free:
                kept.append((parts, count))
            else:
                np.add.at(left, list(parts), count)
        packed = best_fit(left, length, kept)
        n = sum(count for _, count in packed)
        if fewest is None or n < fewest:
            best, fewest = packed, n
        if fewest == least:
            break
    return best


def places(sequences: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys length * 2**40 + first rank, with the sequence and offset of that rank."""
    used: dict[int, int] = {}
    rows, first = [], 0
    for parts, count in sequences:
        offset = 0
        for size in parts:
            rows.append((size * (1 << 40) + used.get(size, 0), first, offset))
            used[size] = used.get(size, 0) + count
            offset += size
        first += count
    rows.sort()
    key, seq, off = (np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else (np.zeros(0, np.int64),) * 3
    return key, seq, off


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         length: int = SEQUENCE_IDS, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """The pieces with sequence_id and offset."""
    cut = written(pieces(docs, tokenizer, id_col, text_col, length, end_id, with_ids), "pieces")
    hist = np.zeros(length + 1, np.int64)
    for size, count in cut.groupBy("length").agg(F.count(F.lit(1))).collect():     # at most ``length`` rows
        hist[size] = count
    table = cut.sparkSession.sparkContext.broadcast(places(plan(hist, length)))
    shares = max(1, -(-int(hist.max()) // SHARE_ROWS))
    ranked = numbered(cut, ["length"], [F.col(id_col), F.col("piece"), F.col("ids_crc32")], "_rank",
                      F.xxhash64(F.col(id_col), F.col("piece")), shares)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, seq, off = table.value
        for b in batches:
            if not b.num_rows:
                continue
            own = b.column("length").to_numpy() * (1 << 40) + b.column("_rank").to_numpy()
            at = np.searchsorted(key, own, "right") - 1
            kept = b.select([n for n in b.schema.names if n != "_rank"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(seq[at] + own - key[at]), pa.array(off[at])],
                                             names=[*kept.schema.names, "sequence_id", "offset"])

    return ranked.mapInArrow(run, T.StructType([f for f in cut.schema.fields] + [
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))
