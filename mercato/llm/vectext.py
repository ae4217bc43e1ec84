"""Words, shingles and lines of whole texts as numpy arrays over UTF-8 bytes.

An Arrow string column already holds its texts as one byte buffer with
offsets.  These helpers cut that buffer into blocks of whole rows (a long text
is one block, never a prefix) and find words and their 64-bit hashes with
array operations, so no Python object is made per word.

A word's hash is a polynomial over a table of random byte values: with the
prefix sums C of ``value[byte] * P**i`` a word at [a, b) hashes to
``(C[b] - C[a]) * P**-a``.  Shingle hashes combine the word hashes the same
way.  All tables come from a fixed seed, so every task hashes alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 19
_P = 0x9E3779B97F4A7C15 | 1
_Q = np.uint64(0xC2B2AE3D27D4EB4F)
_MASK = (1 << 64) - 1


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer: spreads every input bit over all 64 output bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_P))


EXACT = _byte_values()
#: A-Z hash as a-z.
FOLDED = EXACT.copy()
FOLDED[65:91] = FOLDED[97:123]

_bytes = np.arange(256)
#: Words `[^\x20\x09-\x0D]+`: everything but ASCII white space.
NOT_SPACE = ~((_bytes == 32) | ((_bytes >= 9) & (_bytes <= 13)))
#: Words of digits, ASCII letters and all non-ASCII characters.
ALNUM = (((_bytes >= 48) & (_bytes <= 57)) | ((_bytes >= 65) & (_bytes <= 90))
         | ((_bytes >= 97) & (_bytes <= 122)) | (_bytes >= 128))

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]), BLOCK_BYTES + 1)
        for k, base in enumerate((_P, pow(_P, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


@dataclass
class Block:
    """Whole rows [first, first + len(offsets) - 1) of a column."""
    first: int
    data: np.ndarray      # uint8
    offsets: np.ndarray   # int64, byte offsets of the rows in data

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def blocks(column: pa.Array, max_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a string column (null: empty text) into blocks of whole rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if column.type != pa.large_string():
        column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return
    _, off_buf, data_buf = column.buffers()
    offs = np.frombuffer(off_buf, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data_buf, np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + max_bytes, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield Block(lo, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
        lo = hi


@dataclass
class Words:
    start: np.ndarray   # byte offset in the block
    end: np.ndarray
    row: np.ndarray     # row in the block
    first: np.ndarray   # first word of each row, rows + 1 entries
    hash: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, values: np.ndarray = EXACT) -> np.ndarray:
    """Hash of each byte span [start, end)."""
    pw, inv = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * pw[:-1], out=sums[1:])
    return mix((sums[end] - sums[start]) * inv[start] + (end - start).astype(np.uint64))


def words(block: Block, is_word: np.ndarray = NOT_SPACE, values: np.ndarray = EXACT) -> Words:
    """Words of every row; none reaches over a row's end."""
    data, offs = block.data, block.offsets
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = is_word[data]
    begin = inside[1:-1] & ~inside[:-2]
    stop = inside[1:-1] & ~inside[2:]
    edges = offs[(offs > 0) & (offs < n)]
    begin[edges] |= inside[1:-1][edges]
    stop[edges - 1] |= inside[1:-1][edges - 1]
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    first = np.searchsorted(start, offs, "left")
    first[-1] = len(start)
    row = np.repeat(np.arange(block.rows), np.diff(first))
    return Words(start, end, row, first, span_hashes(data, start, end, values))


def grams(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of every run of k words inside one row."""
    n = len(w.start) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * _Q + w.hash[j:j + n]
    pos = np.flatnonzero(w.row[:n] == w.row[k - 1:])
    return pos, mix(h[pos])


def shingle_sets(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of every row as (row, hash) in row order.
    A row with 1 to k - 1 words has one shingle, its whole sequence."""
    pos, h = grams(w, k)
    row = w.row[pos]
    n = w.counts()
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        hs = np.zeros(len(short), np.uint64)
        for j in range(k - 1):
            have = n[short] > j
            at = np.minimum(w.first[short] + j, len(w.hash) - 1)
            hs = np.where(have, hs * _Q + w.hash[at], hs)
        row, h = np.concatenate([row, short]), np.concatenate([h, mix(hs + n[short].astype(np.uint64))])
        order = np.argsort(row, kind="stable")
        row, h = row[order], h[order]
    return _distinct(row, h)


def _distinct(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Drops repeats of a hash inside its row; the rest keep their order."""
    if len(h) < 2:
        return row, h
    z = h ^ mix(row.astype(np.uint64) + np.uint64(1))
    order = np.argsort(z)
    z = z[order]
    keep = np.ones(len(h), bool)
    keep[order[1:][z[1:] == z[:-1]]] = False
    return row[keep], h[keep]


def run_lengths(sorted_keys: np.ndarray) -> np.ndarray:
    """For each element of a sorted array, how often its value occurs."""
    n = len(sorted_keys)
    if n == 0:
        return np.zeros(0, np.int64)
    edge = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
    size = np.diff(np.concatenate([edge, [n]]))
    return np.repeat(size, size)


def repeated(row: np.ndarray, h: np.ndarray) -> np.ndarray:
    """True where a hash occurs twice or more inside its row."""
    z = h ^ mix(row.astype(np.uint64) + np.uint64(1))
    order = np.argsort(z)
    out = np.zeros(len(h), bool)
    out[order] = run_lengths(z[order]) > 1
    return out


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over each row's [offset, next offset)."""
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]
