"""Records of text files that run over line ends, read by all tasks.

Spark splits a text file into blocks at line ends, but a quoted field may hold a
line end, so a block may begin inside a record.  Three steps find the records
without reading a file in one piece:

1. every block tells, for both states it may begin in (between records, inside
   one), how it would end and how many records it would hold;
2. one row per block, the states are carried from a file's first block to its
   last, which fixes the state every block begins in and the number of its
   first record;
3. every block is read at its true start.  Records inside a block are parsed
   there; pieces of records that cross block ends are joined by record number.

The table of step 2 has some 50 bytes for each block of ``maxPartitionBytes``,
so it is broadcast.  Only step 3's pieces are shuffled.  Record texts are exact:
line feeds, CR LF and CR each end a line and stay as they are inside a record.
"""

from __future__ import annotations

import csv
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.session import checkpoint_dir

_BLOCK_ROWS = 2000


# windows-1252 leaves five bytes undefined; they stay control characters.
_CP1252 = {b: bytes([b]).decode("cp1252") for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore")}
_MARK = b"\xef\xbb\xbf"


def decoded(raw: bytes, encoding: str) -> str:
    if encoding == "windows-1252":
        return raw.decode("latin-1").translate(_CP1252)
    return raw.decode(encoding, "replace")


# ------------------------------------------------------------------ what ends a record

@dataclass(frozen=True)
class Delimited:
    """Quoted fields may hold separators, line ends and doubled quotes; a quote inside an unquoted field is text."""
    sep: str = ","
    encoding: str = "utf-8"

    def decode(self, raw: bytes) -> str:
        return decoded(raw, self.encoding)

    def step(self, line: bytes, inside: bool) -> tuple[bool, bool]:
        """(whether the line's end is inside a quoted field, whether it holds more than blanks)."""
        sep, at = self.sep.encode(), 0
        if b'"' not in line:
            return inside, bool(self.decode(line if inside else line.replace(sep, b"")).strip())
        content = False
        while True:
            if not inside:
                if line[at:at + 1] == b'"':
                    at += 1
                else:
                    end = line.find(sep, at)
                    content = content or bool(self.decode(line[at:end if end >= 0 else len(line)]).strip())
                    if end < 0:
                        return False, content
                    at = end + 1
                    continue
            inside = False
            close = line.find(b'"', at)
            content = content or bool(self.decode(line[at:close if close >= 0 else len(line)]).strip())
            if close < 0:
                return True, content
            if line[close + 1:close + 2] == b'"':
                content, inside, at = True, True, close + 2
                continue
            end = line.find(sep, close + 1)
            content = content or bool(self.decode(line[close + 1:end if end >= 0 else len(line)]).strip())
            if end < 0:
                return False, content
            at = end + 1

    def cells(self, record: bytes) -> list[str]:
        csv.field_size_limit(sys.maxsize)
        rows = list(csv.reader(_lines(self.decode(record)), delimiter=self.sep))
        return rows[0] if rows else []


@dataclass(frozen=True)
class Paragraphs:
    """A record is a run of lines that are not blank."""
    encoding: str = "utf-8"

    def step(self, line: bytes, inside: bool) -> tuple[bool, bool]:
        full = bool(decoded(line, self.encoding).strip())
        return full, full

    def cells(self, record: bytes) -> list[str]:
        return [decoded(record, self.encoding).strip()]


Rule = Delimited | Paragraphs
_TEXT_LINE = re.compile(r"[^\r\n]*(?:\r\n|\r|\n)?")


def _lines(text: str) -> list[str]:
    return [x for x in _TEXT_LINE.findall(text) if x]


def _pieces(value: bytes) -> list[tuple[bytes, bytes]]:
    """The lines of a text up to a line feed, each with the bytes that end it: a CR alone ends a line too."""
    if b"\r" not in value:
        return [(value, b"\n")]
    parts = value.split(b"\r")
    if parts[-1] == b"":
        return [*((p, b"\r") for p in parts[:-2]), (parts[-2], b"\r\n")]
    return [*((p, b"\r") for p in parts[:-1]), (parts[-1], b"\n")]


def _begun(first: bytes, block: int) -> bytes:
    """The first line of a block; a byte-order mark at a file's start is no text."""
    return first.removeprefix(_MARK) if block == 0 else first


# ------------------------------------------------------------------ step 1

class _Walk:
    """A block read from one of its two possible states.

    ``lead``: the rest of a record begun before the block: (ended here, holds content); ``full``: records with content that begin
    and end here; ``open``: a record begun here is not ended, and whether it holds content so far."""

    def __init__(self, inside: bool):
        self.inside = self.leading = inside
        self.lead_content = self.content = False
        self.full = 0

    def feed(self, rule: Rule, line: bytes) -> None:
        self.inside, some = rule.step(line, self.inside)
        self.content |= some
        if self.leading:
            self.lead_content = self.content
        if not self.inside:
            if not self.leading:
                self.full += self.content
            self.leading = self.content = False

    def told(self) -> dict:
        return {"closes": not self.leading, "lead": self.lead_content, "full": self.full, "open": self.inside and not self.leading,
                "content": self.content and not self.leading}


_TOLD = "closes boolean, lead boolean, full long, open boolean, content boolean"
_SUMMARY = f"file string, block long, outside struct<{_TOLD.replace(' ', ':').replace(',:', ',')}>, inside struct<{_TOLD.replace(' ', ':').replace(',:', ',')}>"


def _summaries(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walks: dict[tuple[str, int], tuple[_Walk, _Walk]] = {}
        for b in batches:
            for value, file, block in zip(*(b.column(c).to_pylist() for c in ("value", "file", "block"))):
                both = walks.get((file, block))
                if both is None:
                    both = walks[file, block] = (_Walk(False), _Walk(True))
                    value = _begun(value, block)
                for line, _ in _pieces(value):
                    for w in both:
                        w.feed(rule, line)
        if walks:
            yield pa.RecordBatch.from_arrays(
                [pa.array([f for f, _ in walks], pa.string()), pa.array([k for _, k in walks], pa.int64()),
                 *[pa.array([w[h].told() for w in walks.values()], _STRUCT) for h in (0, 1)]], names=["file", "block", "outside", "inside"])
    return run


_STRUCT = pa.struct([("closes", pa.bool_()), ("lead", pa.bool_()), ("full", pa.int64()), ("open", pa.bool_()), ("content", pa.bool_())])


# ------------------------------------------------------------------ step 2

_STATES = "file string, block long, starts_inside boolean, lead_no long, first_no long, open_no long, records long"
STATE_COLUMNS = [c.split()[0] for c in _STATES.split(", ")]


def _carried(blocks: pd.DataFrame) -> pd.DataFrame:
    """The states of one file's blocks.  A record's number counts the records with content before it in the file; a record
    without any has none."""
    out, waiting, inside, content, count = [], [], False, False, 0

    def end_open() -> int:
        number = count if content else None
        for row, field in waiting:
            row[field] = number
        waiting.clear()
        return count + content

    blocks = blocks.sort_values("block")
    for block, outside_told, inside_told in zip(blocks["block"], blocks["outside"], blocks["inside"]):
        told = inside_told if inside else outside_told
        row = {"file": blocks["file"].iloc[0], "block": block, "starts_inside": inside, "lead_no": None, "first_no": None, "open_no": None}
        out.append(row)
        if inside:
            waiting.append((row, "lead_no"))
            content |= told["lead"]
            if not told["closes"]:
                continue
            count = end_open()
        row["first_no"] = count
        count += told["full"]
        inside, content = told["open"], told["content"]
        if inside:
            waiting.append((row, "open_no"))
    if inside:
        count = end_open()
    states = pd.DataFrame(out)
    for c in ("lead_no", "first_no", "open_no"):
        states[c] = states[c].astype("Int64")
    return states.assign(records=count)


# ------------------------------------------------------------------ step 3

_FOUND = "file string, number long, block long, cells array<string>, piece binary"


def _found(rule: Rule, whole: bool):
    """Cells of the records that lie in a block, or (not ``whole``) pieces of those that cross its ends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, state, out = None, {}, []

        def leave():
            if here is not None and not whole and state["buffer"]:
                number = state["lead_no"] if state["leading"] else state["open_no"]
                if number is not None:
                    out.append((here[0], number, here[1], None, b"".join(state["buffer"])))

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.binary()))],
                                              names=["file", "number", "block", "cells", "piece"])

        for b in batches:
            for value, file, block, inside, lead_no, first_no, open_no in zip(*(b.column(c).to_pylist() for c in (
                    "value", "file", "block", "starts_inside", "lead_no", "first_no", "open_no"))):
                if here != (file, block):
                    leave()
                    here, value = (file, block), _begun(value, block)
                    state = {"inside": inside, "leading": inside, "buffer": [], "content": False, "lead_no": lead_no, "next": first_no, "open_no": open_no}
                for line, end in _pieces(value):
                    state["inside"], some = rule.step(line, state["inside"])
                    state["content"] |= some
                    state["buffer"].append(line)
                    if state["inside"]:
                        state["buffer"].append(end)
                        continue
                    record = b"".join(state["buffer"])
                    if state["leading"]:
                        if not whole and lead_no is not None:
                            out.append((file, lead_no, block, None, record))
                    elif state["content"]:
                        if whole:
                            out.append((file, state["next"], block, rule.cells(record), None))
                        state["next"] += 1
                    state["leading"], state["buffer"], state["content"] = False, [], False
                if len(out) >= _BLOCK_ROWS:
                    yield batch_of(out)
                    out.clear()
        leave()
        if out:
            yield batch_of(out)
    return run


def _parsed(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells = [rule.cells(r) for r in b.column("record").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("file"), b.column("number"), pa.array(cells, pa.list_(pa.string()))], names=["file", "number", "cells"])
    return run


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, block): the lines of a path as bytes, in the order of their block within a task.

    The lines of a block come from one task, in order; what follows must not shuffle them."""
    raw = spark.read.option("lineSep", "\n").text(path)
    return raw.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


@dataclass
class Records:
    """The records of the files under ``path``, numbered from 0 in their files; records of nothing but blanks are left out."""
    lines: DataFrame
    rule: Rule
    states: DataFrame        # one row a block

    @property
    def files(self) -> DataFrame:
        """(file, records)"""
        return self.states.groupBy("file").agg(F.max("records").alias("records"))

    def first_blocks(self) -> DataFrame:
        """The blocks that hold a part of their file's first record."""
        return self.states.filter("first_no = 0 OR lead_no = 0 OR open_no = 0")

    def rows(self, of: DataFrame | None = None) -> DataFrame:
        """(file, number, cells) of the records in the blocks ``of``, all by default."""
        of = (self.states if of is None else of).select(*STATE_COLUMNS)
        keys = ["file", "block"]
        # One row a block; the join must not move the lines.
        whole = self.lines.join(F.broadcast(of), keys).mapInArrow(_found(self.rule, True), _FOUND).select("file", "number", "cells")
        crossing = of.filter("lead_no IS NOT NULL OR open_no IS NOT NULL")
        pieces = self.lines.join(F.broadcast(crossing), keys).mapInArrow(_found(self.rule, False), _FOUND)
        parts = F.array_sort(F.collect_list(F.struct("block", "piece")))
        joined = F.aggregate(F.transform(parts, lambda x: x["piece"]), F.lit(b""), lambda all_, piece: F.concat(all_, piece))
        crossed = pieces.groupBy("file", "number").agg(joined.alias("record"))
        return whole.unionByName(crossed.mapInArrow(_parsed(self.rule), "file string, number long, cells array<string>"))


def read_records(spark: SparkSession, path: str, rule: Rule) -> Records:
    """Finds the records.  The states, some 50 bytes a block, are written to the shared folder: all readers of the records use the same."""
    lines = text_lines(spark, path)
    states = lines.mapInArrow(_summaries(rule), _SUMMARY).groupBy("file").applyInPandas(_carried, _STATES)
    checkpoint_dir(spark)
    return Records(lines, rule, states.checkpoint())


def read_utf16_records(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """(file, number, cells) of UTF-16 files.  Their line ends cannot be told from the middle of a character at a block's
    edge, so each file is one row, of 2 GB at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(sys.maxsize)
        for b in batches:
            for file, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                rows = [r for r in csv.reader(_lines(content.decode("utf-16")), delimiter=sep) if any(c.strip() for c in r)]
                yield pa.RecordBatch.from_arrays([pa.array([file] * len(rows), pa.string()), pa.array(range(len(rows)), pa.int64()),
                                                  pa.array(rows, pa.list_(pa.string()))], names=["file", "number", "cells"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "file string, number long, cells array<string>")
