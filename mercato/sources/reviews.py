"""Review file readers and shaping.

Every reader returns an all-string DataFrame plus a source sequence column
``row_id`` (file order) so the review operators can sort "as imported".
"""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from itertools import chain, count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.operators.ranks import global_row_number, running_sum
from mercato.sources.records import Delimited, Paragraphs, read_records, read_utf16_records

# Accepted delimiters and encodings, envelope keys, role candidates.
DELIMITERS = [",", ";", "\t", "|"]
ENCODINGS = {"utf-8-sig": "UTF-8", "utf-8": "UTF-8", "utf-16": "UTF-16", "cp1252": "windows-1252",
             "latin-1": "ISO-8859-1"}
ENVELOPE_KEYS = ["reviews", "avis", "data", "records"]
TEXT_CANDIDATES = ["review_comment_message", "commentaire", "comment", "review", "text", "texte", "avis",
                   "message", "content", "review_text", "comentario"]
TITLE_CANDIDATES = ["review_comment_title", "titre", "title"]
RATING_CANDIDATES = ["review_score", "rating", "score", "note", "stars", "etoiles"]


def header_names(raw: Sequence[str | None], header: bool = True) -> list[str]:
    """A blank header cell becomes colonne_i; a name met before gets the first
    free number from 2 on."""
    places = [f"colonne_{i}" for i in range(1, len(raw) + 1)]
    if not header:
        return places
    taken: dict[str, None] = {}
    for cell, place in zip(raw, places, strict=True):
        wanted = (cell or "").strip() or place
        free = chain([wanted], (f"{wanted}_{i}" for i in count(2)))
        taken[next(x for x in free if x not in taken)] = None
    return list(taken)


def detect_encoding(spark: SparkSession, path: str) -> str:
    """Encoding 'auto', decided on every line: a UTF-16 byte-order mark or a NUL gives
    UTF-16; text that decodes as UTF-8 (a UTF-8 mark is dropped) stays UTF-8;
    anything else is windows-1252."""
    probe = spark.read.option("encoding", "UTF-8").text(path).agg(
        F.max(F.col("value").startswith("\ufffd\ufffd") | F.col("value").contains("\u0000")).alias("wide"),
        F.max(F.try_validate_utf8(F.col("value")).isNull()).alias("bad")).first()
    return "UTF-16" if probe["wide"] else "windows-1252" if probe["bad"] else "UTF-8"


def _sniff_delimiter(spark: SparkSession, path: str, encoding: str) -> str:
    """Auto delimiter over all lines: of the candidates, the one whose commonest
    non-zero count of uses outside quotes holds on most lines."""
    bare = F.regexp_replace("value", '"[^"]*("|$)', "")
    uses = F.array(*[F.struct(F.lit(d).alias("d"), (F.length(bare) - F.length(F.replace(bare, F.lit(d), F.lit("")))).alias("n"))
                     for d in DELIMITERS])
    seen = (spark.read.option("encoding", encoding).text(path).select(F.explode(uses).alias("u")).select("u.d", "u.n")
            .filter("n > 0").groupBy("d", "n").count().orderBy(F.desc("count"), F.desc("n")).first())
    return seen["d"] if seen else ","


def numbered_rows(rows: DataFrame, files: DataFrame, row_id: str) -> DataFrame:
    """Adds ``row_id``, from 1 by file name and number.  ``files``: file, records, heads (header records, left out)."""
    own = files.withColumn("own", F.col("records") - F.col("heads"))
    before = running_sum(own, ["file"], "own", "_to").select(F.col("file").alias("_f"), (F.col("_to") - F.col("own") - F.col("heads")).alias("_before"),
                                                             F.col("heads").alias("_heads"))
    return (rows.join(before, rows["file"] == before["_f"]).filter(F.col("number") >= F.col("_heads"))
            .withColumn(row_id, F.col("number") + F.col("_before") + 1))


def read_reviews_delimited(spark: SparkSession, path: str, delimiter: str = "auto", encoding: str = "utf-8-sig",
                           header: bool | str = True, strict: bool = True, row_id: str = "row_id") -> DataFrame:
    """A05 + A06 + A07: delimited review files -> all-string DataFrame.

    Quoted fields may hold delimiters and line ends, quotes are doubled.  The width
    is the first record's.  Every file has its own header record; files whose
    headers differ raise.  ``header="first"``: only the first file by name has one
    (a document written in parts).  Blank rows are dropped, short rows are padded with ''
    and a row with a non-blank cell beyond the width raises (``strict``) or is
    dropped.  ``row_id`` numbers the rows from 1 by file name and place; a column
    of that name in the files raises.

    One large file is read by all tasks, whatever its quoted fields hold
    (``sources/records.py``); UTF-16 files are read by one task each."""
    enc = detect_encoding(spark, path) if encoding == "auto" else ENCODINGS.get(encoding, encoding)
    if delimiter == "auto":
        delimiter = _sniff_delimiter(spark, path, "UTF-16" if enc == "UTF-16" else "ISO-8859-1")
    if delimiter not in DELIMITERS:
        raise ValueError(f"unsupported delimiter: {delimiter!r}")
    if enc == "UTF-16":
        rows = read_utf16_records(spark, path, delimiter)
        first, files = rows.filter("number = 0"), rows.groupBy("file").agg(F.count(F.lit(1)).alias("records"))
    else:
        records = read_records(spark, path, Delimited(delimiter, enc))
        rows, first, files = records.rows(), records.rows(records.first_blocks()).filter("number = 0"), records.files.filter("records > 0")
    by_file = first.orderBy("file").limit(1)
    heads = first.select("cells").distinct().limit(2).collect() if header is True else by_file.select("cells").collect()
    if len(heads) > 1:
        raise ValueError("the files have different headers")
    names = header_names(heads[0]["cells"] if heads else [], bool(header))
    if row_id in names:
        raise ValueError(f"the files have a column {row_id!r}; choose another name for the row number")
    if header == "first":
        top = by_file.select(F.col("file").alias("_top"), F.lit(1).alias("_heads"))
    else:
        top = files.select(F.col("file").alias("_top"), F.lit(int(header)).alias("_heads"))
    files = files.join(top, files["file"] == top["_top"], "left").select("file", "records", F.coalesce("_heads", F.lit(0)).alias("heads"))
    out = numbered_rows(rows, files, row_id)
    blank = lambda c: F.length(F.regexp_replace(c, r"(?U)\s", "")) == 0
    surplus = F.exists(F.slice("cells", len(names) + 1, F.greatest(F.size("cells"), F.lit(1))), lambda c: ~blank(c))
    if strict:
        fail = F.raise_error(F.lit("a row has more values than the header; check the delimiter")).cast("boolean")
        out = out.filter(F.when(surplus, fail).otherwise(F.lit(True)))
    else:
        # The rows that go leave no gap in the numbers.
        out = global_row_number(out.filter(~surplus).drop(row_id), ["file", "number"], row_id)
    return out.select(*[F.coalesce(F.get("cells", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)], row_id)


#: More keys than this are taken for a misread file.
MAX_KEYS = 10_000


def read_reviews_json(spark: SparkSession, path: str, lines: bool | None = None, row_id: str = "row_id",
                      max_keys: int = MAX_KEYS) -> DataFrame:
    """JSON list, JSON lines, or an object holding exactly one list under
    reviews/avis/data/records.  Values come back as text (nested objects as JSON
    text, null as ''); the column set is the union of keys, in the order met.

    Malformed JSON, an element that is not an object, more than ``max_keys`` keys and
    a key named like the row number raise.  A JSON list is read by one task a
    file; JSON lines are split freely."""
    if lines is None:
        lines = path.endswith((".jsonl", ".ndjson"))
    blank = F.length(F.regexp_replace("_v", r"(?U)\s", "")) == 0
    if lines:
        texts = spark.read.text(path).select(F.col("value").alias("_v"), F.col("_metadata.file_path").alias("_file"),
                                             F.monotonically_increasing_id().alias("_at"), F.lit(0).alias("_pos")).filter(~blank)
    else:
        doc = spark.read.text(path, wholetext=True).select(F.trim("value").alias("_v"), F.col("_metadata.file_path").alias("_file"),
                                                           F.lit(0).cast("long").alias("_at"))
        opens = lambda c, mark: F.coalesce(F.startswith(F.ltrim(c), F.lit(mark)), F.lit(False))
        env = F.from_json("_v", "map<string,string>")
        held = F.filter(F.array(*[env[k] for k in ENVELOPE_KEYS]), lambda v: opens(v, "["))
        items = F.when(opens(F.col("_v"), "["), F.col("_v")).when(F.size(held) == 1, F.get(held, F.lit(0)))
        listed = F.coalesce(F.from_json(items, "array<string>"), F.raise_error(F.lit(
            "JSON: expected a list of objects, or an object with one list reviews/avis/data/records")).cast("array<string>"))
        texts = doc.select("_file", "_at", F.posexplode(listed).alias("_pos", "_v"))
    record = F.when(F.startswith(F.ltrim("_v"), F.lit("{")), F.from_json("_v", "map<string,string>"))
    bad = F.raise_error(F.concat(F.lit("JSON: not an object: "), F.substring(F.coalesce("_v", F.lit("null")), 1, 80))).cast("map<string,string>")
    rec = global_row_number(texts.select("_file", "_at", "_pos", F.coalesce(record, bad).alias("r")), ["_file", "_at", "_pos"], row_id)
    rec = rec.select(row_id, "r")
    keys = [k["k"] for k in rec.select(F.posexplode(F.map_keys("r")).alias("p", "k"), row_id).groupBy("k")
            .agg(F.min(F.struct(row_id, "p")).alias("first")).orderBy("first").limit(max_keys + 1).collect()]
    if len(keys) > max_keys:
        raise ValueError(f"JSON: more than {max_keys} keys")
    if row_id in keys:
        raise ValueError(f"the records have a key {row_id!r}; choose another name for the row number")
    return rec.select(row_id, *[F.coalesce(F.col("r")[k], F.lit("")).alias(k) for k in keys])


def segment_text(df: DataFrame, text: str = "text", mode: str = "lines", key: str | None = None) -> DataFrame:
    """Free text -> one record per non-blank line or per blank-line
    separated paragraph, trimmed (column ``texte``)."""
    pattern = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]" if mode == "lines" else r"\n\s*\n"
    keep = [key] if key else []
    parts = df.select(*keep, F.posexplode(F.split(F.col(text), pattern)).alias("part_no", "_p"))
    cleaned = parts.withColumn("texte", F.regexp_replace("_p", r"(?U)^\s+|\s+$", "")).drop("_p")
    return cleaned.filter(F.col("texte") != "")


def read_text(spark: SparkSession, path: str, mode: str = "lines", encoding: str = "utf-8") -> DataFrame:
    """A09 for files of any size: their lines, or their blank-line separated paragraphs, as ``texte``.  Paragraphs
    may cross the blocks that tasks read."""
    if mode == "lines":
        return segment_text(spark.read.text(path), "value", mode)
    return read_records(spark, path, Paragraphs(encoding)).rows().select(F.get("cells", F.lit(0)).alias("texte"))


def _norm(s: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", s) if not unicodedata.combining(c)).lower()


def guess_roles(columns: Sequence[str]) -> dict[str, str | None]:
    """A10: text, title and rating columns by accent- and case-insensitive
    candidate names (first candidate present wins)."""
    def pick(cands):
        normed = {c: _norm(c) for c in columns}
        for cand in cands:
            for c, n in normed.items():
                if n == cand:
                    return c
        return None
    return {"text": pick(TEXT_CANDIDATES), "title": pick(TITLE_CANDIDATES), "rating": pick(RATING_CANDIDATES)}


def preview_with_coverage(analyzed: DataFrame, imported: DataFrame, n: int = 5, seq: str = "row_id") -> DataFrame:
    """First n rows in source order with analysed / imported counts."""
    counts = analyzed.agg(F.count(F.lit(1)).alias("analysed")).crossJoin(
        imported.agg(F.count(F.lit(1)).alias("imported")))
    return analyzed.orderBy(seq).limit(n).crossJoin(counts)
