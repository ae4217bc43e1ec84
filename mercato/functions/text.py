"""Text column functions for review triage.

Normalization (lower case, NFKD, combining marks dropped) runs in the JVM for
the common case: a ``translate`` table, built by rule from the Unicode data
for every Latin letter that decomposes to one ASCII letter plus marks, turns
accented Latin text into ASCII.  Only rows still holding non-ASCII characters
after that go through the Arrow UDF (exact NFKD in Python); other rows send a
null to it.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The tokenizer pattern and the punctuation tokens of the rules.
TOKEN_PATTERN = r"[a-z]+|[.!?,;:]"
URL_PATTERN = r"(?U)https?://\S+"
HANDLE_PATTERN = r"(?U)(?<!\w)@\w+"
# The characters of (?U)\s.
WHITE_SPACE = "".join(map(chr, (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


_MARKS = {cp: None for cp in range(0x110000) if unicodedata.combining(chr(cp))}


def normalize_py(value: str | None) -> str | None:
    """What ``normalize_text`` must equal: lower case, compatibility decomposition,
    then every character of a non-zero combining class deleted."""
    if value is None:
        return None
    value = str(value)
    return value.lower() if value.isascii() else unicodedata.normalize("NFKD", value.lower()).translate(_MARKS)


def _latin_table(lo: int = 0x00C0, hi: int = 0x024F) -> tuple[str, str]:
    src, dst = [], []
    for cp in range(lo, hi + 1):
        ch = chr(cp)
        base = normalize_py(ch)
        if len(base) == 1 and base.isascii() and ch.lower() == ch:
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


def _stable_table(lo: int = 0x0080, hi: int = 0x024F) -> str:
    """Non-ASCII characters that NFKD leaves as they are (e.g. ß, æ, ø)."""
    return "".join(chr(cp) for cp in range(lo, hi + 1)
                   if not unicodedata.combining(chr(cp)) and unicodedata.normalize("NFKD", chr(cp)) == chr(cp)
                   and chr(cp).lower() == chr(cp) and chr(cp).isprintable())


LATIN_SRC, LATIN_DST = _latin_table()
LATIN_STABLE = _stable_table()


@F.pandas_udf(StringType())
def _normalize_udf(s: pd.Series) -> pd.Series:
    return s.map(normalize_py, na_action="ignore")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _trimmed(c: Column) -> Column:
    """White space of any script dropped at both ends."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def _fast_normal(c: Column) -> Column:
    """Lower case without Latin accents; ASCII texts need no look at single characters."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(F.lower(c), LATIN_SRC, LATIN_DST))


def normalize_text(col) -> Column:
    """Lower, NFKD, drop combining marks (exact)."""
    c = F.coalesce(_c(col), F.lit(""))
    fast = _fast_normal(c)
    rest = F.translate(fast, LATIN_STABLE, "")          # stable characters removed: the rest must be ASCII
    exact = F.length(rest) == F.octet_length(rest)
    slow = _normalize_udf(F.when(~exact, c))
    return F.when(exact, fast).otherwise(slow)


def with_normalized(df, col, out: str = "normalized"):
    """X01 on a DataFrame: the JVM fast path is computed once in its own
    projection (Catalyst keeps a non-cheap expression that is referenced
    twice in a separate projection), then only rows that still need exact
    NFKD send their text to the Arrow UDF."""
    c = F.coalesce(_c(col), F.lit(""))
    fast = F.col("_nf_fast")
    rest = F.translate(fast, LATIN_STABLE, "")
    ascii_only = F.length(fast) == F.octet_length(fast)
    staged = (df.withColumn("_nf_fast", _fast_normal(c))
              .withColumn("_nf_exact", F.when(ascii_only, F.lit(True)).otherwise(F.length(rest) == F.octet_length(rest))))
    exact = F.col("_nf_exact")
    return (staged.withColumn(out, F.when(exact, fast).otherwise(_normalize_udf(F.when(~exact, c))))
            .drop("_nf_fast", "_nf_exact"))


def computed_once(value: Column) -> Column:
    """``value`` behind a condition that always holds and that Spark takes for one that may vary, which keeps Spark from writing its expression into
    filters and projections above, where it would be evaluated once a mention.  A column that nothing reads is still dropped."""
    return F.when(F.spark_partition_id() >= 0, value)


def is_blank(col) -> Column:
    """True when the text is empty or whitespace only (null counts as blank)."""
    return _trimmed(F.coalesce(_c(col), F.lit(""))) == ""


def compose_text(title, text) -> Column:
    """Trimmed title + ' ' + trimmed text; a column given twice is used once."""
    if title is None or (isinstance(title, str) and isinstance(text, str) and title == text):
        parts = [text]
    else:
        parts = [title, text]
    cleaned = [_trimmed(F.coalesce(_c(p), F.lit(""))) for p in parts]
    return cleaned[0] if len(cleaned) == 1 else _trimmed(F.concat_ws(" ", *cleaned))


# A rating: digits with an optional fraction (point or comma) and exponent.
RATING_PATTERN = r"^[+-]?([0-9]+([.,][0-9]*)?|[.,][0-9]+)([eE][+-]?[0-9]+)?$"


def parse_rating(col) -> Column:
    """Decimal comma accepted, white space of any script around it dropped;
    what is not a plain decimal number, and what overflows, gives null."""
    v = F.regexp_replace(F.coalesce(_c(col).cast("string"), F.lit("")), r"(?U)^\s+|\s+$", "")
    number = F.replace(F.when(v.rlike(RATING_PATTERN), v), F.lit(","), F.lit(".")).try_cast("double")
    return F.when(F.abs(number) != F.lit(float("inf")), number)


def tokenize(normalized) -> Column:
    """Letters runs or one punctuation mark, on normalized text."""
    return F.regexp_extract_all(_c(normalized), F.lit(TOKEN_PATTERN), 0)


def mask_handles_urls(col) -> Column:
    """X11: URLs become 'http', @handles become '@user'."""
    return F.regexp_replace(F.regexp_replace(_c(col), URL_PATTERN, "http"), HANDLE_PATTERN, "@user")


def whitespace_tokens(col) -> Column:
    """Default model tokenizer: split on whitespace, empty pieces dropped."""
    return F.array_remove(F.split(F.coalesce(_c(col), F.lit("")), r"(?U)\s+"), "")


def duplicate_key(normalized) -> Column:
    """X09 key: normalized text with whitespace runs collapsed, trimmed."""
    return F.trim(F.regexp_replace(_c(normalized), r"(?U)\s+", " "))
