"""Content-addressed WARC archive (operator 10).

``write_archive`` turns pages into WARC/1.1 records and stores them as two
Parquet tables in the shared folder:

* ``payloads``: one row per distinct payload (digest, bytes), keyed and bucketed by SHA-256;
* ``records``: one row per page with the exact bytes of the record's header
  block and the digest of its payload; no payload bytes.

``read_archive`` parses the header blocks, joins the payloads back and rebuilds
the full records; it verifies each stored payload against its SHA-256 name and
each record against its own SHA-1 label and length, and raises if one fails.

Of the records with equal payloads (of at least ``least_bytes``) the one with
the largest id is a response and the others are revisits that refer to it;
smaller payloads are all responses.  Payload copies are reduced map-side before
they are shuffled, so a group of copies that holds a third of all pages costs one
payload a task; reading back shuffles headers only.

Defined results.  Null html: empty payload.  Null url: no target header; read
back as null.  Repeated rows (equal ids and payloads): one of them is the
response, the others revisits of the same id; a null id comes before all
others and gives refers_to null.  An empty table gives two empty tables.  Other
columns are ignored.  A very long page is one payload, whole.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.shared import scratch_path

LEAST_BYTES = 0
WARC_DATE = "2024-01-01T00:00:00Z"
_HEX32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_of_hex(hex40: Column) -> Column:
    """RFC 4648 base32 of a SHA-1 given as 40 hex digits: 5 digits make 4 characters."""
    parts = [F.lpad(F.conv(F.substring(hex40, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), _HEX32, _BASE32)


def _header(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(name + ": "), value, F.lit("\r\n"))).otherwise(F.lit(""))


def _urn(*parts: Column) -> Column:
    h = F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]), 256)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                                                     F.substring(h, 17, 4), F.substring(h, 21, 12)), F.lit(">"))


def header_block() -> Column:
    """The exact header block of a row of ``_records``."""
    sha1 = F.concat(F.lit("sha1:"), F.col("sha1"))
    kind = F.col("record_type")
    # Line breaks would end a header; a URL with them is written percent-encoded.
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit("WARC/1.1\r\n"), _header("WARC-Type", kind), _header("WARC-Record-ID", _urn(F.col("id"), F.col("digest"))),
        _header("WARC-Date", F.lit(WARC_DATE)), _header("WARC-Target-URI", url),
        _header("WARC-Payload-Digest", sha1), _header("WARC-Page-ID", F.col("id").cast("string")),
        F.when(kind == "revisit", F.concat(_header("WARC-Refers-To", _urn(F.col("refers_to"), F.col("digest"))),
                                           _header("WARC-Refers-To-Page-ID", F.col("refers_to").cast("string")),
                                           F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n")))
        .otherwise(F.lit("")),
        _header("Content-Type", F.lit("text/html; charset=utf-8")),
        _header("WARC-Payload-Length", F.col("bytes").cast("string")),
        _header("Content-Length", F.when(kind == "revisit", F.lit("0")).otherwise(F.col("bytes").cast("string"))),
        F.lit("\r\n"))


def payload_table(path: str) -> str:
    """The catalog's name of the payloads under ``path``: it knows their buckets."""
    return f"warc_payloads_{hashlib.sha256(path.encode()).hexdigest()[:32]}"


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  least_bytes: int = LEAST_BYTES) -> None:
    """Writes path/payloads and path/records."""
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    named = rows.withColumn("digest", F.sha2("payload", 256))
    # One payload a digest: the map-side step keeps a single copy per task.
    store = named.groupBy("digest").agg(F.any_value("payload").alias("payload"))
    # Bucketed as the grouping dealt them, so that reading back moves headers only.
    buckets = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    store.write.bucketBy(buckets, "digest").sortBy("digest").option("path", f"{path}/payloads").saveAsTable(payload_table(path))
    small = named.select("id", "url", "digest", base32_of_hex(F.sha1("payload")).alias("sha1"),
                         F.octet_length("payload").cast("long").alias("bytes"), F.monotonically_increasing_id().alias("place"))
    # The place tells equal ids apart, so one row of them is the response.
    small = small.withColumn("key", F.struct("id", "place"))
    first = small.groupBy("digest").agg(F.max("key").alias("key"))
    first = first.select(F.col("digest").alias("_d"), F.col("key").alias("_key"))
    whole = small.join(first, F.col("digest") == F.col("_d"))
    own = (F.col("bytes") < least_bytes) | F.col("key").eqNullSafe(F.col("_key"))
    records = (whole.withColumn("record_type", F.when(own, "response").otherwise("revisit"))
               .withColumn("refers_to", F.when(~own, F.col("_key.id"))))
    records.select(header_block().cast("binary").alias("header"), "digest").write.parquet(f"{path}/records")


def _field(name: str) -> Column:
    return F.regexp_extract(F.col("head"), f"(?:^|\\n){name}: ([^\\r]*)\\r", 1)


def _given(name: str) -> Column:
    """A header's value, or null where the header is missing."""
    return F.when(F.col("head").rlike(f"\\n{name}: "), _field(name))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(id, url, record_type, refers_to, payload_digest, payload_bytes, html, warc) of every record, ids as text.

    ``html`` is the full payload, of revisits too.  ``warc`` is the whole record: its exact header block, the stored payload where it is a response, and the record's end.
    Digest and length of a response are taken from the payload inside the rebuilt record, those of a revisit from the payload
    it stands for; both must be what the header says.  The payloads' buckets are joined where they lie if the session that
    wrote them reads; by path otherwise."""
    name = payload_table(path)
    stored = spark.table(name) if spark.catalog.tableExists(name) else spark.read.parquet(f"{path}/payloads")
    # Opened and hashed once per distinct payload, before the join spreads them.
    opened = stored.select("digest", F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload does not match its digest "), F.col("digest")))).alias("payload"))
    opened = opened.select("digest", "payload", base32_of_hex(F.sha1("payload")).alias("_sha1"), F.octet_length("payload").cast("long").alias("_bytes"))
    heads = spark.read.parquet(f"{path}/records").select("header", "digest", F.col("header").cast("string").alias("head"))
    parsed = heads.select(
        "header", "digest", _given("WARC-Page-ID").alias("id"), _given("WARC-Target-URI").alias("url"),
        _field("WARC-Type").alias("record_type"), _given("WARC-Refers-To-Page-ID").alias("refers_to"),
        F.regexp_replace(_field("WARC-Payload-Digest"), "^sha1:", "").alias("_label"),
        _field("WARC-Payload-Length").cast("long").alias("_length"), _field("Content-Length").cast("int").alias("_content"))
    whole = parsed.join(opened, "digest", "left")
    response = F.col("record_type") == "response"
    body = F.when(response, F.col("payload")).otherwise(F.lit(b""))
    whole = whole.withColumn("warc", F.concat("header", body, F.lit(b"\r\n\r\n")))
    inside = F.substring(F.col("warc"), F.octet_length("header") + 1, F.col("_content"))
    whole = (whole.withColumn("payload_digest", F.when(response, base32_of_hex(F.sha1(inside))).otherwise(F.col("_sha1")))
             .withColumn("payload_bytes", F.when(response, F.octet_length(inside).cast("long")).otherwise(F.col("_bytes"))))
    same = F.coalesce((F.col("payload_digest") == F.col("_label")) & (F.col("payload_bytes") == F.col("_length")), F.lit(False))
    whole = whole.withColumn("payload_digest", F.when(same, F.col("payload_digest")).otherwise(
        F.raise_error(F.concat(F.lit("record does not match its payload: "), F.col("digest")))))
    return whole.select("id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", F.col("payload").alias("html"), "warc")


def archive_and_read(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                     least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Writes the archive to the shared folder and rebuilds every record from it; ids in their own type."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archive(pages, path, id_col, url_col, html_col, least_bytes)
    kind = pages.schema[id_col].dataType
    back = read_archive(pages.sparkSession, path)
    return back.withColumn("id", F.col("id").cast(kind)).withColumn("refers_to", F.col("refers_to").cast(kind))
