import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from mercato.llm import shared
from mercato.llm import warc_store as W

ROWS = [(1, "http://a/1", "<p>x</p>"), (2, "http://a/2", "<p>x</p>"), (7, "http://b/", "<p>x</p>"), (3, None, "é\r\n\r\nWARC/1.1\r\n"),
        (4, "http://c/\r\nWARC-Type: response", ""), (5, "http://d/", None), (9, "http://e/", "own"), (9, "http://e/", "own"),
        (None, "http://f/", "alone"), (6, "http://g/", "z" * 300_000)]


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], "page_id long, url string, html string, digest string, payload string")


def test_round_trip(spark):
    path = shared.scratch_path(spark, "warc")
    W.write_archive(pages_of(spark, ROWS), path)
    got = W.read_archive(spark, path).collect()
    assert sorted((r["id"] or "", bytes(r["html"]).decode()) for r in got) == sorted((str(i) if i else "", h or "") for i, _, h in ROWS)
    for r in got:
        body = bytes(r["html"])
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(body).digest()).decode() and r["payload_bytes"] == len(body)
        head, _, rest = bytes(r["warc"]).partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: " + r["record_type"].encode())
        assert rest == (body if r["record_type"] == "response" else b"") + b"\r\n\r\n"
    by_id = {}
    for r in got:
        by_id.setdefault(r["id"], []).append((r["record_type"], r["refers_to"]))
    assert by_id["7"] == [("response", None)] and by_id["1"] == by_id["2"] == [("revisit", "7")]
    assert by_id["5"] == [("response", None)] and by_id["4"] == [("revisit", "5")]
    assert sorted(by_id["9"], key=str) == [("response", None), ("revisit", "9")]
    assert spark.read.parquet(f"{path}/payloads").count() == len({h or "" for _, _, h in ROWS})
    assert next(r["url"] for r in got if r["id"] == "3") is None


def test_small_payloads_are_responses(spark):
    got = W.archive_and_read(pages_of(spark, ROWS), least_bytes=9).collect()
    assert all(r["record_type"] == "response" for r in got)


def test_damage_is_noticed(spark):
    path, other = shared.scratch_path(spark, "warc"), shared.scratch_path(spark, "warc")
    W.write_archive(pages_of(spark, ROWS), path)
    spark.read.parquet(f"{path}/records").write.parquet(f"{other}/records")
    stored = spark.read.parquet(f"{path}/payloads")
    stored.withColumn("payload", F.when(F.length("payload") == 3, F.encode(F.lit("own!"), "UTF-8")).otherwise(F.col("payload"))).write.parquet(f"{other}/payloads")
    with pytest.raises(Exception, match="does not match"):
        W.read_archive(spark, other).collect()


def test_stored_payloads_do_not_move_when_read(spark):
    path = shared.scratch_path(spark, "warc")
    W.write_archive(pages_of(spark, ROWS), path)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = W.read_archive(spark, path)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SelectedBucketsCount" in plan and plan.count("Exchange hashpartitioning") == 1
    # Without the catalog's entry the records are rebuilt by path.
    want = sorted(map(str, W.read_archive(spark, path).collect()))
    spark.sql(f"DROP TABLE {W.payload_table(path)}")
    assert sorted(map(str, W.read_archive(spark, path).collect())) == want


def test_base32(spark):
    texts = ["", "a", "abc" * 50]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", W.base32_of_hex(F.sha1("t")).alias("b"))
    assert {r["t"]: r["b"] for r in df.collect()} == {t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode() for t in texts}


def test_empty_table(spark):
    assert W.archive_and_read(pages_of(spark, [])).collect() == []
