"""Records over line ends, with blocks far smaller than the records."""

import csv
import io
import random

import pytest

from mercato.sources.records import Delimited, Paragraphs, read_records
from mercato.sources.reviews import read_reviews_delimited, read_text


@pytest.fixture(params=[48, None])
def blocks(spark, request):
    """Bytes of a block; None leaves the default."""
    if request.param is None:
        yield
        return
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    old = {n: spark.conf.get(n, None) for n in names}
    spark.conf.set(names[0], str(request.param))
    spark.conf.set(names[1], "0")
    yield
    for n, v in old.items():
        spark.conf.set(n, v) if v is not None else spark.conf.unset(n)


def cells(rng):
    pick = ["", " ", "plain", "é, ü", 'say ""no""'.replace('""', '"'), "a\nb", "\n\n", "x\r\ny", ",;,", "日本\n語", '"', '"\n"', "long " * rng.choice([1, 30])]
    return [rng.choice(pick) for _ in range(3)]


def wanted(rows):
    return [r for r in rows if any(c.strip() for c in r)]


def written(rows, end="\r\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_rows_equal_a_plain_reader(spark, tmp_path, blocks, end):
    rng = random.Random(len(end))
    head = [["a\nx", 'b "c"', "d"]]
    want = []
    for name in ("p.csv", "q.csv"):
        rows = [cells(rng) for _ in range(40)]
        (tmp_path / name).write_bytes(b"\xef\xbb\xbf" + written(head + rows, end).encode())
        want += wanted(rows)
    df = read_reviews_delimited(spark, str(tmp_path), ",")
    assert df.columns == ["a\nx", 'b "c"', "d", "row_id"]
    got = df.orderBy("row_id").collect()
    assert [list(r)[:3] for r in got] == want and [r["row_id"] for r in got] == list(range(1, len(want) + 1))


def test_quotes_inside_plain_fields_and_open_ends(spark, tmp_path, blocks):
    text = 'n,t\n1,5" screen\n2,"a" tail, more\n3,"x""y"\n4,"' + "line\n" * 40 + '"\n5,"never closed\nat all\n'
    (tmp_path / "f.csv").write_text(text)
    df = read_reviews_delimited(spark, str(tmp_path / "f.csv"), ",", strict=False)
    got = {r["n"]: r["t"] for r in df.collect()}
    assert got["1"] == '5" screen' and got["3"] == 'x"y' and got["4"] == "line\n" * 40 and got["5"].startswith("never closed\nat all")
    assert "2" not in got                       # three cells


def test_blocks_are_read_by_several_tasks(spark, tmp_path, blocks):
    rows = [[str(i), "line\nline"] for i in range(150)]
    (tmp_path / "f.csv").write_text(written([["i", "t"], *rows], "\n"))
    r = read_records(spark, str(tmp_path / "f.csv"), Delimited())
    n = r.states.count()
    size = int(spark.conf.get("spark.sql.files.maxPartitionBytes").rstrip("b"))
    assert n > (3 if size < 1000 else 0) and r.lines.rdd.getNumPartitions() >= n / 2
    assert r.rows().count() == 151


def test_cp1252_and_bare_carriage_returns(spark, tmp_path, blocks):
    (tmp_path / "w.csv").write_bytes('t;n\r"\x9cuvre\r\xe0 3 \x80";1\rdeux;2\r\x81;3'.encode("latin-1"))
    df = read_reviews_delimited(spark, str(tmp_path / "w.csv"), ";", "cp1252")
    assert [tuple(r) for r in df.orderBy("row_id").collect()] == [("œuvre\rà 3 €", "1", 1), ("deux", "2", 2), ("\x81", "3", 3)]


def test_empty_files(spark, tmp_path, blocks):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text("\n\n \n")
    (tmp_path / "c.csv").write_text("h\nv\n")
    assert [tuple(r) for r in read_reviews_delimited(spark, str(tmp_path), ",").collect()] == [("v", 1)]


def test_paragraphs_cross_blocks(spark, tmp_path, blocks):
    rng = random.Random(4)
    parts = ["\n".join("word " * rng.randrange(1, 12) for _ in range(rng.randrange(1, 9))).strip() for _ in range(60)]
    (tmp_path / "t.txt").write_text("\n \n" + "".join(p + rng.choice(["\n\n", "\n  \n\n"]) for p in parts))
    assert sorted(r["texte"] for r in read_text(spark, str(tmp_path / "t.txt"), "paragraphs").collect()) == sorted(parts)


@pytest.mark.parametrize("rule", [Delimited(), Paragraphs()])
def test_states_are_those_of_a_plain_walk(rule):
    rng = random.Random(7)
    lines = "".join(rng.choice(['"', "a", ",", "\n", '""', " ", "\n\n"]) for _ in range(4000)).encode().split(b"\n")
    inside = False
    for line in lines:
        after, content = rule.step(line, inside)
        if isinstance(rule, Delimited) and not inside and not after:
            assert content == any(c.strip() for c in rule.cells(line))
        inside = after
