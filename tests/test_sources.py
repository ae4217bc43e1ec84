"""Review file readers and raw-source operators."""

import pytest
from pyspark.sql import functions as F

from mercato.sources import raw
from mercato.sources.reviews import (guess_roles, header_names, read_reviews_delimited, read_reviews_json,
                                     read_text)


def columns(df):
    return [c for c in df.columns if c != "row_id"]


def ordered(df, name):
    return [r[name] for r in df.orderBy("row_id").collect()]


def save(folder, name, text, encoding="utf-8"):
    path = folder / name
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_header_rules():
    assert header_names(["b", None, "b", " c ", "b_2", "b"]) == ["b", "colonne_2", "b_2", "c", "b_2_2", "b_3"]
    assert header_names(["x"] * 3, header=False) == ["colonne_1", "colonne_2", "colonne_3"]


def test_line_breaks_and_delimiters_inside_quotes(spark, tmp_path):
    path = save(tmp_path, "w.csv", 'ville|mot\r\n"Orléans | centre\nnord"|"œuvre à 3 €"\r\n', "cp1252")
    df = read_reviews_delimited(spark, path, "|", "cp1252")
    assert columns(df) == ["ville", "mot"]
    assert tuple(df.first())[:2] == ("Orléans | centre\nnord", "œuvre à 3 €")


def test_doubled_quotes_and_repeated_headers(spark, tmp_path):
    df = read_reviews_delimited(spark, save(tmp_path, "q.csv", 'k,k,k\n"say ""no"", twice",2,3\n'), ",")
    assert columns(df) == ["k", "k_2", "k_3"] and df.first()["k"] == 'say "no", twice'


@pytest.mark.parametrize("tail", [",over", ",,over", ',"",  , over'])
def test_surplus_cells_raise_or_drop(spark, tmp_path, tail):
    path = save(tmp_path, "s.csv", f"a,b\n1,2\n3,4{tail}\n5,6,,\n")
    with pytest.raises(Exception, match="more values than the header"):
        read_reviews_delimited(spark, path, ",").collect()
    assert ordered(read_reviews_delimited(spark, path, ",", strict=False), "a") == ["1", "5"]


def test_wide_files_keep_every_column(spark, tmp_path):
    wide = ",".join(f"c{i}" for i in range(510))
    path = save(tmp_path, "wide.csv", wide + "\n" + ",".join(str(i) for i in range(510)) + "\n")
    df = read_reviews_delimited(spark, path, ",")
    assert len(columns(df)) == 510 and df.first()["c509"] == "509"


def test_short_and_blank_rows(spark, tmp_path):
    df = read_reviews_delimited(spark, save(tmp_path, "b.csv", "p;q\n;\n7\n \n8;9\n"), ";")
    assert [tuple(r)[:2] for r in df.orderBy("row_id").collect()] == [("7", ""), ("8", "9")]
    assert ordered(df, "row_id") == [1, 2]


def test_no_header_in_utf16(spark, tmp_path):
    df = read_reviews_delimited(spark, save(tmp_path, "u.csv", "né;2\nà;3\n", "utf-16"), ";", "utf-16", header=False)
    assert columns(df) == ["colonne_1", "colonne_2"] and ordered(df, "colonne_1") == ["né", "à"]


def test_folder_of_files(spark, tmp_path):
    many = tmp_path / "many"
    many.mkdir()
    for name, rows in (("b.csv", 3), ("a.csv", 300), ("c.csv", 1)):
        save(many, name, "m,v\n" + "".join(f"{name},{i}\n" for i in range(rows)))
    df = read_reviews_delimited(spark, str(many), ",")
    got = [(r["m"], r["v"], r["row_id"]) for r in df.orderBy("row_id").collect()]
    want = [(n, str(i)) for n, k in (("a.csv", 300), ("b.csv", 3), ("c.csv", 1)) for i in range(k)]
    assert got == [(*w, i + 1) for i, w in enumerate(want)]
    save(many, "d.csv", "m,other\n1,2\n")
    with pytest.raises(ValueError, match="different headers"):
        read_reviews_delimited(spark, str(many), ",")


def test_row_number_does_not_overwrite_a_column(spark, tmp_path):
    path = save(tmp_path, "r.csv", "row_id,t\n7,x\n")
    with pytest.raises(ValueError, match="row_id"):
        read_reviews_delimited(spark, path, ",")
    assert tuple(read_reviews_delimited(spark, path, ",", row_id="line").first()) == ("7", "x", 1)


def test_delimiter_is_found_over_all_lines(spark, tmp_path):
    path = save(tmp_path, "d.csv", "x\ty\n" + '"a, b, c, d, e"\t1\n' * 250 + "1, 2\t3\n")
    assert read_reviews_delimited(spark, path).count() == 251


def test_encoding_is_found_over_all_lines(spark, tmp_path):
    late = "t;n\n" + "plain;1\n" * 400 + "Noël;2\n"
    for name, encoding in (("a.csv", "cp1252"), ("b.csv", "utf-16"), ("c.csv", "utf-8-sig"), ("d.csv", "utf-8")):
        df = read_reviews_delimited(spark, save(tmp_path, name, late, encoding), ";", "auto")
        assert ordered(df, "t")[-1] == "Noël" and columns(df) == ["t", "n"], name


def test_json_shapes(spark, tmp_path):
    df = read_reviews_json(spark, save(tmp_path, "l.json", '[{"b": 1, "a": null}, {"c": {"d": [2]}, "b": "z"}]'))
    assert df.columns == ["row_id", "b", "a", "c"]
    assert [tuple(r) for r in df.orderBy("row_id").collect()] == [(1, "1", "", ""), (2, "z", "", '{"d":[2]}')]
    df = read_reviews_json(spark, save(tmp_path, "e.json", '{"page": 1, "records": [{"v": "x"}, {"v": "y"}]}'))
    assert ordered(df, "v") == ["x", "y"]
    df = read_reviews_json(spark, save(tmp_path, "n.jsonl", '{"v": "x"}\n\n{"v": "y", "w": true}\n'))
    assert ordered(df, "v") == ["x", "y"] and ordered(df, "w") == ["", "true"]


@pytest.mark.parametrize(("name", "text"), [
    ("a.json", '[{"v": "a"}, 3, {"v": "b"}]'), ("b.json", '[{"v": "a"}, {"v": "b"'), ("c.json", '{"v": "a"}'),
    ("d.json", '{"data": [{"v": 1}], "avis": [{"v": 2}]}'), ("e.json", '[null]'), ("f.jsonl", '{"v": 1}\nnot json\n'),
    ("g.jsonl", '{"v": 1}\n[1, 2]\n'), ("h.json", '[{"row_id": 4}]')])
def test_bad_json_raises(spark, tmp_path, name, text):
    with pytest.raises(Exception):
        read_reviews_json(spark, save(tmp_path, name, text)).collect()


def test_text_file_modes(spark, tmp_path):
    path = save(tmp_path, "t.txt", "un\n deux \n \n\ntrois\r\nquatre")
    assert [r["texte"] for r in read_text(spark, path, "lines").collect()] == ["un", "deux", "trois", "quatre"]
    assert [r["texte"] for r in read_text(spark, path, "paragraphs").collect()] == ["un\n deux", "trois\r\nquatre"]


def test_guess_roles():
    roles = guess_roles(["id", "Commentaire", "Note", "Titre"])
    assert roles == {"text": "Commentaire", "title": "Titre", "rating": "Note"}
    assert guess_roles(["review_comment_message", "review_score"])["rating"] == "review_score"


def test_raw_tables_manifest_profile_and_typing(spark, tmp_path):
    (tmp_path / "shop_orders_dataset.csv").write_text("order_id,price\n1,2.5\n2,\n3,x\n", encoding="utf-8")
    (tmp_path / "shop_items_dataset.csv").write_text('order_id,note\n1,"a\nb"\n', encoding="utf-8")
    t = raw.read_raw_tables(spark, str(tmp_path), expected=["orders", "items"], strip=("shop_", "_dataset"))
    assert set(t) == {"orders", "items"}
    assert t["items"].first()["note"] == "a\nb"
    man = {r["table"]: r for r in raw.source_manifest(spark, str(tmp_path), "*.csv", t, ("shop_", "_dataset")).collect()}
    import hashlib
    assert man["orders"]["sha256"] == hashlib.sha256((tmp_path / "shop_orders_dataset.csv").read_bytes()).hexdigest()
    assert man["orders"]["rows"] == 3 and man["orders"]["columns"] == 2
    prof = {r["column"]: r for r in raw.column_profile(t["orders"], "orders").collect()}
    assert prof["price"]["missing"] == 1 and prof["price"]["unique_non_null"] == 2
    typed, rejects = raw.coerce_types(t["orders"], {"price": "double"}, policy="quarantine", row_id="order_id")
    assert [r["value"] for r in rejects.collect()] == ["x"]
    assert typed.filter(F.col("price").isNull()).count() == 2
    bad, _ = raw.coerce_types(t["orders"], {"price": "double"}, policy="raise")
    with pytest.raises(Exception):
        bad.collect()
