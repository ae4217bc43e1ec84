"""The profile of all tables against its oracle, and the tables it reads."""

import duckdb
from test_queries import TABLES, _digest

import __spark_entry__ as E
from mercato.sources.raw import parquet_tables


def test_every_table_and_column_is_profiled(spark, sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    df = E.queries()["column_profile_all_tables"](spark, sf_small)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()["column_profile_all_tables"])
    assert _digest(df.columns, rows) == _digest([d[0] for d in res.description], res.fetchall())
    assert {(r[0], r[1]) for r in rows} == {(t, c) for t in TABLES for c in spark.read.parquet(f"{sf_small}/{t}.parquet").columns}


def test_tables_of_many_files_are_found(spark, sf_small, tmp_path):
    for t in ("nation", "region"):
        spark.read.parquet(f"{sf_small}/{t}.parquet").repartition(3).write.parquet(f"{tmp_path}/{t}.parquet")
    assert parquet_tables(spark, str(tmp_path)) == ["nation", "region"]


def test_stored_sketches_add_up(spark):
    """Profiles of parts, united, estimate the whole; counts are exact."""
    from mercato.sources.raw import column_profile, column_sketches, profile_of_sketches, united_sketches
    df = spark.range(6000).selectExpr("id % 500 as a", "if(id % 4 = 0, null, cast(id as string)) as b", "cast(null as int) as c")
    parts = [column_sketches(df.filter(f"a % 3 = {k}"), "t") for k in range(3)]
    exact = {r["column"]: r for r in column_profile(df, "t").collect()}
    got = {r["column"]: r for r in profile_of_sketches(united_sketches(*parts), {"t": df.columns}).collect()}
    assert exact["a"]["unique_non_null"] == 500 and exact["b"]["missing"] == 1500 and exact["c"]["missing_rate"] == 1.0
    for c in "abc":
        assert got[c]["rows"] == 6000 and got[c]["missing"] == exact[c]["missing"]
        assert abs(got[c]["unique_non_null"] - exact[c]["unique_non_null"]) <= 0.03 * exact[c]["unique_non_null"]


def test_empty_and_odd_tables(spark):
    from mercato.sources.raw import profile_tables
    odd = spark.createDataFrame([(1, [1.0]), (2, None)], "`a b` int, v array<double>")
    got = {(r["table"], r["column"]): (r["rows"], r["missing"], r["unique_non_null"])
           for r in profile_tables({"odd": odd, "none": odd.limit(0)}).collect()}
    assert got == {("odd", "a b"): (2, 0, 2), ("odd", "v"): (2, 1, 1), ("none", "a b"): (0, 0, 0), ("none", "v"): (0, 0, 0)}
