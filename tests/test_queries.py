"""Registered queries against their DuckDB oracles on the smallest fixture,
and the driver entry point."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from mercato.plans import registry

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
SAMPLE = ["v_order_summary", "q02_kpis", "q03_monthly_growth", "q06_seller_concentration", "q07_late_vs_score",
          "q10_cohorts", "fact_orders", "dq_report", "concentration_curve", "visual_top_sellers_visual",
          "welch_tests", "spearman_tests", "kruskal_test", "reviews_annotated", "model_scores",
          "stream_duplicate_flags", "column_profile", "cohort_table_with_total"]


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and "delivered_orders" in df.columns


def test_every_query_has_an_oracle_or_is_listed():
    q, o = registry.queries(), registry.oracle_sql()
    assert set(q) - set(o) == {"hypothesis_register"}
    assert set(q) <= set(E.queries()) and set(o) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, sf_small, con, name):
    df = E.queries()[name](spark, sf_small)
    got = _digest(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    want = _digest([d[0] for d in res.description], res.fetchall())
    assert sorted(df.columns) == sorted(d[0] for d in res.description)
    assert got == want


def test_hypothesis_register_shape(spark, sf_small):
    rows = E.queries()["hypothesis_register"](spark, sf_small).collect()
    assert len(rows) == 26 and all(r["conclusion"] for r in rows)
