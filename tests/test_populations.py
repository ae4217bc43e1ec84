"""The register's populations are written narrow, and once."""

from datetime import datetime
from pathlib import Path

import pytest

from mercato.operators.aggregates import item_totals
from mercato.plans import hypotheses as H, model as M, registry as G
from mercato.plans.reg_stats import FIXTURE_HYPOTHESES


def test_populations_are_written_with_the_columns_that_are_read(spark, sf_small):
    P = H.populations(G.full_model(spark, sf_small), geo=False)
    assert set(P.f.columns) == set(H.ORDER_COLUMNS) - set(H.GEO_COLUMNS)
    for kept in (P.f, P.di, P.rated):
        files = kept.inputFiles()
        assert files and all(Path(f).suffix == ".parquet" for f in files)
    assert set(P.d.inputFiles()) == set(P.f.inputFiles())
    assert set(P.one.columns) == set(H.ITEM_COLUMNS)


def test_kruskal_builds_no_places(spark, sf_small):
    m = G.full_model(spark, sf_small)
    columns = H.populations(m, geo=False).columns
    assert "geolocation" not in m.fact_orders.select(*columns)._jdf.queryExecution().optimizedPlan().toString()
    assert len(H.kruskal_table(m).collect()) == 1


def test_bi_tables_read_one_written_order_fact(spark, sf_small):
    measures = G.queries()["measures_all"](spark, sf_small)
    assert "c_custkey" not in measures._jdf.queryExecution().optimizedPlan().toString()      # orders are not built again
    m = M.with_written_orders(G.light_model(spark, sf_small))
    assert set(m.fact_orders.columns) == M.BI_ORDER_COLUMNS
    assert m.fact_orders.count() == G.fact_base(spark, sf_small).count()


def _study_tables(spark):
    """A few orders, some with repeated or null keys."""
    def at(day: int) -> datetime:
        return datetime(2017, 3, day)

    orders = [("a", "c1", "delivered", 1), ("a", "c2", "shipped", 1), ("b", "c1", "delivered", 2), ("c", "c3", "delivered", 3),
              ("d", "c9", "delivered", 4), ("e", "c2", "shipped", 5), ("f", "c3", "delivered", 6), (None, "c1", "delivered", 7),
              ("g", "c2", "delivered", 8), ("g", "c2", "delivered", 8), ("h", None, "delivered", 9)]
    orders = [(o, c, s, at(d), at(d + 1), at(d + 2), at(d + 3), at(d + 4)) for o, c, s, d in orders]
    items = [("a", 1, "p1", "s1"), ("b", 1, "p1", "s2"), ("b", 2, "p2", "s1"), ("c", 1, "p1", "s3"), ("c", 2, "p3", None), ("d", 1, "p1", "s2"),
             ("e", 1, "p2", "s2"), ("f", 1, None, None), (None, 1, "p1", "s1"), ("g", 1, "p2", "s2"), ("h", 1, "p2", "s1"), ("x", 1, "p1", "s1")]
    rows = {
        "orders": (orders, "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
                   "order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz"),
        "customers": ([("c1", "u1", "10", "A"), ("c2", "u2", "20", "B"), ("c3", "u3", "10", "A"), ("c3", "u4", "30", "B"), (None, "u5", "10", "A")],
                      "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_state string"),
        "order_items": ([(o, n, p, s, "10.00", "2.50") for o, n, p, s in items],
                        "order_id string, order_item_id int, product_id string, seller_id string, price string, freight_value string"),
        "order_payments": ([(o, n, "credit_card", n, "12.50") for o, n, _, _ in items],
                           "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value string"),
        "order_reviews": ([(o, f"r{o}{n}", 1 + n, "vu", at(12), at(13)) for o, n, _, _ in items],
                          "order_id string, review_id string, review_score int, review_comment_message string, review_creation_date timestamp_ntz, "
                          "review_answer_timestamp timestamp_ntz"),
        "products": ([("p1", "x", 1, 5.0), ("p2", "y", 2, 6.0), ("p2", "z", 3, 7.0), (None, "x", 1, 1.0)],
                     "product_id string, product_category_name string, product_photos_qty int, product_weight_g double"),
        "sellers": ([("s1", "10", "A"), ("s2", "20", "A"), ("s2", "30", "B"), ("s3", "99", "C"), (None, "10", "A")],
                    "seller_id string, seller_zip_code_prefix string, seller_state string"),
        "geolocation": ([("10", -20.0, -50.0), ("10", -21.0, -51.0), ("20", -10.0, -40.0), ("30", -5.0, -60.0)],
                        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double"),
        "product_category_name_translation": ([("x", "ex")], "product_category_name string, product_category_name_english string"),
    }
    t = {name: spark.createDataFrame(*r) for name, r in rows.items()}
    for name, cols in (("order_items", ("price", "freight_value")), ("order_payments", ("payment_value",))):
        for c in cols:
            t[name] = t[name].withColumn(c, t[name][c].cast("decimal(18,2)"))
    return t


def _rows(df) -> list[str]:
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("geo", [True, False])
def test_populations_hold_the_rows_of_the_facts(spark, geo):
    """Repeated orders, customers, products and sellers, null keys, items of no order."""
    m = M.build_model(_study_tables(spark), M.StudyParams())
    P = H.populations(m, geo=geo)
    want = m.fact_orders.filter("order_status = 'delivered'").select(*P.columns)
    assert _rows(P.f.filter("order_status = 'delivered'")) == _rows(want) and want.count() == 11
    assert _rows(P.di) == _rows(M.main_population(m.fact_items).select(*H.ITEM_COLUMNS))
    assert _rows(P.d.select("order_id")) == _rows(M.main_population(m.fact_orders).select("order_id"))
    if geo:
        assert {r["same_state"] for r in P.f.select("same_state").collect()} == {0, 1, None}
        assert P.f.filter("distance_km > 0").count() > 0


def test_sellers_of_an_order_take_one_shuffle(spark):
    items = spark.createDataFrame([("a", "s"), ("a", "s"), ("a", None), ("b", None), ("c", "s"), ("c", "t")], "order_id string, seller_id string")
    items = items.selectExpr("*", "CAST(1 AS DECIMAL(18,2)) AS price", "CAST(0 AS DECIMAL(18,2)) AS freight_value")
    got = item_totals(items, only_seller=True)
    assert {r["order_id"]: (r["item_count"], r["seller_count"], r["only_seller"]) for r in got.collect()} == {
        "a": (3, 1, "s"), "b": (1, 0, None), "c": (2, 2, None)}
    assert "only_seller" not in item_totals(items).columns
    assert item_totals(items)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def _files_on_disk(spark) -> int:
    return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().size()


def test_written_populations_leave_no_shuffle_files(spark, sf_small):
    m = G.full_model(spark, sf_small)
    before = _files_on_disk(spark)
    P = H.populations(m, geo=False)
    assert P.f.inputFiles() and P.rated.inputFiles()
    assert _files_on_disk(spark) <= before


def _written(monkeypatch) -> list:
    frames, keep = [], H.written_once

    def seen(df, name):
        frames.append(df)
        return keep(df, name)
    monkeypatch.setattr(H, "written_once", seen)
    return frames


def test_items_meet_the_written_orders(spark, sf_small, monkeypatch):
    """No child of the orders is aggregated a second time for the items."""
    written = _written(monkeypatch)
    P = H.populations(G.full_model(spark, sf_small), geo=False)
    P.di
    plans = [f._jdf.queryExecution().optimizedPlan().toString() for f in written]
    assert [("o_orderdate" in x) for x in plans] == [False, False, False, True, False]      # three children, orders, items


def test_children_are_written_alone_and_removed(spark, sf_small, monkeypatch):
    """The shuffles of all children together stood on disk when the orders were joined."""
    written, kept = _written(monkeypatch), []
    monkeypatch.setattr(H, "remove_written", lambda df, f=H.remove_written: (kept.extend(df.inputFiles()), f(df)))
    P = H.populations(G.full_model(spark, sf_small), geo=False)
    assert P.orders.count() == P.f.count() > 0
    assert [len(f.columns) for f in written[:3]] == [5, 4, 4]
    assert len({str(Path(f).parent) for f in kept}) == 3 and not any(Path(f.removeprefix("file://")).exists() for f in kept)
    assert all(Path(f.removeprefix("file://")).exists() for f in P.f.inputFiles())


def test_register_corrects_p_values_that_are_written(spark, sf_small, monkeypatch):
    """The correction joins on p-values: run twice, a test may differ in its last digits, and its q was lost.  No job has
    the plans of all tests."""
    written = _written(monkeypatch)
    register = H.hypothesis_register(G.full_model(spark, sf_small), FIXTURE_HYPOTHESES)
    assert all("/register-" in f for f in register.inputFiles())
    rows = register.collect()
    assert len(rows) == 26 and all((r["p_value"] is None) == (r["q_bh"] is None) for r in rows)
    tests = [f._jdf.queryExecution().optimizedPlan().toString().count("Window ") for f in written]
    assert max(tests) <= 12 and len([f for f in written if f.columns == H.SCHEMA_COLS]) == 18      # 17 parts and their union


def test_rank_correlations_write_what_they_read(spark, sf_small, monkeypatch):
    """Whole populations give the same statistics."""
    m, written = G.full_model(spark, sf_small), _written(monkeypatch)
    got = _rows(H.spearman_table(m))
    orders = set(H.SPEARMAN_ORDERS) - set(H.GEO_COLUMNS) | {"only_seller"}
    upto = [set(f.columns) for f in written].index(orders)
    assert [f.columns for f in written[:upto]] == [["order_id", "item_count", "seller_count", "only_seller"],
                                                   ["order_id", "review_answer_timestamp", "review_score", "has_comment"]]
    plans = "".join(f._jdf.queryExecution().optimizedPlan().toString() for f in written[:upto])
    assert "payment" not in plans and "sum(" not in plans
    assert [f.columns for f in written if "product_weight_g" in f.columns] == [H.SPEARMAN_ITEMS]
    monkeypatch.setattr(H, "populations", lambda m, **_: H.Populations(m))
    assert got == _rows(H.spearman_table(m))


def test_kruskal_writes_what_it_reads(spark, sf_small, monkeypatch):
    """Whole populations give the same statistic."""
    m, written = G.full_model(spark, sf_small), _written(monkeypatch)
    got = _rows(H.kruskal_table(m))
    columns = [f.columns for f in written]
    upto = columns.index(H.KRUSKAL_ORDERS)
    assert columns[:upto] == [["order_id", "item_count"], ["order_id", "review_answer_timestamp", "review_score"]]
    plans = "".join(f._jdf.queryExecution().optimizedPlan().toString() for f in written[:upto])
    assert "collect_set" not in plans and "sum(" not in plans      # neither payments nor sellers nor sums
    assert H.KRUSKAL_ITEMS in columns
    monkeypatch.setattr(H, "populations", lambda m, **_: H.Populations(m))
    assert got == _rows(H.kruskal_table(m))
