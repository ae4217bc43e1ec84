"""The one-pass report equals the single checks, on broken tables; range digests find what differs."""

import pytest
from pyspark.sql import functions as F

from mercato.operators import quality as Q


@pytest.fixture(scope="module")
def broken(spark):
    def make(rows, schema):
        return spark.createDataFrame(rows, schema).repartition(3)
    return {
        "orders": make([("a", "c1"), ("b", "c2"), ("b", "c9"), ("", None), (None, "c1"), (None, "c1")], "order_id string, customer_id string"),
        "customers": make([("c1",), ("c2",), ("c2",), (None,)], "customer_id string"),
        "products": make([("p1",), ("p2",)], "product_id string"),
        "sellers": make([("s1",), ("s1",), ("s1",)], "seller_id string"),
        "order_items": make([("a", 1, "p1", "s1", "1.50", "0.10"), ("a", 1, "p1", "s1", "2.00", None), ("a", 11, "p9", "s1", None, "1.00"),
                             ("x", 1, None, "s2", "5.00", "0.00"), (None, None, "p2", "s1", "1.00", "0.00")],
                            "order_id string, order_item_id int, product_id string, seller_id string, price string, freight_value string")
        .withColumn("price", F.col("price").cast("decimal(18,2)")).withColumn("freight_value", F.col("freight_value").cast("decimal(18,2)")),
        "order_payments": make([("a", 1, "3.00"), ("a", 2, "1.00"), ("", 1, "1.00"), ("zz", None, "9.99")],
                               "order_id string, payment_sequential int, payment_value string").withColumn("payment_value", F.col("payment_value").cast("decimal(18,2)")),
        "order_reviews": make([("r1", "a"), ("r1", "a"), ("r2", "b"), (None, "b"), (None, None), ("r3", None)], "review_id string, order_id string"),
    }


def test_integrity_equals_the_single_checks(broken):
    got = {r["check_name"]: (r["value"], r["total"]) for r in Q.integrity(broken).collect()}
    want = {}
    for table, key in Q.KEY_CHECKS:
        want[f"duplicate keys: {table}"] = Q.dq_duplicate_keys(broken[table], key).first()[0]
        want[f"null keys: {table}"] = Q.dq_null_keys(broken[table], key).first()[0]
    for child, col, parent, pk in Q.REFERENCE_CHECKS:
        want[f"missing references: {child}.{col}"] = Q.dq_orphans(broken[child], col, broken[parent], pk).first()[0]
    want["orders with several reviews"] = Q.dq_multi_child(broken["order_reviews"], "order_id").first()[0]
    want["repeated review_id"] = Q.dq_duplicate_keys(broken["order_reviews"], "review_id").first()[0]
    assert {k: v for k, (v, _) in got.items() if v is not None} == want
    for table, columns in Q.AMOUNTS.items():
        for c in columns:
            assert got[f"sum:{table}.{c}"][1] == broken[table].agg(F.sum(c)).first()[0]


def test_each_table_is_read_once(broken):
    plan = Q.integrity(broken)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == len(broken)


def test_treatments(spark):
    rules = spark.createDataFrame([("duplicate keys: orders",), ("repeated review_id",), ("orders without items",)], "c string")
    got = [r[0] for r in rules.select(Q.treatment(F.col("c"))).collect()]
    assert got == [Q.STOP, Q.TREATMENTS["repeated review_id"], Q.KEEP]


def test_only_differing_ranges_are_joined(spark):
    a = spark.range(3000).selectExpr("id as k", "cast(id % 7 as double) as x", "if(id % 5 = 0, null, id) as y")
    assert Q.differing_ranges(a, a.repartition(5), "k", ["x", "y"]).count() == 0
    b = a.filter("k <> 11").withColumn("x", F.when(F.col("k") == 42, 0.5).otherwise(F.col("x"))).unionByName(spark.range(1).selectExpr("-1L as k", "0d as x", "null as y"))
    apart = {r[0] for r in Q.differing_ranges(a, b, "k", ["x", "y"]).collect()}
    assert apart == {r[0] for r in spark.createDataFrame([(11,), (42,), (-1,)], "k long").select(F.pmod(F.xxhash64("k"), F.lit(Q.RANGES))).collect()}
    assert {r["k"] for r in Q.reconcile(a, b, "k", ["x", "y"]).collect()} == {11, 42, -1}
    # Two equal rows in place of two others: sums tell them apart where xor would not.
    twice = spark.createDataFrame([(1, "a"), (1, "a")], "k int, v string")
    other = spark.createDataFrame([(1, "b"), (1, "b")], "k int, v string")
    assert Q.differing_ranges(twice, other, "k", ["v"]).count() == 1


def test_queries_are_listed_without_a_session():
    """The driver asks for the queries' names before it starts Spark."""
    import subprocess
    import sys
    from pathlib import Path
    code = "import __spark_entry__ as e; assert len(e.queries()) > 100 and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parents[1], timeout=120)


def test_keys_are_grouped_once_and_by_numbers(broken):
    """A task holds its groups in memory: one grouping of all tables, whose groups carry no names."""
    rows = Q.integrity(broken)
    lines = rows._jdf.queryExecution().optimizedPlan().toString().splitlines()
    grouped = [line for line in lines if "Aggregate [" in line]
    assert len(grouped) == 2                     # the groups, and the one row of their sums
    assert "Aggregate [code" in grouped[1] and "domain" not in grouped[1] and "table" not in grouped[1]
