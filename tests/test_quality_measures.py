"""Quality checks on an explicit orphan case and semantic-model filter rules."""

from pyspark.sql import functions as F

from mercato.operators import quality as Q
from mercato.plans import measures as MS
from mercato.plans import registry


def test_orphans_duplicates_and_reconcile(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    child = spark.createDataFrame([(1,), (3,), (None,)], "pid int")
    assert Q.dq_orphans(child, "pid", parent, "id").first()["value"] == 2
    assert Q.dq_duplicate_keys(parent, "id").first()["value"] == 1
    assert Q.dq_null_keys(child, "pid").first()["value"] == 1
    a = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0)], "k int, v double")
    b = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.5), (4, 1.0)], "k int, v double")
    bad = {r["k"] for r in Q.reconcile(a, b, "k", ["v"]).collect()}
    assert bad == {3, 4}
    assert Q.reconcile(a, b, "k", ["v"], tol=1.0).count() == 1


def test_policy_raise(spark):
    rep = spark.createDataFrame([("duplicate keys: orders", 2)], "check_name string, value long")
    import pytest
    with pytest.raises(Q.QualityError):
        Q.enforce(rep, "raise", ["duplicate keys: orders"])


def test_product_filter_leaves_order_measures(spark, sf_small):
    sm = MS.semantic_model(registry.full_model(spark, sf_small))
    base = sm.evaluate(["gmv", "orders_delivered", "gmv_items"]).first()
    ctx = MS.Context(filters=[("DimProducts", F.col("category") == "medium")])
    filt = sm.evaluate(["gmv", "orders_delivered", "gmv_items"], ctx).first()
    assert filt["gmv"] == base["gmv"] and filt["orders_delivered"] == base["orders_delivered"]
    assert filt["gmv_items"] < base["gmv_items"]


def test_unrelated_axis_repeats_total(spark, sf_small):
    sm = MS.semantic_model(registry.full_model(spark, sf_small))
    by_cat = sm.evaluate(["orders_delivered"], MS.Context(group_by=[("DimProducts", "category")])).collect()
    total = sm.evaluate(["orders_delivered"]).first()["orders_delivered"]
    assert by_cat and all(r["orders_delivered"] == total for r in by_cat)
