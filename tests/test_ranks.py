"""Distributed ranks and running sums equal the single-window answers."""

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from mercato.operators import ranks
from mercato.operators.ordering import BUCKET, in_buckets, number_cell


def test_global_row_number(spark):
    data = [(i, (i * 37) % 11) for i in range(300)]
    df = spark.createDataFrame(data, "id int, v int")
    got = ranks.global_row_number(df, [("v", False), ("id", True)], "rank", partitions=5)
    w = Window.orderBy(F.col("v").desc(), F.col("id").asc())
    want = df.withColumn("rank", F.row_number().over(w))
    assert sorted(got.collect()) == sorted(want.collect())
    assert dict(got.dtypes)["rank"] == "bigint"


def jobs_of(spark, build):
    """Jobs that ``build`` starts before its frame is read."""
    spark.sparkContext.setJobGroup("building", "building")
    try:
        df = build()
        return df, len(spark.sparkContext.statusTracker().getJobIdsForGroup("building"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_building_ranks_starts_no_job_and_writes_nothing(spark):
    df = spark.range(500).withColumn("v", F.col("id") % 50)
    for build in (lambda: ranks.global_row_number(df, ["id"]), lambda: ranks.running_sums(df, ["id"], {"s": "v"}),
                  lambda: ranks.running_min(df, ["id"], "v", "m"), lambda: ranks.average_rank(df, "v"),
                  lambda: ranks.step_up(df, "v", lambda v, r, m: v * m / r, "q")):
        frame, jobs = jobs_of(spark, build)
        assert jobs == 0
        assert "ExistingRDD" not in frame._jdf.queryExecution().executedPlan().toString()


def test_no_window_spans_all_rows(spark):
    df = spark.range(5000).withColumn("v", (F.col("id") * 7919) % 1013)
    rows = in_buckets(df, [("v", False), "id"], 8)
    sizes = [r["count"] for r in rows.groupBy(BUCKET).count().collect()]
    assert len(sizes) == 17 and max(sizes) < 5000 / 5
    edges = rows.groupBy(BUCKET).agg(F.min(F.struct(-F.col("v"), "id")).alias("a"), F.max(F.struct(-F.col("v"), "id")).alias("b")).orderBy(BUCKET).collect()
    assert all(x["b"] < y["a"] for x, y in zip(edges, edges[1:]))


@pytest.mark.parametrize("kind", ["int", "bigint", "double", "float", "decimal(12,2)", "string", "date", "timestamp", "boolean", "binary"])
@pytest.mark.parametrize("up", [True, False])
def test_every_key_type_sorts_as_spark_sorts(spark, kind, up):
    text = {"date": "cast(date'2020-01-01' + cast(id % 40 as int) as string)", "timestamp": "cast(timestamp_seconds(id % 40 * 1000) as string)",
            "boolean": "cast(id % 2 = 0 as string)", "string": "repeat('ab', cast(id % 7 as int)) || (id % 3)", "binary": "repeat('ab', cast(id % 7 as int))",
            "double": "if(id % 13 = 0, 'NaN', cast((id % 9 - 4) / 2 as string))", "float": "if(id % 13 = 0, 'NaN', cast((id % 9 - 4) / 2 as string))"}
    df = spark.range(400).selectExpr("id", f"if(id % 11 = 0, null, cast({text.get(kind, 'cast(id % 37 - 18 as string)')} as {kind})) as v")
    got = ranks.global_row_number(df, [("v", up), "id"], "rank", partitions=4)
    v = F.col("v").asc_nulls_first() if up else F.col("v").desc_nulls_last()
    want = df.withColumn("rank", F.row_number().over(Window.orderBy(v, "id")))
    pick = lambda x: sorted((r["id"], r["rank"]) for r in x.collect())
    assert pick(got) == pick(want)


def test_extremes_of_integers_fall_too(spark):
    df = spark.createDataFrame([(-2**63,), (2**63 - 1,), (0,), (-1,), (None,)], "v long")
    got = ranks.global_row_number(df, [("v", False)], "rank", partitions=1).orderBy("rank").collect()
    assert [r["v"] for r in got] == [2**63 - 1, 0, -1, -2**63, None]


def test_step_up_equals_the_plain_minimum(spark):
    rows = [(i, (i * 37 % 61) / 61) for i in range(150)]
    df = spark.createDataFrame(rows, "id int, p double")
    got = {r["p"]: r["q"] for r in ranks.step_up(df, "p", lambda p, r, m: p * m / r, "q").collect()}
    values = sorted(p for _, p in rows)
    adj = [p * 150 / (k + 1) for k, p in enumerate(values)]
    assert len(got) == len(set(values))
    for k, p in enumerate(values):
        assert got[p] == pytest.approx(min(adj[k:]))


def test_cells_never_fall(spark):
    values = [float("-inf"), -1e308, -8.0, -7.999, -1e-300, -5e-324, 0.0, 5e-324, 2.2e-308, 1e-3, 0.125, 0.5, 1.0, 1.0000001, 7.9999999999, 8.0,
              8.001, 1e15, 2.0**62, 1.7e308, float("inf"), float("nan")] + [k / 7 for k in range(1, 3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").withColumn("cell", number_cell(F.col("v")))
    cells = [r["cell"] for r in df.orderBy("v").collect()]
    assert cells == sorted(cells) and len(set(cells)) > 1500
    big = spark.range(5).selectExpr("9223372036854775803 + id as v").withColumn("cell", number_cell(F.col("v"))).orderBy("v").collect()
    assert [r["cell"] for r in big] == sorted(r["cell"] for r in big)


def test_ranks_of_counted_values_share_their_shuffle(spark):
    """The bounds, the bucket totals and the rows read one shuffle of the counts."""
    df = spark.range(100_000).withColumn("v", F.col("id") % 3000)
    table = ranks.rank_table(df, "v")
    table.collect()
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("Range (0, 100000") == 1, plan


def test_empty_input(spark):
    df = spark.createDataFrame([], "id long, v double")
    assert ranks.global_row_number(df, ["id"]).collect() == []
    assert ranks.running_sums(df, ["id"], {"s": "v"}).collect() == []
    assert ranks.average_rank(df, "v").collect() == []


def test_seller_numbers_keep_all_digits(spark):
    from mercato.plans.measures import seller_labels
    ids = spark.range(10_050).select(F.format_string("s%06d", "id").alias("seller_id"))
    got = {r["seller_id"]: r["Vendeur"] for r in seller_labels(ids).collect()}
    assert len(set(got.values())) == 10_050
    assert got["s000000"] == "Vendeur 0001" and got["s010049"] == "Vendeur 10050"


def test_running_sums(spark):
    df = spark.createDataFrame([(i, float(i % 7)) for i in range(200)], "id int, x double")
    got = ranks.running_sums(df, ["id"], {"cum": "x"}, partitions=4).orderBy("id").collect()
    acc = 0.0
    for r in got:
        acc += r["x"]
        assert r["cum"] == pytest.approx(acc)


def test_average_rank_matches_pandas(spark):
    vals = [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, v int")
    got = {r["id"]: r["rank"] for r in ranks.average_rank(df, "v", "rank", partitions=3).collect()}
    want = pd.Series(vals, dtype="float").rank()
    for i, v in enumerate(want):
        if pd.isna(v):
            assert got[i] is None
        else:
            assert got[i] == pytest.approx(v)


def test_running_min_descending(spark):
    vals = [(i, float((i * 13) % 17)) for i in range(150)]
    df = spark.createDataFrame(vals, "i int, x double")
    got = {r["i"]: r["m"] for r in ranks.running_min(df, [("i", False)], "x", "m", partitions=4).collect()}
    for i, _ in vals:
        assert got[i] == min(x for j, x in vals if j >= i)


def test_dense_rank_top_keeps_ties(spark):
    from mercato.operators.windows import dense_rank_top
    df = spark.createDataFrame([(k, v) for k, v in enumerate([5, 9, 9, 7, 7, 7, 1, None, 3])], "k int, v int")
    got = {r["k"]: r["top"] for r in dense_rank_top(df, "v", 3, "top").collect()}
    assert {k for k, v in got.items() if v is not None} == {0, 1, 2, 3, 4, 5}
