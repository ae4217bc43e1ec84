"""Exact quantiles by distributed selection equal the one-buffer answers."""

import random

import pytest
from pyspark.sql import functions as F

from mercato.operators.aggregates import boxplot_stats, geo_median
from mercato.operators.quantiles import exact_quantiles

SHARES = {"q0": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99, "top": 1.0}


def plain(df, by, value):
    return df.filter(F.col(value).isNotNull()).groupBy(*by).agg(
        F.count(value).alias("n"), F.percentile(F.col(value).cast("double"), F.array(*[F.lit(p) for p in SHARES.values()])).alias("_q")).select(
        *by, "n", *[F.col("_q")[i].alias(c) for i, c in enumerate(SHARES)])


def case(spark, rows=6000, seed=2):
    rng = random.Random(seed)
    data = [(rng.choice(["hot", "hot", "hot", "a", None]) if i % 50 else f"g{i}", rng.choice([1.0, 1.0, 2.0, None, i % 97 / 8, rng.gauss(0, 5)])) for i in range(rows)]
    return spark.createDataFrame(data, "g string, v double").repartition(5)


def test_groups_equal_percentile(spark):
    df = case(spark)
    got = exact_quantiles(df, ["g"], "v", SHARES)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, plain(df, ["g"], "v").collect()), key=str)


def test_without_groups(spark):
    df = case(spark)
    assert exact_quantiles(df, [], "v", SHARES).collect()[0].asDict() == plain(df, [], "v").collect()[0].asDict()


@pytest.mark.parametrize("values", [[], [None, None], [4.0], [4.0, None, 4.0], [1.0, 2.0], [1.0, 2.0, 9.0]])
def test_few_values(spark, values):
    df = spark.createDataFrame([(x,) for x in values], "v double")
    got = exact_quantiles(df, [], "v", {"m": 0.5}).collect()
    have = sorted(x for x in values if x is not None)
    k = len(have)
    want = (have[(k - 1) // 2] + have[k // 2]) / 2 if k else None
    assert [(r["n"], r["m"]) for r in got] == [(k, want)]


def test_no_buffer_of_values_and_no_job(spark):
    df = case(spark, 500)
    plan = exact_quantiles(df, ["g"], "v", SHARES)._jdf.queryExecution().toString()
    assert "percentile(" not in plan and "median(" not in plan


def test_types(spark):
    df = spark.range(11).selectExpr("cast(id as int) as i", "cast(id / 4 as decimal(10,2)) as d")
    assert exact_quantiles(df, [], "i", {"m": 0.5}).collect()[0]["m"] == 5.0
    assert exact_quantiles(df, [], "d", {"m": 0.25}).collect()[0]["m"] == 0.625


def test_geo_median_equals_the_plain_median(spark):
    rng = random.Random(8)
    rows = [(str(rng.choice([1, 1, 1, 2, 3])), rng.uniform(-40, 10), rng.uniform(-80, -30)) for _ in range(900)] + [("4", None, -50.0), (None, -10.0, -50.0)]
    geo = spark.createDataFrame(rows, "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double")
    ok = geo.filter("geolocation_lat between -34 and 6 and geolocation_lng between -74 and -34")
    want = ok.groupBy("geolocation_zip_code_prefix").agg(F.median("geolocation_lat"), F.median("geolocation_lng"))
    pick = lambda x: sorted(map(tuple, x.collect()), key=str)
    assert pick(geo_median(geo)) == pick(want)


def test_boxplot_whiskers_drop_outliers(spark):
    df = spark.createDataFrame([(1, float(x)) for x in [1, 2, 3, 4, 5, 100]] + [(0, 7.0), (0, None), (None, 3.0)], "g int, v double")
    got = {r["g"]: r for r in boxplot_stats(df, "g", "v").collect()}
    assert (got[1]["whisker_low"], got[1]["whisker_high"], got[1]["median"]) == (1.0, 5.0, 3.5)
    assert got[0]["n"] == 1 and got[0]["whisker_low"] == 7.0 and got[None]["median"] == 3.0
