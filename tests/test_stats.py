"""Distribution tails and test operators against published values."""

import math

import pytest
from pyspark.sql import functions as F

from mercato.functions import stat_tails as T
from mercato.operators import stats as S

# Published (rho, n, p) of the Spearman hypotheses and the Kruskal statistic.
SPEARMAN_PUBLISHED = [(-0.03699962296712488, 1854, 0.11124898295569768),
                      (-0.0007077042490893823, 78277, 0.8430461986442893)]
KRUSKAL_PUBLISHED = (237.54037421401628, 9, 4.241045820239096e-46)
P_PUBLISHED = [9.831130988622959e-64, 0.11124898295569768, 1.0281637435317428e-209, 0.0, 0.0,
               1.2293407563766843e-10, 2.875622615613197e-147, 2.9782690003361037e-285, 0.0, 1.288937206079446e-35,
               4.241045820239096e-46, 0.0, 0.8430461986442893, 0.0, 0.004644822383609228, 0.0]
Q_PUBLISHED = [1.5729809581796734e-63, 0.11866558181941086, 2.0563274870634857e-209, 0.0, 0.0,
               1.513034777078996e-10, 5.112217983312351e-147, 6.807472000768237e-285, 0.0, 1.7185829414392612e-35,
               6.168793920347776e-46, 0.0, 0.8430461986442893, 0.0, 0.0053083684384105465, 0.0]


def spearman_p(rho, n):
    t = rho * math.sqrt((n - 2) / ((1 + rho) * (1 - rho)))
    return T.t_two_sided_p(t, n - 2)


@pytest.mark.parametrize("rho,n,p", SPEARMAN_PUBLISHED)
def test_spearman_tail_matches_published(rho, n, p):
    assert spearman_p(rho, n) == pytest.approx(p, rel=1e-9)


def test_kruskal_tail_matches_published():
    h, k, p = KRUSKAL_PUBLISHED
    assert T.chi2_sf(h, k) == pytest.approx(p, rel=1e-9)


def test_t_quantile():
    assert T.t_quantile(0.975, 10) == pytest.approx(2.2281388519649385, rel=1e-9)
    assert T.t_quantile(0.975, 1e7) == pytest.approx(1.959963984540054, rel=1e-6)


def test_benjamini_hochberg_reproduces_published_q(spark):
    rows = [(f"T{i:02d}", p) for i, p in enumerate(P_PUBLISHED)] + [("D01", None)]
    df = spark.createDataFrame(rows, "id string, p_value double")
    out = {r["id"]: r["q_bh"] for r in S.benjamini_hochberg(df).collect()}
    assert out["D01"] is None
    for i, q in enumerate(Q_PUBLISHED):
        assert out[f"T{i:02d}"] == pytest.approx(q, rel=1e-12, abs=0.0)


def test_welch_against_hand_computation(spark):
    a = [1.0, 2.0, 3.0, 4.0, 5.0]
    b = [2.0, 4.0, 6.0, 8.0]
    df = spark.createDataFrame([(True, x) for x in a] + [(False, x) for x in b] + [(None, 7.0)], "g boolean, x double")
    r = S.welch_test(df, F.col("g"), "x").first()
    va, vb = 2.5 / 5, (20 / 3) / 4
    se = math.sqrt(va + vb)
    dfree = (va + vb) ** 2 / (va ** 2 / 4 + vb ** 2 / 3)
    assert r["n_a"] == 5 and r["n_b"] == 5            # a null flag counts as false
    b2 = b + [7.0]
    mb = sum(b2) / 5
    vb2 = sum((x - mb) ** 2 for x in b2) / 4 / 5
    se2 = math.sqrt(va + vb2)
    assert r["effect"] == pytest.approx(3.0 - mb)
    assert r["se"] == pytest.approx(se2)
    dfree2 = (va + vb2) ** 2 / (va ** 2 / 4 + vb2 ** 2 / 4)
    assert r["df"] == pytest.approx(dfree2)
    assert r["p_value"] == pytest.approx(T.t_two_sided_p((3.0 - mb) / se2, dfree2))
    assert se > 0 and dfree > 0


def test_spearman_and_kruskal_operators(spark):
    xs = [1, 2, 2, 3, 4, 5, 5, 5, 6]
    ys = [2, 1, 4, 3, 6, 5, 7, 7, 9]
    df = spark.createDataFrame(list(zip(xs, ys)) + [(None, 1)], "x int, y int")
    r = S.spearman_test(df, "x", "y").first()
    import pandas as pd
    rho = pd.Series(xs).rank().corr(pd.Series(ys).rank())
    assert r["n"] == 9 and r["rho"] == pytest.approx(rho)
    g = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("b", 3), ("b", 4), ("c", 2), ("c", 5), ("c", 5)],
                              "g string, v int")
    k = S.kruskal_test(g, "g", "v").first()
    # Hand computation with mid-ranks: values 1,2,2,2,3,4,5,5 -> ranks 1,3,3,3,5,6,7.5,7.5
    ra, rb, rc = 1 + 3 + 3, 5 + 6, 3 + 7.5 + 7.5
    n = 8
    h = 12 / (n * (n + 1)) * (ra ** 2 / 3 + rb ** 2 / 2 + rc ** 2 / 3) - 3 * (n + 1)
    c = 1 - ((3 ** 3 - 3) + (2 ** 3 - 2)) / (n ** 3 - n)
    assert k["h"] == pytest.approx(h / c)
    assert k["p_value"] == pytest.approx(T.chi2_sf(h / c, 2))


def test_fused_welch_equals_single_tests(spark):
    rows = [(i % 3 == 0, float((i * 7) % 11), None if i % 5 == 0 else i % 4) for i in range(60)]
    df = spark.createDataFrame(rows, "g boolean, x double, c int")
    specs = [("A", None, F.col("g"), "x"), ("B", F.col("c").isNotNull(), F.col("c") > 1, "x")]
    fused = {r["id"]: r for r in S.welch_sufficient_many(df, specs).collect()}
    a = S.welch_sufficient(df, F.col("g"), "x").first()
    b = S.welch_sufficient(df.filter(F.col("c").isNotNull()), F.col("c") > 1, "x").first()
    for got, want in ((fused["A"], a), (fused["B"], b)):
        assert got["n_a"] == want["n_a"] and got["n_b"] == want["n_b"]
        for k in ("mean_a", "mean_b", "var_a", "var_b"):
            assert got[k] == pytest.approx(want[k])
