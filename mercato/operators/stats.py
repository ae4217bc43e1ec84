"""Statistical tests as Spark aggregates plus a closing Arrow UDF (§2.12).

Spark reduces the data to sufficient statistics (counts, means, sample
variances, rank sums, tie sums): one row per test.  Only that row crosses
into Python, where the t / chi-square tails are evaluated.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql.types import DoubleType
from pyspark.sql import functions as F

from mercato.functions import stat_tails as T
from mercato.operators.ranks import rank_table, step_up


@F.pandas_udf(DoubleType())
def t_pvalue(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([T.t_two_sided_p(float(a), float(b)) if pd.notna(a) and pd.notna(b) else None
                      for a, b in zip(t, df)], dtype="float64")


@F.pandas_udf(DoubleType())
def t_critical(df: pd.Series) -> pd.Series:
    return pd.Series([T.t_quantile(0.975, float(v)) if pd.notna(v) else None for v in df], dtype="float64")


@F.pandas_udf(DoubleType())
def chi2_pvalue(x: pd.Series, k: pd.Series) -> pd.Series:
    return pd.Series([T.chi2_sf(float(a), float(b)) if pd.notna(a) and pd.notna(b) else None
                      for a, b in zip(x, k)], dtype="float64")


def welch_sufficient(df: DataFrame, flag: Column, metric: str) -> DataFrame:
    """n, mean and sample variance of ``metric`` for flag true (a) and false
    (b).  A null flag counts as false; a null metric is dropped."""
    d = df.filter(F.col(metric).isNotNull()).select(
        F.coalesce(flag, F.lit(False)).alias("_g"), F.col(metric).cast("double").alias("_x"))
    a, b = F.col("_g"), ~F.col("_g")
    return d.agg(F.count_if(a).alias("n_a"), F.count_if(b).alias("n_b"),
                 F.avg(F.when(a, F.col("_x"))).alias("mean_a"), F.avg(F.when(b, F.col("_x"))).alias("mean_b"),
                 F.var_samp(F.when(a, F.col("_x"))).alias("var_a"),
                 F.var_samp(F.when(b, F.col("_x"))).alias("var_b"))


def welch_sufficient_many(df: DataFrame, specs) -> DataFrame:
    """Sufficient statistics of several Welch tests on one population in a
    single aggregation pass.  ``specs``: (id, condition or None, flag, metric);
    the condition restricts a test to a sub-population.  One row per test."""
    aggs, parts = [], []
    for i, (hid, cond, flag, metric) in enumerate(specs):
        x = F.col(metric).cast("double")
        valid = x.isNotNull() if cond is None else (x.isNotNull() & F.coalesce(cond, F.lit(False)))
        g = F.coalesce(flag, F.lit(False))
        a, b = valid & g, valid & ~g
        aggs += [F.count_if(a).alias(f"_na{i}"), F.count_if(b).alias(f"_nb{i}"),
                 F.avg(F.when(a, x)).alias(f"_ma{i}"), F.avg(F.when(b, x)).alias(f"_mb{i}"),
                 F.var_samp(F.when(a, x)).alias(f"_va{i}"), F.var_samp(F.when(b, x)).alias(f"_vb{i}")]
        parts.append(f"'{hid}', _na{i}, _nb{i}, _ma{i}, _mb{i}, _va{i}, _vb{i}")
    wide = df.agg(*aggs)
    return wide.selectExpr(f"stack({len(specs)}, {', '.join(parts)}) AS (id, n_a, n_b, mean_a, mean_b, var_a, var_b)")


def welch_close(s: DataFrame) -> DataFrame:
    """Effect, standard error, Welch-Satterthwaite df, 95 % CI and p from the
    sufficient statistics (needs n >= 2 in both groups)."""
    ok = (F.col("n_a") >= 2) & (F.col("n_b") >= 2)
    vx, vy = F.col("var_a") / F.col("n_a"), F.col("var_b") / F.col("n_b")
    s = (s.withColumn("effect", F.when(ok, F.col("mean_a") - F.col("mean_b")))
         .withColumn("se", F.when(ok, F.sqrt(vx + vy)))
         .withColumn("df", F.when(ok, F.pow(vx + vy, 2) / (F.pow(vx, 2) / (F.col("n_a") - 1)
                                                             + F.pow(vy, 2) / (F.col("n_b") - 1)))))
    s = s.withColumn("p_value", t_pvalue(F.col("effect") / F.col("se"), F.col("df")))
    margin = t_critical(F.col("df")) * F.col("se")
    return (s.withColumn("ci_low", F.col("effect") - margin).withColumn("ci_high", F.col("effect") + margin))


def welch_test(df: DataFrame, flag: Column, metric: str) -> DataFrame:
    """H-W: two-sided Welch test of ``metric`` between flag groups."""
    return welch_close(welch_sufficient(df, flag, metric))


def spearman_rho(df: DataFrame, x: str, y: str) -> DataFrame:
    """Complete pairs, average ranks (distributed mid-rank, W09), Pearson
    correlation of the ranks.  One row: n, rho (null without spread)."""
    xy = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        F.col(x).alias("_x"), F.col(y).alias("_y"))
    # Rows are reduced to counted value pairs first (map-side), so a value that many
    # rows share is one row a partner in the joins with the rank tables.
    pairs = xy.groupBy("_x", "_y").agg(F.count(F.lit(1)).alias("_c"))
    rx, ry = rank_table(xy, "_x", "_rx"), rank_table(xy, "_y", "_ry")
    ranked = pairs.join(rx.select("_x", "_rx"), "_x").join(ry.select("_y", "_ry"), "_y")
    # Ranks have mean (n + 1) / 2; the sums close the correlation.
    c, x, y = F.col("_c"), F.col("_rx"), F.col("_ry")
    s = ranked.agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("n"), F.sum(c * x * y).alias("_xy"), F.sum(c * x * x).alias("_xx"),
                   F.sum(c * y * y).alias("_yy"))
    base = F.col("n") * F.pow((F.col("n") + 1) / 2.0, 2)
    spread = F.sqrt((F.col("_xx") - base) * (F.col("_yy") - base))
    return s.select("n", F.when(spread > 0, (F.col("_xy") - base) / spread).alias("rho"))


def spearman_test(df: DataFrame, x: str, y: str) -> DataFrame:
    """H-S: rho and its two-sided p from t with n - 2 degrees of freedom."""
    r = spearman_rho(df, x, y)
    t = F.col("rho") * F.sqrt((F.col("n") - 2) / ((F.lit(1.0) + F.col("rho")) * (F.lit(1.0) - F.col("rho"))))
    return r.withColumn("p_value", F.when(F.abs(F.col("rho")) >= 1, F.lit(0.0))
                        .otherwise(t_pvalue(t, (F.col("n") - 2).cast("double"))))


def top_groups(df: DataFrame, group: str, k: int) -> DataFrame:
    """The k most frequent groups (count desc, then group asc)."""
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    return counts.orderBy(F.col("_n").desc(), F.col(group).asc()).limit(k).select(group)


def kruskal_statistic(df: DataFrame, group: str, metric: str, top_k: int | None = None) -> DataFrame:
    """H-K statistic with tie correction, over the ``top_k`` most frequent
    groups.  Ranks are taken per distinct value (counts, prefix sums), so the
    work is aggregates only: no row is ever ranked in one task.
    One row: n, k, h."""
    d = df.filter(F.col(metric).isNotNull() & F.col(group).isNotNull())
    if top_k:
        d = d.join(F.broadcast(top_groups(d, group, top_k)), group, "left_semi")
    ranks = rank_table(d, metric, "_rank")                    # value, n, _rank
    per = (d.groupBy(group, metric).agg(F.count(F.lit(1)).alias("_c"))
           .join(ranks.select(metric, "_rank"), metric)
           .groupBy(group).agg(F.sum("_c").alias("_ni"), F.sum(F.col("_c") * F.col("_rank")).alias("_ri")))
    sums = per.agg(F.sum("_ni").alias("n"), F.count(F.lit(1)).alias("k"),
                   F.sum(F.pow("_ri", 2) / F.col("_ni")).alias("_s"))
    ties = ranks.agg(F.sum(F.pow(F.col("n").cast("double"), 3) - F.col("n")).alias("_t"))
    n = F.col("n").cast("double")
    h = F.lit(12.0) / (n * (n + 1)) * F.col("_s") - 3 * (n + 1)
    corr = F.lit(1.0) - F.col("_t") / (F.pow(n, 3) - n)
    return sums.crossJoin(ties).select("n", "k", (h / corr).alias("h"))


def kruskal_test(df: DataFrame, group: str, metric: str, top_k: int | None = None) -> DataFrame:
    s = kruskal_statistic(df, group, metric, top_k)
    return s.withColumn("p_value", chi2_pvalue(F.col("h"), (F.col("k") - 1).cast("double")))


def benjamini_hochberg(df: DataFrame, p: str = "p_value", out: str = "q_bh") -> DataFrame:
    """H-BH: step-up adjusted q, clipped to [0, 1].  Null p stays null and
    does not count in m.  Equal p have equal q, so the steps run over the
    distinct p with the distributed rank operators; a table of millions of
    p-values (one per seller, say) never sits in one task."""
    steps = step_up(df, p, lambda x, rank, m: x * m / rank, "_q")
    steps = steps.select(F.col(p).alias("_p"), F.least(F.greatest(F.col("_q"), F.lit(0.0)), F.lit(1.0)).alias(out))
    return df.join(steps, df[p] == steps["_p"], "left").drop("_p")


# Conclusions of the register.
OBSERVED, NOT_OBSERVED = "Observee", "Non observee"
INCONCLUSIVE = "Non concluante"
TOO_FEW = "Effectif insuffisant"
EXPECTED_DIRECTION = "Association dans le sens attendu"
OPPOSITE_DIRECTION = "Association dans le sens oppose"


def conclude(df: DataFrame, q: str = "q_bh", effect: str = "effect", direction: str = "direction") -> DataFrame:
    """H-C: q >= 0.05 inconclusive; else the sign of effect x direction."""
    c = (F.when(F.col(q).isNull() & F.col("conclusion").isNull(), F.lit(TOO_FEW))
         .when(F.col(q).isNull(), F.col("conclusion"))
         .when(F.col(q) >= 0.05, F.lit(INCONCLUSIVE))
         .when(F.col(effect) * F.col(direction) > 0, F.lit(EXPECTED_DIRECTION))
         .otherwise(F.lit(OPPOSITE_DIRECTION)))
    return df.withColumn("conclusion", c)


def describe(observed: Column, supported: Column) -> Column:
    """H-D: descriptive conclusion against an explicit threshold."""
    return F.when(supported, F.lit(OBSERVED)).otherwise(F.lit(NOT_OBSERVED))
