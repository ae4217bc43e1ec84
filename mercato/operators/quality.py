"""Data-quality operators (Q-family).

Each check is a one-row aggregate; ``dq_report`` unions them so they run as
one job.  Checks *report* by default; ``policy="raise"`` turns a non-zero
result into an error the way the study stops on a broken key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions.columns import days_between


class QualityError(ValueError):
    pass


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def dq_duplicate_keys(df: DataFrame, key) -> DataFrame:
    """Q-01/Q-05: rows beyond the first per key (nulls form a key too)."""
    g = df.groupBy(*_keys(key)).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("value"))


def dq_null_keys(df: DataFrame, key) -> DataFrame:
    """Q-02: rows with a null key part."""
    cond = None
    for k in _keys(key):
        cond = F.col(k).isNull() if cond is None else (cond | F.col(k).isNull())
    return df.agg(F.count_if(cond).alias("value"))


def dq_orphans(child: DataFrame, col: str, parent: DataFrame, pk: str) -> DataFrame:
    """Q-03/J10: child rows whose reference has no parent."""
    p = parent.select(F.col(pk).alias(col)).distinct()
    return child.select(col).join(p, col, "left_anti").agg(F.count(F.lit(1)).alias("value"))


def dq_multi_child(child: DataFrame, key: str) -> DataFrame:
    """Q-04: parents with more than one child row."""
    return (child.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
            .agg(F.count_if(F.col("_n") > 1).alias("value")))


def count_where(df: DataFrame, cond: Column) -> DataFrame:
    """Q-06..Q-11: conditional count as a one-row frame (null condition = false)."""
    return df.agg(F.count_if(F.coalesce(cond, F.lit(False))).alias("value"))


def count_many(df: DataFrame, checks: list[tuple[str, Column]]) -> DataFrame:
    """Several conditional counts in one pass over ``df``, as (check_name, value) rows."""
    wide = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(f"_c{i}") for i, (_, c) in enumerate(checks)])
    labels = ", ".join(f"'{n}', _c{i}" for i, (n, _) in enumerate(checks))
    return wide.selectExpr(f"stack({len(checks)}, {labels}) AS (check_name, value)")


def dq_total_preserved(before: DataFrame, col_before: str, after: DataFrame, col_after: str) -> DataFrame:
    """Q-12: 1 when the sum is the same before and after a join, else 0."""
    a = before.agg(F.sum(col_before).alias("_a"))
    b = after.agg(F.sum(col_after).alias("_b"))
    same = F.col("_a").eqNullSafe(F.col("_b"))
    return a.crossJoin(b).select(F.when(same, 1).otherwise(0).cast("long").alias("value"))


def dq_join_cardinality(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Q-13: many-to-one check: duplicates on the 'one' side and the change in
    row count caused by the join (both must be 0)."""
    dup = dq_duplicate_keys(right, key).withColumnRenamed("value", "right_duplicates")
    n_left = left.agg(F.count(F.lit(1)).alias("_l"))
    n_join = left.join(right, key, how).agg(F.count(F.lit(1)).alias("_j"))
    return dup.crossJoin(n_left).crossJoin(n_join).select(
        "right_duplicates", (F.col("_j") - F.col("_l")).alias("extra_rows"))


def enforce(report: DataFrame, policy: str = "report", stop_checks: Sequence[str] = ()) -> DataFrame:
    """Apply a policy to a report: ``raise`` fails on a non-zero stop check."""
    if policy == "raise" and stop_checks:
        bad = report.filter(F.col("check_name").isin(list(stop_checks)) & (F.col("value") != 0)).limit(1).collect()
        if bad:
            raise QualityError(f"quality check failed: {bad[0]['check_name']} = {bad[0]['value']}")
    return report


#: Ranges of key hashes that two builds are compared by first.
RANGES = 4096


def range_digests(df: DataFrame, key: str, cols: Sequence[str], ranges: int = RANGES) -> DataFrame:
    """(range, rows, s1, s2): per range of key hashes the row count and two sums of 64-bit row hashes, exact and free of any
    order: at most ``ranges`` rows, to keep beside a build and compare later ones with."""
    row = [F.col(key), *[F.col(c) for c in cols]]
    s1, s2 = F.xxhash64(*row), F.xxhash64(F.lit(1), *row)
    return (df.groupBy(F.pmod(F.xxhash64(key), F.lit(ranges)).alias("range"))
            .agg(F.count(F.lit(1)).alias("rows"), F.sum(s1.cast("decimal(38,0)")).alias("s1"), F.sum(s2.cast("decimal(38,0)")).alias("s2")))


def differing_ranges(a: DataFrame, b: DataFrame, key: str, cols: Sequence[str], ranges: int = RANGES) -> DataFrame:
    """The ranges in which two builds differ, from one aggregate a side."""
    x = range_digests(a, key, cols, ranges).select("range", F.struct("rows", "s1", "s2").alias("x"))
    y = range_digests(b, key, cols, ranges).select("range", F.struct("rows", "s1", "s2").alias("y"))
    return x.join(y, "range", "full_outer").filter(~F.col("x").eqNullSafe(F.col("y"))).select("range")


def reconcile(a: DataFrame, b: DataFrame, key: str, cols: Sequence[str], tol: float = 0.0, ranges: int = RANGES) -> DataFrame:
    """Q-15: per-key comparison of two builds; null equals null; numeric
    columns within ``tol``.  Returns the mismatching keys with a flag per column.

    Digests per range of key hashes come first; only rows of differing ranges
    are joined, so equal builds move no rows.  Both sides need the same column types."""
    apart = F.broadcast(differing_ranges(a, b, key, cols, ranges))      # ``ranges`` rows at most
    kept = lambda df: (df.select(key, *cols).withColumn("range", F.pmod(F.xxhash64(key), F.lit(ranges)))
                       .join(apart, "range", "left_semi").drop("range"))
    a, b = kept(a), kept(b)
    j = a.select(key, *[F.col(c).alias(f"a_{c}") for c in cols]).join(
        b.select(key, *[F.col(c).alias(f"b_{c}") for c in cols]), key, "full_outer")
    flags = []
    for c in cols:
        x, y = F.col(f"a_{c}"), F.col(f"b_{c}")
        same = x.eqNullSafe(y)
        if tol:
            same = same | F.coalesce(F.abs(x.cast("double") - y.cast("double")) <= tol, F.lit(False))
        flags.append((~same).alias(f"diff_{c}"))
    out = j.select(key, *flags)
    any_diff = None
    for c in cols:
        any_diff = F.col(f"diff_{c}") if any_diff is None else (any_diff | F.col(f"diff_{c}"))
    return out.filter(any_diff)


def reconcile_summary(a: DataFrame, b: DataFrame, key: str, cols: Sequence[str], tol: float = 0.0) -> DataFrame:
    keys = a.select(key).unionByName(b.select(key)).distinct().agg(F.count(F.lit(1)).alias("compared"))
    bad = reconcile(a, b, key, cols, tol).agg(F.count(F.lit(1)).alias("mismatches"))
    return keys.crossJoin(bad)


def dq_relationship(child: DataFrame, ck: str, parent: DataFrame, pk: str) -> DataFrame:
    """Q-16: parent key unique and every child key present in the parent."""
    dup = dq_duplicate_keys(parent, pk).withColumnRenamed("value", "parent_duplicates")
    orphan = dq_orphans(child.filter(F.col(ck).isNotNull()), ck, parent, pk).withColumnRenamed("value", "orphans")
    return dup.crossJoin(orphan)


def dq_grain(df: DataFrame, key: str) -> DataFrame:
    """Q-17: rows versus distinct keys."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("unique_keys"))


# Fixed labels of the report, in the order the study lists its checks.
KEY_CHECKS = [("orders", ["order_id"]), ("customers", ["customer_id"]), ("products", ["product_id"]),
              ("sellers", ["seller_id"]), ("order_items", ["order_id", "order_item_id"]),
              ("order_payments", ["order_id", "payment_sequential"])]
REFERENCE_CHECKS = [("order_items", "order_id", "orders", "order_id"),
                    ("order_payments", "order_id", "orders", "order_id"),
                    ("order_reviews", "order_id", "orders", "order_id"),
                    ("orders", "customer_id", "customers", "customer_id"),
                    ("order_items", "product_id", "products", "product_id"),
                    ("order_items", "seller_id", "sellers", "seller_id")]


MULTI_CHILD = ("orders with several reviews", "order_reviews", "order_id", "orders")
REPEATED = ("repeated review_id", "order_reviews", "review_id")
AMOUNTS = {"order_items": ["price", "freight_value"], "order_payments": ["payment_value"]}
PRESERVED = [("item value preserved", "order_items", "price", "item_value"), ("freight preserved", "order_items", "freight_value", "freight_value"),
             ("payments preserved", "order_payments", "payment_value", "payment_total")]
# What the study does about each check: stop, keep and report, or a rule.
STOP, KEEP = "stop if not zero", "kept and reported"
TREATMENTS = {"duplicate keys": STOP, "null keys": STOP, "missing references": STOP,
              "orders with several reviews": "latest review by answer date, then creation, then review_id, then source order",
              "repeated review_id": "review_id is not used as a key by itself",
              "receipt before purchase": "no duration", "carrier before approval": "no duration", "receipt before carrier": "no duration",
              "delivered without receipt date": "left out of delays", "review answered before receipt": "left out of satisfaction by delay",
              "payment gap over 0.01": "gap kept as a column", "item value preserved": "stop if zero", "freight preserved": "stop if zero",
              "payments preserved": "stop if zero", "coordinates outside the box": "left out of medians"}


def treatment(check: Column) -> Column:
    """The rule for a check, by its name or the name's part before ':'."""
    rules = F.create_map(*[F.lit(x) for pair in TREATMENTS.items() for x in pair])
    return F.coalesce(rules[check], rules[F.regexp_extract(check, "^([^:]*):", 1)], F.lit(KEEP))


def _text_key(columns: Sequence[str]) -> Column:
    """One text per key: its parts with their lengths, a null part told from an empty one."""
    parts = [F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.concat(*parts)


def key_domains() -> dict[str, list[tuple[str, list[str]]]]:
    """Domain -> (table, columns) that share its keys: a table's key with all references to it; other keys by themselves."""
    out: dict[str, list[tuple[str, list[str]]]] = {}
    for table, key in KEY_CHECKS:
        out[f"{table}.{','.join(key)}"] = [(table, key)]
    for child, col, parent, pk in REFERENCE_CHECKS:
        out[f"{parent}.{pk}"].append((child, [col]))
    _, table, key = REPEATED
    out[f"{table}.{key}"] = [(table, [key])]
    return out


def integrity(t: dict[str, DataFrame]) -> DataFrame:
    """All checks of keys and references as (check_name, value), and the totals of ``AMOUNTS`` as decimals, in one row per name.

    Each table is read once: a row gives one short row (code of the domain, key, place of the table in the domain) for each key
    it holds.  One grouping by (code, key), combined map-side and shuffled once, then shows every table that knows the key:
    duplicates, nulls, missing parents and parents of several children are sums over these groups.  Tasks hold a group for each
    key, so a group is kept small: a number in place of names, and as many counts as the widest domain has tables."""
    domains = key_domains()
    totals = [f"sum:{table}.{c}" for table, cols in AMOUNTS.items() for c in cols]
    code = {d: 2 * i for i, d in enumerate([*domains, *totals])}          # the next number for keys with a null part
    place = {(d, table): i for d, members in domains.items() for i, (table, _) in enumerate(members)}
    names = list(dict.fromkeys(table for members in domains.values() for table, _ in members))
    no_value = F.lit(None).cast("decimal(38,2)")
    held = lambda at, key, slot, value: F.struct(at.alias("code"), key.alias("key"), F.lit(slot).alias("slot"), value.alias("value"))
    rows = None
    for name in names:
        keys = []
        for d, members in domains.items():
            for table, cols in members:
                if table == name:
                    void = F.greatest(*[F.col(c).isNull() for c in cols], F.lit(False))
                    keys.append(held(F.lit(code[d]) + void.cast("int"), _text_key(cols), place[d, name], no_value))
        amounts = [held(F.lit(code[f"sum:{name}.{c}"]), F.lit(""), 0, F.col(c).cast("decimal(38,2)")) for c in AMOUNTS.get(name, [])]
        own = t[name].select(F.explode(F.array(*keys, *amounts)).alias("x")).select("x.*")
        rows = own if rows is None else rows.unionByName(own)
    counted = [F.count_if(F.col("slot") == i).alias(f"n_{i}") for i in range(1 + max(place.values()))]
    groups = rows.groupBy("code", "key").agg(*counted, F.sum("value").cast("decimal(38,2)").alias("value"))
    here = lambda d: F.col("code").isin(code[d], code[d] + 1)
    held_by = lambda d, table: F.col(f"n_{place[d, table]}")
    void = F.col("code") % 2 == 1
    sums: list[tuple[str, Column]] = []
    for table, key in KEY_CHECKS:
        d = f"{table}.{','.join(key)}"
        n = held_by(d, table)
        sums.append((f"duplicate keys: {table}", F.when(here(d), F.greatest(n - 1, F.lit(0)))))
        sums.append((f"null keys: {table}", F.when(here(d) & void, n)))
    for child, col, parent, pk in REFERENCE_CHECKS:
        d = f"{parent}.{pk}"
        missing = here(d) & (void | (held_by(d, parent) == 0))
        sums.append((f"missing references: {child}.{col}", F.when(missing, held_by(d, child))))
    name, child, key, parent = MULTI_CHILD
    d = f"{parent}.{key}"
    sums.append((name, F.when(here(d) & (held_by(d, child) > 1), 1)))
    name, table, key = REPEATED
    d = f"{table}.{key}"
    sums.append((name, F.when(here(d), F.greatest(held_by(d, table) - 1, F.lit(0)))))
    wide = groups.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(f"_c{i}") for i, (_, c) in enumerate(sums)],
                      *[F.sum(F.when(here(d), F.col("value"))).cast("decimal(38,2)").alias(f"_t{i}") for i, d in enumerate(totals)])
    stacked = [f"'{n}', _c{i}, cast(null as decimal(38,2))" for i, (n, _) in enumerate(sums)] + [f"'{d}', cast(null as bigint), _t{i}" for i, d in enumerate(totals)]
    return wide.selectExpr(f"stack({len(stacked)}, {', '.join(stacked)}) AS (check_name, value, total)")


def _fact_checks() -> list[tuple[str, Column]]:
    delivered = F.col("order_status") == "delivered"
    return [
        ("orders without items", F.col("item_count").isNull()),
        ("orders without payment", F.col("payment_total").isNull()),
        ("orders without review", F.col("review_score").isNull()),
        ("delivered without receipt date", delivered & F.col("order_delivered_customer_date").isNull()),
        ("receipt before purchase", days_between("order_purchase_timestamp", "order_delivered_customer_date") < 0),
        ("carrier before approval", days_between("order_approved_at", "order_delivered_carrier_date") < 0),
        ("receipt before carrier", days_between("order_delivered_carrier_date", "order_delivered_customer_date") < 0),
        ("review answered before receipt", F.col("review_answer_timestamp") < F.col("order_delivered_customer_date")),
        ("payment gap over 0.01", F.abs(F.col("payment_gap")) > F.lit(0.010001)),
    ]


def dq_report(t: dict[str, DataFrame], f: DataFrame, geo: DataFrame | None = None, treatments: bool = False) -> DataFrame:
    """Q-14: every check of the study as rows (check_name, value), with ``treatments`` also what is done about it.

    Three passes: all tables for keys, references and totals (``integrity``), the order fact for its checks and totals,
    and the places."""
    checks = _fact_checks()
    facts = f.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(f"_c{i}") for i, (_, c) in enumerate(checks)],
                  *[F.sum(col).cast("decimal(38,2)").alias(f"_t{i}") for i, (_, _, _, col) in enumerate(PRESERVED)])
    stacked = [f"'{n}', _c{i}, cast(null as decimal(38,2))" for i, (n, _) in enumerate(checks)]
    stacked += [f"'sum:{table}.{col}', cast(null as bigint), _t{i}" for i, (_, table, col, _) in enumerate(PRESERVED)]
    seen = facts.selectExpr(f"stack({len(stacked)}, {', '.join(stacked)}) AS (check_name, value, total)")
    both = integrity(t).unionByName(seen)
    counts = both.filter("value IS NOT NULL").select("check_name", "value")
    # A total comes twice, from its table and from the fact; equal and both null count as preserved.
    labels = F.create_map(*[F.lit(x) for n, table, col, _ in PRESERVED for x in (f"sum:{table}.{col}", n)])
    kept = (both.filter(F.col("check_name").startswith("sum:")).groupBy("check_name")
            .agg(F.min("total").alias("a"), F.max("total").alias("b"), F.count("total").alias("n"))
            .select(labels[F.col("check_name")].alias("check_name"),
                    F.when((F.col("n") == 0) | ((F.col("n") == 2) & (F.col("a") == F.col("b"))), 1).otherwise(0).cast("long").alias("value")))
    out = counts.unionByName(kept)
    if geo is not None:
        ok = F.col("geolocation_lat").between(-34, 6) & F.col("geolocation_lng").between(-74, -34)
        out = out.unionByName(count_where(geo, ~ok).select(F.lit("coordinates outside the box").alias("check_name"), "value"))
    return out.withColumn("treatment", treatment(F.col("check_name"))) if treatments else out
