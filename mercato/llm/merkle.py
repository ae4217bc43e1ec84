"""Merkle manifest of a dataset and proofs for its rows (operator 12).

A row's leaf is the SHA-256 of its fields; per group the leaves stand in id
order, every 8 consecutive nodes become their parent until one, the group's
subroot, remains; the subroots likewise give the root.  H is the lowercase hex
SHA-256 of the concatenated inputs, digests taken as hex text; stored digests
are their 32 bytes.

``build`` writes the levels to the shared folder: ``runs`` holds the lowest
level, one row per run of up to 8 leaves, and ``nodes`` all inner nodes above
it with the digests of their children and the link to their parent.  Leaves
are numbered by range partitions and offsets, never in one window, so a group
with a third of all rows is spread like the others.

``proofs`` is a recursive query over these rows.  Its anchor is every run, each
leaf of it folded with its own siblings; a step joins the parent, appends the
run's siblings to the path and folds each leaf of the run once more.  The
leaves of a run share their path above it, so it is carried once for 8 leaves.
A node near the root is the parent of many runs: it is stored once per block
of ``BLOCK`` runs below it and joined by block, so that no key of the climb has
more than ``BLOCK`` runs.

Defined results.  A null field is hashed as ``-`` (so null and empty text
differ), else as byte count, ``:`` and value.  Rows with equal ids in a group
stand in the order of their leaves; equal rows are interchangeable.  A null id
comes first and a null group is a group of its own, the first.  A group of one
row has its leaf as subroot, a dataset of one group its subroot as root; no
siblings at all: the proof is H of nothing.  An empty table gives no rows.
Very long texts are hashed whole in the JVM.  Columns that are no fields are
ignored, whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.shared import written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RUN = 8
BLOCK = RUN ** 4
TOP = -1          # number of the tree over the subroots
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; pure ASCII texts take the byte-wise lower()."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def leaf_digest(fields: Sequence[Column]) -> Column:
    """The 32 bytes of H over the fields."""
    texts = [c.cast("string") for c in fields]
    return F.unhex(F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256))


def _hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _parent(kids: Column) -> Column:
    """Digest over the children's concatenated digests."""
    return F.unhex(F.sha2(_hex(kids), 256))


def _joined(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(b""), lambda all_, p: F.concat(all_, p))


@dataclass
class Manifest:
    """``runs``: tree, run, runs (of the tree), lone, leaves (id, leaf, present digest), kids.
    ``nodes``: tree, level, idx, kids, up_tree, up_level, up_idx, slot, once per (own, block) below."""
    runs: DataFrame
    nodes: DataFrame
    levels: int
    trees: int
    root: str


def numbered_leaves(leaves: DataFrame) -> DataFrame:
    """Adds tree (number of the row's group, from 0 in group order), pos (place in the group) and n_leaves."""
    order = [F.col("grp").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("leaf"), F.col("seq")]
    tasks = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = written(leaves.repartitionByRange(tasks, *order).sortWithinPartitions(*order).drop("seq").withColumn("pid", F.spark_partition_id())
                   .withColumn("at", F.monotonically_increasing_id()), "merkle-leaves")
    # One row per group in a partition: partitions + groups rows at most.
    shares = written(part.groupBy("pid", "grp").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("start")), "merkle-shares")
    groups = shares.groupBy("grp").agg(F.sum("n").alias("n_leaves"), F.min("pid").alias("first"))
    before = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)      # one row a partition
    started = groups.groupBy("first").agg(F.count(F.lit(1)).alias("n")).select(
        "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("trees"))
    rank = F.row_number().over(Window.partitionBy("first").orderBy(F.col("grp").asc_nulls_first()))
    trees = groups.join(started, "first").select(F.col("grp").alias("g"), "n_leaves", (F.col("trees") + rank - 1).cast("long").alias("tree"))
    earlier = Window.partitionBy("grp").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.withColumn("offset", F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("start"))
    placed = shares.join(trees, F.col("grp").eqNullSafe(F.col("g"))).select(F.col("pid").alias("p"), "g", "offset", "n_leaves", "tree")
    return (part.join(placed, (F.col("pid") == F.col("p")) & F.col("grp").eqNullSafe(F.col("g")))
            .select("id", "leaf", "present", "tree", (F.col("at") + F.col("offset")).alias("pos"), "n_leaves"))


def _levels_above(nodes: DataFrame, level: int, largest: int) -> list[DataFrame]:
    """Parents of ``nodes`` (tree, idx, digest, n: nodes of the tree on this level), level by level until every tree has one node."""
    out = []
    while largest > 1:
        level, largest = level + 1, -(-largest // RUN)
        kids = F.array_sort(F.collect_list(F.struct("idx", "digest")))
        up = (nodes.filter("n > 1").withColumn("above", F.floor(F.col("idx") / RUN)).groupBy("tree", "above").agg(kids.alias("k"), F.first("n").alias("n"))
              .select("tree", F.lit(level).alias("level"), F.col("above").alias("idx"), _joined(F.transform("k", lambda x: x["digest"])).alias("kids"),
                      F.ceil(F.col("n") / RUN).alias("n")).withColumn("digest", _parent(F.col("kids"))))
        nodes = written(up, f"merkle-level{level}")
        out.append(nodes)
    return out


def _united(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def build(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", id_col: str = "doc_id",
          present: dict[str, Column] | None = None) -> Manifest | None:
    """The manifest of ``docs``; None if there are no rows.  ``present`` gives fields as they are now, where they
    are not those of the manifest; it changes what ``proofs`` folds, not the manifest."""
    now = present or {}
    cols = [F.col(f"`{f}`") for f in fields]
    leaves = docs.select(F.col(f"`{group}`").cast("string").alias("grp"), F.col(f"`{id_col}`").alias("id"), leaf_digest(cols).alias("leaf"),
                         leaf_digest([now.get(f, c) for f, c in zip(fields, cols)]).alias("present"), F.monotonically_increasing_id().alias("seq"))
    leaves = written(leaves.withColumn("present", F.when(F.col("present") != F.col("leaf"), F.col("present"))), "merkle-rows")
    rows = numbered_leaves(leaves).withColumn("run", F.floor(F.col("pos") / RUN))
    leaf = F.array_sort(F.collect_list(F.struct("pos", "id", "leaf", F.coalesce("present", "leaf").alias("present"))))
    runs = rows.groupBy("tree", "run").agg(leaf.alias("leaves"), F.first("n_leaves").alias("n_leaves"))
    runs = written(runs.select("tree", "run", F.ceil(F.col("n_leaves") / RUN).alias("runs"), (F.col("n_leaves") == 1).alias("lone"), "leaves",
                               _joined(F.transform("leaves", lambda x: x["leaf"])).alias("kids")), "merkle-runs")
    lowest = runs.select("tree", F.col("run").alias("idx"), F.when(F.col("lone"), F.col("kids")).otherwise(_parent(F.col("kids"))).alias("digest"),
                         F.col("runs").alias("n"))
    size = runs.agg(F.max("runs").alias("runs"), F.count_if(F.col("run") == 0).alias("trees")).first()
    if not size["trees"]:
        return None
    inner = _levels_above(lowest, 1, size["runs"])
    subroots = _united([lowest.select("tree", "digest", "n"), *[f.select("tree", "digest", "n") for f in inner]]).filter("n = 1")
    leaves_of_top = written(subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), "digest", F.lit(size["trees"]).cast("long").alias("n")),
                            "merkle-subroots")
    top = _levels_above(leaves_of_top, 0, size["trees"])
    last = (top or [leaves_of_top])[-1].filter("n = 1")
    trees = runs.filter("run = 0").select(F.col("tree").alias("own"), F.col("runs").alias("below"))
    stored = [_linked(f, 2 + k, trees, size["trees"]) for k, f in enumerate(inner)] + [_linked_top(f, 1 + k, trees) for k, f in enumerate(top)]
    nodes = written(_united(stored), "merkle-nodes") if stored else None
    return Manifest(runs, nodes, len(inner) + len(top), size["trees"], last.select(_hex(F.col("digest")).alias("root")).first()["root"])


def _up(level: int, one: Column, at: Column, above: tuple[Column, Column, Column, Column]) -> list[Column]:
    """The link to the parent: within the tree, or ``above`` from a tree's only node."""
    inside = (F.col("tree"), F.lit(level + 1), F.floor(at / RUN), F.pmod(at, F.lit(RUN)))
    return [F.when(one, a).otherwise(i).cast("long").alias(c) for c, a, i in zip(("up_tree", "up_level", "up_idx", "slot"), above, inside)]


def _to_top(tree: Column, trees: int) -> tuple[Column, Column, Column, Column]:
    if trees == 1:
        return (F.lit(None),) * 4
    return F.lit(TOP), F.lit(1), F.floor(tree / RUN), F.pmod(tree, F.lit(RUN))


def _linked(level_rows: DataFrame, level: int, trees: DataFrame, count: int) -> DataFrame:
    """Nodes of a group's tree, once per block of runs below them."""
    span = RUN ** (level - 1)
    end = F.least((F.col("idx") + 1) * span, F.col("below")) - 1
    blocks = F.sequence(F.floor(F.col("idx") * span / BLOCK), F.floor(end / BLOCK))
    rows = level_rows.join(trees, level_rows["tree"] == trees["own"])
    return rows.select("own", F.explode(blocks).alias("block"), "tree", F.col("level").cast("long").alias("level"), "idx", "kids",
                       *_up(level, F.col("n") == 1, F.col("idx"), _to_top(F.col("tree"), count)))


def _linked_top(level_rows: DataFrame, level: int, trees: DataFrame) -> DataFrame:
    """Nodes of the tree over the subroots, once per block of runs of each group below them."""
    owners = trees.withColumn("over", F.floor(F.col("own") / RUN ** level))
    rows = level_rows.join(owners, level_rows["idx"] == owners["over"])
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("below") - 1) / BLOCK))
    return rows.select("own", F.explode(blocks).alias("block"), "tree", F.col("level").cast("long").alias("level"), "idx", "kids",
                       *_up(level, F.col("n") == 1, F.col("idx"), (F.lit(None),) * 4))


_CLIMB = """
WITH RECURSIVE climb(own, run, block, folded, path, subroot, up_tree, up_level, up_idx, slot) MAX RECURSION LEVEL {most} AS (
  SELECT own, run, block, folded, path, subroot, up_tree, up_level, up_idx, slot FROM {start}
  UNION ALL
  SELECT c.own, c.run, c.block,
         transform(c.folded, x -> unhex(sha2(lower(hex(concat(substring(n.kids, 1, cast(32 * c.slot as int)), x,
                                                              substring(n.kids, cast(32 * c.slot + 33 as int))))), 256))),
         concat(c.path, substring(n.kids, 1, cast(32 * c.slot as int)), substring(n.kids, cast(32 * c.slot + 33 as int))),
         CASE WHEN n.tree = {top} AND n.level = 1 THEN substring(n.kids, cast(32 * c.slot + 1 as int), 32) ELSE c.subroot END,
         n.up_tree, n.up_level, n.up_idx, n.slot
  FROM climb c JOIN {nodes} n
    ON n.own = c.own AND n.block = c.block AND n.tree = c.up_tree AND n.level = c.up_level AND n.idx = c.up_idx)
SELECT own, run, folded, path, subroot FROM climb WHERE up_tree IS NULL
"""
_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def _climbed(start: DataFrame, manifest: Manifest) -> DataFrame:
    """The recursive query from the runs to the root: per run the folded digests of its leaves, the siblings above it and its subroot."""
    spark = start.sparkSession
    if manifest.nodes is None:
        return start
    names = {k: f"merkle_{k}_{uuid.uuid4().hex}" for k in ("start", "nodes")}
    limit = spark.conf.get(_ROW_LIMIT, None)
    start.createOrReplaceTempView(names["start"])
    manifest.nodes.createOrReplaceTempView(names["nodes"])
    try:
        # The default stops a recursion at a million rows; this one ends with the levels.
        spark.conf.set(_ROW_LIMIT, "-1")
        return written(spark.sql(_CLIMB.format(most=manifest.levels + 2, top=TOP, **names)), "merkle-climbed")
    finally:
        spark.conf.set(_ROW_LIMIT, limit) if limit is not None else spark.conf.unset(_ROW_LIMIT)
        for name in names.values():
            spark.catalog.dropTempView(name)


def proofs(manifest: Manifest) -> DataFrame:
    """Per row: id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    def without(k):
        return F.concat(F.substring(F.col("kids"), F.lit(1), (k * 32).cast("int")), F.substring(F.col("kids"), (k * 32 + 33).cast("int"), F.lit(32 * RUN)))

    def folded(x, k):
        left, right = F.substring(F.col("kids"), F.lit(1), (k * 32).cast("int")), F.substring(F.col("kids"), (k * 32 + 33).cast("int"), F.lit(32 * RUN))
        return F.when(F.col("lone"), x["present"]).otherwise(_parent(F.concat(left, x["present"], right)))

    start = manifest.runs.select(
        F.col("tree").alias("own"), "run", F.floor(F.col("run") / BLOCK).alias("block"), F.transform("leaves", folded).alias("folded"),
        F.lit(b"").alias("path"), F.lit(None).cast("binary").alias("subroot"), *_start_link(manifest.trees))
    done = _climbed(start, manifest).select("own", F.col("run").alias("r"), "folded", "path", "subroot")
    runs = manifest.runs.join(done, (F.col("tree") == F.col("own")) & (F.col("run") == F.col("r")))
    rows = runs.select(F.posexplode("leaves").alias("k", "x"), "folded", "path", "subroot", "kids")
    end = F.lit(manifest.root)
    fold = _hex(F.col("folded")[F.col("k")])
    return rows.select(F.col("x.id").alias("id"), _hex(F.col("x.leaf")).alias("leaf"), F.coalesce(_hex(F.col("subroot")), end).alias("subroot"),
                       end.alias("root"), F.sha2(_hex(F.concat(without(F.col("k")), F.col("path"))), 256).alias("proof_sha256"),
                       fold.alias("folded_root"), (fold == end).alias("verified"))


def _start_link(trees: int) -> list[Column]:
    return _up(1, F.col("runs") == 1, F.col("run"), _to_top(F.col("tree"), trees))


PROOFS = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def audit(docs: DataFrame, present: dict[str, Column], fields: Sequence[str] = FIELDS, group: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """Builds the manifest of ``docs`` and folds the rows as ``present`` has them against it."""
    manifest = build(docs, fields, group, id_col, present)
    if manifest is None:
        return docs.select(F.col(f"`{id_col}`").alias("id")).limit(0).select("id", *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in PROOFS.split(", ")])
    return proofs(manifest)
