"""Merkle manifest of a table: a leaf for each row, a tree for each group, a tree over the groups' roots.

A leaf is the SHA-256 of the row's fields, each as `-` if null, else its number of UTF-8 bytes, `:` and its value. Digests
enter a parent as lowercase hex text; they are stored as 32 bytes. In a group the leaves ascend by an order column (nulls
first; rows of one order value by their leaf), and while several nodes remain, each `fan_out` consecutive ones become their
parent; the last run of a level may hold fewer, even one. What remains is the group's root. The groups' roots, ordered by
the group (null first, UTF-8 bytewise), give the table's root in the same way.

Method: sibling-shift self-joins. The nodes of a level know their group, their place in it and the group's size. Each node
is joined, by equality, with the nodes at the indices that its own index and a shift give: XOR in a binary tree, the slot
plus an offset in wider ones. What the join finds is the node's part of the proof; rows in slot zero, which have found all
of their run, emit the parent. A level is one written table. Going down again, a node's path to the root is its own run
followed by its parent's path.

How it scales: texts are hashed where they are read and never move. Places come from an exchange by ranges of (group, order,
leaf) and a sum of counts over (range, group), so a group with most of the rows is many ranges, and runs are dealt by (group,
run), at most `fan_out` rows each. The exchange on (group, run) serves the self-join and the collection of the siblings. Nothing
is collected but the size of the largest group, which gives the number of levels. Cuts are written tables.

Cases: null fields, groups and order values are as above; empty and very long texts are values like others; repeated rows are
leaves of their own, with equal digests and consecutive places; other columns, whatever their names, are not read; an empty
table gives no rows; a table of one row has an empty path and its leaf as the root.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored

PART = 1 << 33      # Spark's ids of rows are the partition's number times this, plus the row's place in the partition
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


def field(value: Column) -> Column:
    """A field as it enters its row's leaf."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*(field(v) for v in values)), 256))


def hex_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def fold(digest: Column, path: Column) -> Column:
    """The root (as hex text) that a leaf and a path give."""
    return F.aggregate(path, hex_text(digest), lambda d, run: F.sha2(F.concat(hex_text(run["before"]), d, hex_text(run["after"])), 256))


def siblings(path: Column) -> Column:
    """The digests (hex text, one after the other) of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda run: F.concat(hex_text(run["before"]), hex_text(run["after"]))), "")


@contextmanager
def _joins_reuse_partitions(spark: SparkSession) -> Iterator[None]:
    """Meanwhile a join may use a partitioning on some of its keys."""
    before = spark.conf.get(CO_PARTITION)
    spark.conf.set(CO_PARTITION, "false")
    try:
        yield
    finally:
        spark.conf.set(CO_PARTITION, before)


def _placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """rows (a written table) with idx, the place in their group by `order`, and n, the group's size."""
    ranged = rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
    ranged = stored(ranged.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.floor(F.col("at") / PART)), "merkle-ranges")
    # One row for each range and group; a group is in few ranges, or in as many as its size asks for.
    pieces = ranged.groupBy("grp", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    whole = Window.partitionBy("grp")
    before = F.sum("rows").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.select("grp", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("offset"), F.sum("rows").over(whole).alias("n"))
    return ranged.join(pieces, ["grp", "part"]).withColumn("idx", F.col("at") + F.col("offset")).select("grp", "idx", "n", "digest", "carry")


def _with_siblings(nodes: DataFrame, fan_out: int) -> DataFrame:
    """The nodes with the digests before and after them in their run."""
    fan = F.lit(fan_out)
    nodes = nodes.select("grp", F.floor(F.col("idx") / fan).alias("run"), (F.col("idx") % fan).alias("slot"), "n", "digest", "carry").repartition("grp", "run")
    members = F.least(fan.cast("long"), F.col("n") - F.col("run") * fan)
    shifted = F.col("slot").bitwiseXOR(F.col("shift")) if fan_out == 2 else (F.col("slot") + F.col("shift")) % F.col("members")
    wants = (nodes.withColumn("members", members).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("members") - 1)).alias("shift"))
             .withColumn("sibling", shifted).drop("members", "shift"))
    found = wants.join(nodes.select("grp", "run", F.col("slot").alias("sibling"), F.col("digest").alias("other")), ["grp", "run", "sibling"])
    runs = found.groupBy("grp", "run", "slot").agg(
        F.first("n").alias("n"), F.first("digest").alias("digest"), F.first("carry").alias("carry"),
        F.sort_array(F.collect_list(F.struct("sibling", "other"))).alias("members"))     # a run: at most fan_out

    def joined(side) -> Column:
        return F.unhex(F.array_join(F.transform(F.filter("members", side), lambda m: F.hex(m["other"])), ""))

    return runs.select("grp", "run", "slot", "n", "digest", "carry", joined(lambda m: m["sibling"] < F.col("slot")).alias("before"),
                       joined(lambda m: m["sibling"] > F.col("slot")).alias("after"))


def _climb(nodes: DataFrame, fan_out: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """For each level its nodes that have a parent, with siblings (a written table), and its nodes that are a group's root."""
    levels, roots = [], []
    most = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        roots.append(nodes.where("n = 1").select("grp", "digest", "carry"))
        if most <= 1:
            return levels, roots
        with _joins_reuse_partitions(nodes.sparkSession):
            levels.append(stored(_with_siblings(nodes.where("n > 1"), fan_out), "merkle-level"))
        parent = F.unhex(F.sha2(F.concat(hex_text(F.col("digest")), hex_text(F.col("after"))), 256))
        fan = F.lit(fan_out)
        nodes = levels[-1].where("slot = 0").select("grp", F.col("run").alias("idx"), F.ceil(F.col("n") / fan).alias("n"), parent.alias("digest"),
                                                    F.lit(None).cast(levels[-1].schema["carry"].dataType).alias("carry"))
        most = -(-most // fan_out)


def _descend(levels: list[DataFrame], roots: list[DataFrame], ends: DataFrame, fan_out: int) -> DataFrame:
    """The lowest nodes with their path and the columns of `ends` (grp, path and others), which continue a group's path."""
    others = [c for c in ends.columns if c not in ("grp", "path")]
    down = None
    for k in range(len(roots) - 1, -1, -1):
        at = roots[k].join(ends, "grp").select("grp", F.lit(0).cast("long").alias("idx"), "digest", "carry", "path", *others)
        if down is not None:
            above = down.select("grp", F.col("idx").alias("run"), F.col("path").alias("rest"), *others)
            path = F.concat(F.array(F.struct("before", "after")), F.col("rest")).alias("path")
            idx = (F.col("run") * F.lit(fan_out) + F.col("slot")).alias("idx")
            at = levels[k].join(above, ["grp", "run"]).select("grp", idx, "digest", "carry", path, *others).unionByName(at)
        down = at
    return down


def manifest(rows: DataFrame, fields: Sequence[str], group: str, order: str, fan_out: int = 16, keep: Sequence[Column] = ()) -> DataFrame:
    """For each row: the order column, the columns `keep`, leaf, subroot (its group's root), root (all 32 bytes) and path (from the
    leaf to the root, for each level the digests before and after in its run, concatenated)."""
    def column(name: str) -> Column:
        return F.col(f"`{name}`")

    # The group's text with a mark before it: nulls come first, and equal keys join.
    key = F.when(column(group).isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), column(group).cast("string")))
    given = rows.select(key.alias("grp"), leaf([column(f) for f in fields]).alias("digest"), F.struct(column(order).alias("ord"), *keep).alias("carry"))
    given = stored(given.withColumn("ord", F.col("carry.ord")), "merkle-leaves")
    leaves = _placed(given, ["ord", "digest"])
    levels, roots = _climb(stored(leaves, "merkle-places"), fan_out)

    subroots = roots[0]
    for more in roots[1:]:
        subroots = subroots.unionByName(more)
    subroots = stored(subroots.select(F.lit(0).alias("grp"), F.col("grp").alias("key"), "digest", F.struct(F.col("grp").alias("key")).alias("carry")), "merkle-subroots")
    top_levels, top_roots = _climb(stored(_placed(subroots, ["key"]), "merkle-tops"), fan_out)
    root = top_roots[0]
    for more in top_roots[1:]:
        root = root.unionByName(more)
    run = "array<struct<before:binary,after:binary>>"
    end = root.select("grp", F.array().cast(run).alias("path"), F.col("digest").alias("root"))
    ends = _descend(top_levels, top_roots, end, fan_out).select(F.col("carry.key").alias("grp"), "path", F.col("digest").alias("subroot"), "root")
    ends = stored(ends, "merkle-ends")          # one row for each group
    found = _descend(levels, roots, ends, fan_out)
    return found.select(F.col("carry.ord").alias(order), *[F.col("carry")[n].alias(n) for n in given.schema["carry"].dataType.names[1:]],
                        F.col("digest").alias("leaf"), "subroot", "root", "path")
