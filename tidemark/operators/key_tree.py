"""Hard deletes and missing rows found by comparing two tables of keys range by range.

A watermark never sees a row that was deleted. Comparing all keys would ship them all, so each side
keeps a tree of digests over ranges of a key hash: a leaf holds the number of keys of its range and
order-independent sums of their hashes, a node what its sixteen children hold together. Two trees are
compared from the root: only the children of nodes that differ are read, and only the keys of leaves
that differ are joined. Where little was deleted, little moves, whatever the size of the tables.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.merge import without_match
from tidemark.session import scratch_scope, settle
from tidemark.sources.tables import upsert

STEP = 4  # bits of a level: sixteen children
KEYS_PER_LEAF = 1024
DIGEST = ["n", "sum_hi", "sum_lo", "sum_second"]


def levels_for(keys: int, per_leaf: int = KEYS_PER_LEAF) -> int:
    """Levels below the root that leave about `per_leaf` keys in a leaf."""
    return max(0, math.ceil(math.log2(max(keys, 1) / per_leaf) / STEP))


def leaf_of(keys: Sequence[str], levels: int) -> Column:
    """Number of the key's leaf: the first bits of its hash, so leaves are equally full whatever the keys are."""
    if not levels:
        return F.lit(0).cast("long")
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - STEP * levels)


def key_tree(table: DataFrame, keys: Sequence[str], levels: int) -> DataFrame:
    """level, node, n, sum_hi, sum_lo, sum_second: the digests of a table's distinct keys, root at level 0.

    The keys are reduced to one row each, then to one row per leaf, both on the map side first; upper
    levels are sums over the level below. The sums are over the two halves of one 64-bit hash and a
    second, independent 32-bit one, so equal digests of unequal sets take 96 agreeing bits.
    """
    first = F.xxhash64(*keys)
    leaf = table.select(*keys).distinct().groupBy(leaf_of(keys, levels).alias("node")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.shiftrightunsigned(first, 32)).alias("sum_hi"),
        F.sum(first.bitwiseAND(F.lit(0xFFFFFFFF))).alias("sum_lo"),
        F.sum(F.hash(*keys).cast("long")).alias("sum_second"),
    )
    level = settle(leaf, "key_leaves")
    tree = level.withColumn("level", F.lit(levels))
    for depth in range(levels - 1, -1, -1):
        up = [F.sum(c).alias(c) for c in DIGEST]
        level = level.groupBy(F.shiftright("node", STEP).alias("node")).agg(*up)
        tree = tree.unionByName(level.withColumn("level", F.lit(depth)))
    return tree.select("level", "node", *DIGEST)


def differing_leaves(left: DataFrame, right: DataFrame, levels: int) -> DataFrame:
    """node: the leaves in which two trees differ, reached from the root through nodes that differ.

    A node without keys has no row, which differs from one that has some.
    """
    spark = left.sparkSession
    open_ = spark.createDataFrame([(0,)], "node long")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in DIGEST]
    for depth in range(levels + 1):
        sides = []
        for tree, name in ((left, "a"), (right, "b")):
            parent = F.col("node") if depth == 0 else F.shiftright("node", STEP)
            asked = tree.where(F.col("level") == depth).withColumn("parent", parent)
            sides.append(asked.join(open_.withColumnRenamed("node", "parent"), "parent", "left_semi").alias(name))
        both = sides[0].join(sides[1], F.col("a.node") == F.col("b.node"), "full_outer")
        differs = ~(same[0] & same[1] & same[2] & same[3])
        open_ = settle(both.where(differs).select(F.coalesce("a.node", "b.node").alias("node")), "open_nodes")
        if open_.isEmpty():
            break
    return open_


def in_leaves(table: DataFrame, keys: Sequence[str], leaves: DataFrame, levels: int) -> DataFrame:
    """The rows whose key lies in one of the leaves: all that a side has to ship."""
    return table.join(leaves.withColumnRenamed("node", "_leaf"), leaf_of(keys, levels) == F.col("_leaf"), "left_semi")


def deleted_keys(source: DataFrame, target: DataFrame, keys: Sequence[str], per_leaf: int = KEYS_PER_LEAF) -> DataFrame:
    """Distinct keys that the target has and the source has no more. Keys are not null."""
    keys = list(keys)
    held = target.select(*keys)
    levels = levels_for(held.agg(F.count(F.lit(1))).first()[0], per_leaf)
    leaves = differing_leaves(key_tree(source, keys, levels), key_tree(held, keys, levels), levels)
    ours, theirs = (in_leaves(side.select(*keys), keys, leaves, levels) for side in (held, source))
    return without_match(ours.distinct(), theirs, keys)


def apply_deletes(path: str, deleted: DataFrame, keys: Sequence[str], partition: str, schema) -> None:
    """Removes the rows of `deleted` keys from the partitioned table at `path`, rewriting only partitions that hold one.

    A partition that loses its last row goes. Running it again changes nothing.
    """
    spark, keys = deleted.sparkSession, list(keys)
    with scratch_scope(spark):
        gone = settle(deleted.select(*keys).distinct(), "deleted_keys")
        rows = settle(spark.read.schema(schema).parquet(path).join(gone, keys, "left_semi"), "deleted_rows")
        if not rows.isEmpty():
            # The rows to remove are the batch, which replaces them by nothing.
            upsert(rows, path, keys, partition, lambda held, batch: without_match(held, batch, keys), moving=False)
