"""Deleted keys through trees of range digests."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.operators import key_tree
from tidemark.sources.bronze import write_partitions

SCHEMA = StructType([StructField("id", LongType()), StructField("v", StringType()), StructField("part", StringType())])


def table(spark, ids):
    return spark.createDataFrame([(i, f"v{i}", f"p{i % 5}") for i in ids], SCHEMA)


@pytest.mark.parametrize("gone", [[], [7], [0, 1, 2, 500], list(range(0, 4000, 3))])
def test_equals_an_anti_join(spark, gone):
    held = table(spark, range(4000))
    source = held.where(~F.col("id").isin(gone)) if gone else held
    source = source.unionByName(table(spark, range(9000, 9050)))  # new rows are no deletes
    found = key_tree.deleted_keys(source, held.unionByName(held.limit(100)), ["id"], per_leaf=16)
    assert sorted(r.id for r in found.collect()) == sorted(gone)


def test_equal_ranges_ship_nothing(spark):
    held, levels = table(spark, range(4000)), 2
    source = held.where("id not in (11, 12)")
    trees = [key_tree.key_tree(side, ["id"], levels) for side in (source, held)]
    leaves = key_tree.differing_leaves(*trees, levels)
    assert 1 <= leaves.count() <= 2
    shipped = key_tree.in_leaves(held, ["id"], leaves, levels).count()
    assert 2 <= shipped <= 2 * 4000 / 16**levels * 3
    same = key_tree.differing_leaves(trees[1], trees[1], levels)
    assert same.count() == 0
    assert key_tree.in_leaves(held, ["id"], same, levels).count() == 0


def test_every_level_sums_its_children(spark):
    rows = key_tree.key_tree(table(spark, range(1000)), ["id"], 2).collect()
    by = {(r.level, r.node): r for r in rows}
    assert by[0, 0].n == 1000
    for (level, node), r in by.items():
        if level < 2:
            children = [by[level + 1, c] for c in range(node * 16, node * 16 + 16) if (level + 1, c) in by]
            assert [sum(c[d] for c in children) for d in key_tree.DIGEST] == [r[d] for d in key_tree.DIGEST]


def test_no_keys_on_either_side(spark):
    none, some = table(spark, []), table(spark, range(50))
    assert key_tree.deleted_keys(none, none, ["id"]).count() == 0
    assert key_tree.deleted_keys(some, none, ["id"]).count() == 0
    assert key_tree.deleted_keys(none, some, ["id"]).count() == 50


def test_repeated_rows_are_one_key(spark):
    held = table(spark, range(200))
    twice = held.unionByName(held).unionByName(held)
    assert key_tree.deleted_keys(held, twice, ["id"], per_leaf=8).count() == 0


def test_deletes_rewrite_only_partitions_that_hold_one(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitions(table(spark, range(100)), path, "part")
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "t").glob("part=*/*.parquet")}
    gone = spark.createDataFrame([(3,), (8,), (999,)], "id long")  # both in p3
    key_tree.apply_deletes(path, gone, ["id"], "part", SCHEMA)
    key_tree.apply_deletes(path, gone, ["id"], "part", SCHEMA)  # nothing is left to do
    left = spark.read.schema(SCHEMA).parquet(path)
    assert sorted(r.id for r in left.collect()) == [i for i in range(100) if i not in (3, 8)]
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "t").glob("part=*/*.parquet")}
    kept = [f for f in before if "part=p3" not in str(f)]
    assert kept and all(after.get(f) == before[f] for f in kept)


def test_a_partition_may_lose_its_last_row(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitions(table(spark, range(10)), path, "part")
    key_tree.apply_deletes(path, spark.createDataFrame([(4,), (9,)], "id long"), ["id"], "part", SCHEMA)
    assert not (tmp_path / "t" / "part=p4").exists()
    assert spark.read.schema(SCHEMA).parquet(path).count() == 8
