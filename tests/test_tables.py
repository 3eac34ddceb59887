import time
from datetime import date
from functools import partial

import pytest
from pyspark.sql import functions as F

from tidemark.operators.merge import delete_insert, merge_latest
from tidemark.session import LEAN, settings
from tidemark.sources import tables
from tidemark.sources.files import Files

SCHEMA = "k int, v string, p string"
MERGE = partial(delete_insert, keys=["k"])


def frame(spark, table):
    return spark.createDataFrame(table, SCHEMA)


def read(spark, path, rows):
    return rows(spark.read.schema(SCHEMA).parquet(path), "k", "v", "p")


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert(frame(spark, [(1, "a", "x"), (2, "b", "x"), (3, "c", "y"), (4, "d", "z")]), path, ["k"], "p", MERGE)
    return path


def stamps(path, partition):
    from pathlib import Path

    return sorted(f.name for f in Path(path, partition).glob("*.parquet"))


def test_upsert_rewrites_only_touched_partitions(spark, table, rows):
    untouched = stamps(table, "p=z")
    batch = frame(spark, [(2, "B", "x"), (9, "n", "y")])
    tables.upsert(batch, table, ["k"], "p", MERGE)
    want = [(1, "a", "x"), (2, "B", "x"), (3, "c", "y"), (4, "d", "z"), (9, "n", "y")]
    assert read(spark, table, rows) == want
    assert stamps(table, "p=z") == untouched
    tables.upsert(batch, table, ["k"], "p", MERGE)
    assert read(spark, table, rows) == want


def test_rows_move_between_partitions_and_empty_ones_vanish(spark, table, rows):
    tables.upsert(frame(spark, [(4, "d2", "x"), (3, "c2", None)]), table, ["k"], "p", MERGE)
    assert read(spark, table, rows) == [(1, "a", "x"), (2, "b", "x"), (3, "c2", None), (4, "d2", "x")]
    assert Files(spark, table).names(table) == ["_staged", f"p={tables.NULL_PARTITION}", "p=x"]
    tables.upsert(frame(spark, [(3, "c3", "x")]), table, ["k"], "p", MERGE)
    assert read(spark, table, rows) == [(1, "a", "x"), (2, "b", "x"), (3, "c3", "x"), (4, "d2", "x")]


def test_odd_partition_names(spark, tmp_path, rows):
    path = str(tmp_path / "odd")
    batch = frame(spark, [(1, "a", "x/y:z=1%"), (2, "b", "é a,b"), (3, "c", "[q]")])
    for _ in range(2):
        tables.upsert(batch, path, ["k"], "p", MERGE)
    assert read(spark, path, rows) == [(1, "a", "x/y:z=1%"), (2, "b", "é a,b"), (3, "c", "[q]")]
    tables.upsert(frame(spark, [(1, "A", "[q]")]), path, ["k"], "p", MERGE)
    assert read(spark, path, rows) == [(1, "A", "[q]"), (2, "b", "é a,b"), (3, "c", "[q]")]


class Crash(Exception):
    pass


@pytest.mark.parametrize("survive", range(0, 7))
def test_any_crash_is_finished_or_undone(spark, table, rows, monkeypatch, survive):
    """The file system fails after `survive` changes; the next upsert finds a whole table again."""
    before = read(spark, table, rows)
    batch = frame(spark, [(2, "B", "x"), (4, "D", "y")])
    after = [(1, "a", "x"), (2, "B", "x"), (3, "c", "y"), (4, "D", "y")]
    calls = [0]

    def failing(name):
        real = getattr(Files, name)

        def call(self, *args):
            calls[0] += 1
            if calls[0] > survive:
                raise Crash
            return real(self, *args)

        return call

    with monkeypatch.context() as m:
        m.setattr(Files, "rename", failing("rename"))
        m.setattr(Files, "delete", failing("delete"))
        try:
            tables.upsert(batch, table, ["k"], "p", MERGE)
        except Crash:
            pass
    tables.finish_publish(spark, table)
    assert read(spark, table, rows) in (before, after)
    tables.upsert(batch, table, ["k"], "p", MERGE)
    assert read(spark, table, rows) == after


def test_merge_latest_ignores_late_old_rows(spark, tmp_path, rows):
    path = str(tmp_path / "latest")
    merge = partial(merge_latest, keys=["k"], order=["v"])
    tables.upsert(frame(spark, [(1, "b", "x")]), path, ["k"], "p", merge)
    tables.upsert(frame(spark, [(1, "a", "y"), (2, "a", "y")]), path, ["k"], "p", merge)
    assert read(spark, path, rows) == [(1, "b", "x"), (2, "a", "y")]


def test_another_writers_staged_run_is_left_alone(spark, table, rows):
    """A run that is still being filled survives an upsert, and can commit after it."""
    fs, filling = Files(spark, table), f"{table}/{tables.STAGED}/other"
    frame(spark, [(9, "z", "w")]).write.partitionBy("p").parquet(f"{filling}/data")
    tables.upsert(frame(spark, [(1, "A", "x")]), table, ["k"], "p", MERGE)
    assert fs.exists(f"{filling}/data")
    fs.make(f"{filling}/kept/p=w")
    fs.make(f"{filling}/{tables.READY}/p=w")
    assert tables.finish_publish(spark, table) == ["other"]
    assert (9, "z", "w") in read(spark, table, rows) and (1, "A", "x") in read(spark, table, rows)


def test_an_abandoned_run_is_dropped_after_its_lease(spark, table):
    fs, left = Files(spark, table), f"{table}/{tables.STAGED}/old"
    fs.make(f"{left}/data")
    assert tables.finish_publish(spark, table, lease=0) == [] and not fs.exists(left)


def test_fixed_partitions_are_replaced_without_a_scan_of_the_rest(spark, table, rows):
    tables.upsert(frame(spark, [(2, "B", "x"), (7, "n", "new")]), table, ["k"], "p", MERGE, moving=False)
    got = read(spark, table, rows)
    assert (2, "B", "x") in got and (7, "n", "new") in got and (3, "c", "y") in got


def test_drop_old_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "dated")
    days = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 2)), (3, None)], "k int, dt date")
    days.write.partitionBy("dt").parquet(path)
    assert tables.drop_old_partitions(spark, path, "dt", date(2024, 1, 31), 29) == ["dt=2024-01-01"]
    assert rows(spark.read.parquet(path), "k") == [(2,), (3,)]


def test_materialise_sorts_and_partitions(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("p"), (F.col("id") * 7 % 1000).alias("k"))
    tables.materialise(df, "laid_out", ["k"], ["p"])
    stored = spark.table("laid_out")
    assert stored.count() == 1000 and stored.rdd.getNumPartitions() >= 1
    files = {f.rsplit("/", 2)[1] for f in stored.inputFiles()}
    assert files == {"p=0", "p=1", "p=2"}
    tables.materialise(df.where("p = 1"), "laid_out", ["k"], ["p"])
    assert spark.table("laid_out").select("p").distinct().count() == 1  # a rebuild replaces the table
    tables.materialise(df, "ranged", ["k"])
    assert spark.table("ranged").count() == 1000


def test_append_and_high_water(spark, tmp_path):
    path = str(tmp_path / "log")
    for n in (1, 2):
        tables.append(frame(spark, [(n, "a", "x")]), path)
    assert tables.high_water(spark.read.parquet(path), "k") == 2
    assert tables.high_water(spark.read.parquet(path).where("k > 5"), "k") is None


def test_a_first_load_looks_nothing_up_in_the_empty_table(spark, tmp_path, rows, monkeypatch):
    plans, real = [], tables.replace_partitions

    def seen(df, *rest):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        real(df, *rest)

    monkeypatch.setattr(tables, "replace_partitions", seen)
    batch, path = frame(spark, [(1, "a", "x"), (1, "a", "x"), (None, "b", None)]), str(tmp_path / "first")
    tables.upsert(batch, path, ["k"], "p", MERGE)
    assert "Join" not in plans[0]
    assert read(spark, path, rows) == rows(batch)


@pytest.mark.parametrize("rounds", [2, 3, 50])
def test_rounds_write_every_partition_once(spark, tmp_path, rows, rounds):
    table = [(i, None if i % 9 == 0 else f"v{i}", None if i % 7 == 0 else f"p{i % 5}") for i in range(200)] * 2 + [(None, None, None)]
    path, batch = str(tmp_path / "rounds"), frame(spark, table).repartition(4)
    tables.upsert(batch, path, ["k"], "p", MERGE, rounds=rounds)
    assert read(spark, path, rows) == rows(batch)
    assert stamps(path, "p=p1") and Files(spark, path).names(path) == ["_staged", f"p={tables.NULL_PARTITION}", *(f"p=p{i}" for i in range(5))]
    none = str(tmp_path / "none")
    tables.upsert(batch.limit(0), none, ["k"], "p", MERGE, rounds=rounds)
    assert Files(spark, none).names(none) == ["_staged"]


def test_rounds_shuffle_a_part_of_the_rows_at_once(spark, tmp_path):
    """A round shuffles its own partitions, and its files go when it ends."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    path, before = str(tmp_path / "part"), manager.getAllFiles().mkString(" ").count("shuffle_")
    batch = spark.range(400_000).select(F.xxhash64("id").alias("k"), F.md5(F.col("id").cast("string")).alias("v"), (F.col("id") % 8).alias("p"))
    assert [part.count() for part in tables._rounds(batch, "p", 4)] == [100_000] * 4
    with settings(spark, LEAN):
        tables.upsert(batch, path, ["k"], "p", MERGE, rounds=8)
    left = lambda: manager.getAllFiles().mkString(" ").count("shuffle_")
    until = time.time() + 20
    while left() > before and time.time() < until:
        time.sleep(0.2)  # files are removed in the background
    assert left() <= before
    assert spark.read.parquet(path).count() == 400_000
