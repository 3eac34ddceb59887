"""Upserts that find moved keys through the table's Bloom filters."""

import random
from functools import partial
from pathlib import Path

import pytest

from tidemark.operators.merge import delete_insert
from tidemark.sources import key_index, tables

SCHEMA = "k int, v string, p string"
MERGE = partial(delete_insert, keys=["k"])


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def read(spark, path):
    return sorted(((r.k, r.v, r.p) for r in spark.read.schema(SCHEMA).parquet(path).collect()), key=str)


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, f"v{i}", f"p{i % 8}" if i % 8 else None) for i in range(800)]
    tables.upsert(frame(spark, rows), path, ["k"], "p", MERGE, indexed=True)
    return path, {r[0]: r for r in rows}


def test_gives_what_an_upsert_without_filters_gives(spark, table, tmp_path):
    path, want = table
    rnd = random.Random(1)
    for n in range(3):
        batch = [(k, f"b{n}", rnd.choice([None, "p1", "p3", "new"])) for k in rnd.sample(range(1000), 20)] + [(None, f"null{n}", "p1")]
        tables.upsert(frame(spark, batch), path, ["k"], "p", MERGE, indexed=True)
        want.update({k: (k, v, p) for k, v, p in batch if k is not None})
        want.update({f"null{n}": (None, f"null{n}", "p1")})
        assert read(spark, path) == sorted(want.values(), key=str)


def broken(path, *partitions):
    """Makes every other partition unreadable."""
    for name in Path(path).glob("p=*"):
        if name.name not in partitions:
            for f in name.glob("*.parquet"):
                f.write_bytes(b"not parquet")


def test_reads_only_partitions_that_may_hold_a_key(spark, table):
    path, want = table
    broken(path, "p=p3", "p=p5")
    tables.upsert(frame(spark, [(11, "moved", "p5"), (13, "changed", "p5")]), path, ["k"], "p", MERGE, indexed=True)
    held = spark.read.schema(SCHEMA).parquet(path).where("p in ('p3', 'p5')").collect()
    assert sorted(r.k for r in held) == sorted(k for k, _, p in want.values() if p in ("p3", "p5"))
    assert {r.k: (r.v, r.p) for r in held}[11] == ("moved", "p5")


def test_the_scan_for_moved_keys_is_pruned(spark, table):
    path, _ = table
    target = spark.read.schema(SCHEMA).parquet(path)
    batch = frame(spark, [(11, "x", "p1")])
    found = tables.may_hold(spark, path, target, batch, ["k"], "p")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [p#" in plan and "IN (p3)" in plan or "(p#" in plan and "= p3)" in plan
    assert {r.p for r in found.select("p").distinct().collect()} == {"p3"}


def test_rate_of_false_answers(spark, tmp_path):
    rows = spark.range(40_000).selectExpr("cast(id as int) AS k", "concat('p', id % 20) AS p")
    index = key_index.settle(key_index.filters(rows, ["k"], "p"), "filters")
    absent = spark.range(100_000, 150_000).selectExpr("cast(id as int) AS k", "id")
    one, two = (key_index._slot(["k"], i, key_index.F.col("words")) for i in (0, 1))
    sizes = [r.words for r in index.select("words").distinct().collect()]
    asked = absent.crossJoin(spark.createDataFrame([(s,) for s in sizes], "words long")).select("id", "words", one.alias("a"), two.alias("b"))
    asked = asked.select("id", "words", "a.word", "a.mask", key_index.F.col("b.word").alias("w2"), key_index.F.col("b.mask").alias("m2"))
    first = asked.join(index, ["words", "word"]).where("bits & mask = mask").select("id", "words", "p", key_index.F.col("w2").alias("word"), "m2")
    false = first.join(index, ["words", "word", "p"]).where("bits & m2 = m2").count()
    assert false / (50_000 * 20) < 1e-4
    found = key_index.candidates(index, rows.where("k in (7, 27, 8)"), ["k"], "p")
    assert {r.p for r in found.collect()} == {"p7", "p8"}


def test_a_partition_without_filter_is_scanned(spark, table):
    path, want = table
    for f in Path(path, key_index.FOLDER, "p=p3").iterdir():
        f.unlink()
    Path(path, key_index.FOLDER, "p=p3").rmdir()
    tables.upsert(frame(spark, [(11, "moved", "p1")]), path, ["k"], "p", MERGE, indexed=True)
    want[11] = (11, "moved", "p1")
    assert read(spark, path) == sorted(want.values(), key=str)


def test_a_run_that_dies_before_publishing_leaves_filters_that_serve(spark, table, monkeypatch):
    path, want = table
    real = tables.replace_partitions

    def dies(df, at, *rest):
        if at == path:
            raise OSError("lost")
        real(df, at, *rest)

    monkeypatch.setattr(tables, "replace_partitions", dies)
    batch = frame(spark, [(11, "moved", "p1"), (900, "fresh", "p1")])
    with pytest.raises(OSError):
        tables.upsert(batch, path, ["k"], "p", MERGE, indexed=True)
    monkeypatch.setattr(tables, "replace_partitions", real)
    assert read(spark, path) == sorted(want.values(), key=str)
    tables.upsert(batch, path, ["k"], "p", MERGE, indexed=True)
    want |= {11: (11, "moved", "p1"), 900: (900, "fresh", "p1")}
    assert read(spark, path) == sorted(want.values(), key=str)


def test_a_run_that_dies_after_publishing_leaves_filters_that_serve(spark, table, monkeypatch):
    path, want = table
    monkeypatch.setattr(key_index, "refresh", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        tables.upsert(frame(spark, [(11, "moved", "p1")]), path, ["k"], "p", MERGE, indexed=True)
    monkeypatch.undo()
    tables.upsert(frame(spark, [(11, "again", "p2")]), path, ["k"], "p", MERGE, indexed=True)
    want[11] = (11, "again", "p2")
    assert read(spark, path) == sorted(want.values(), key=str)
