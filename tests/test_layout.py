"""Z-ordered files and rules about the test files themselves."""

import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.session import checkpoint_root, settle
from tidemark.sources import layout


def test_base_names_of_test_files_are_unique():
    names = Counter(p.name for p in Path(__file__).parent.rglob("test_*.py"))
    assert [n for n, times in names.items() if times > 1] == []


@pytest.fixture(scope="module")
def facts(spark):
    rnd = random.Random(4)
    rows = [(i, rnd.randrange(100_000), f"CUS-{rnd.randrange(30_000):06d}") for i in range(40_000)]
    rows += [(50_000 + i, None, "CUS-000001") for i in range(50)] + [(60_000 + i, 7, None) for i in range(50)]
    return spark.createDataFrame(rows, "id int, day int, customer string").repartition(4).cache()


@pytest.fixture(scope="module")
def stored(spark, facts, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("z") / "t")
    layout.write_z_ordered(facts, path, ["day", "customer"], files=64)
    return path, layout.file_bounds(spark, path, ["day", "customer"]).cache()


def test_all_rows_are_kept(spark, facts, stored):
    path, bounds = stored
    assert sorted(map(tuple, spark.read.parquet(path).collect()), key=str) == sorted(map(tuple, facts.collect()), key=str)
    assert bounds.agg(F.sum("rows")).first()[0] == facts.count()


@pytest.mark.parametrize("ranges", [{"customer": ("CUS-010000", "CUS-010300")}, {"day": (500, 900)}, {"day": (0, 20_000), "customer": ("CUS-0", "CUS-005")}, {"day": (200_000, 300_000)}])
def test_reads_what_a_filter_gives(spark, facts, stored, ranges):
    path, bounds = stored
    want = facts
    for k, (low, high) in ranges.items():
        want = want.where(F.col(k).between(low, high))
    assert sorted(r.id for r in layout.read_within(spark, path, bounds, ranges).collect()) == sorted(r.id for r in want.collect())


def test_each_key_alone_skips_most_files(spark, facts, stored, tmp_path):
    path, bounds = stored
    plain = str(tmp_path / "sorted")
    facts.repartitionByRange(64, "day", "customer").sortWithinPartitions("day", "customer").write.parquet(plain)
    sorted_bounds = layout.file_bounds(spark, plain, ["day", "customer"])
    one = {"customer": ("CUS-010000", "CUS-010300")}
    n, m = bounds.count(), sorted_bounds.count()
    assert len(layout.files_within(sorted_bounds, one)) >= 0.9 * m  # the second key of a tuple skips nothing
    assert len(layout.files_within(bounds, one)) <= 0.35 * n
    assert len(layout.files_within(bounds, {"day": (500, 900)})) <= 0.35 * n


def test_bits_are_interleaved(spark):
    df = spark.createDataFrame([(a, b) for a in range(8) for b in range(8)], "a int, b int")
    z = layout.z_number([F.col("a"), F.col("b")], 3)
    for r in df.select("a", "b", z.alias("z")).collect():
        bits = "".join(x + y for x, y in zip(f"{r.a:03b}", f"{r.b:03b}"))
        assert r.z == int(bits, 2)


def test_one_value_no_rows_and_too_many_bits(spark, tmp_path):
    same = spark.createDataFrame([(1, "x")] * 20, "day int, customer string")
    layout.write_z_ordered(same, str(tmp_path / "same"), ["day", "customer"], files=4)
    assert spark.read.parquet(str(tmp_path / "same")).count() == 20
    layout.write_z_ordered(same.limit(0), str(tmp_path / "none"), ["day", "customer"], files=4)
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError):
        layout.write_z_ordered(same, str(tmp_path / "wide"), ["day", "customer"], bits=40)


@pytest.mark.parametrize("files, rounds", [(64, 8), (5, 3), (2, 8), (1, 4), (None, 4)])
def test_rounds_keep_all_rows_in_z_order(spark, facts, tmp_path, monkeypatch, files, rounds):
    path, keys = str(tmp_path / "rounds"), ["day", "customer"]
    starts = {"day": [*range(0, 100_000, 1600)], "customer": [f"CUS-{i:06d}" for i in range(0, 30_000, 480)]}
    monkeypatch.setattr(layout, "range_starts", lambda df, column, ranges: starts[column])  # else drawn from a sample each time
    layout.write_z_ordered(facts, path, keys, files=files, rounds=rounds)
    assert sorted(map(tuple, spark.read.parquet(path).collect()), key=str) == sorted(map(tuple, facts.collect()), key=str)
    z = layout.z_number([layout.range_number(k, starts[k]) for k in keys])
    ends = spark.read.parquet(path).select(F.input_file_name().alias("f"), z.alias("z")).groupBy("f").agg(F.min("z").alias("a"), F.max("z").alias("b")).orderBy("a", "b").collect()
    assert all(x.b < y.a for x, y in zip(ends, ends[1:])) and (files is None or len(ends) <= files)


def test_rounds_skip_as_many_files(spark, facts, tmp_path):
    path, keys = str(tmp_path / "skip"), ["day", "customer"]
    layout.write_z_ordered(facts, path, keys, files=64, rounds=8)
    bounds = layout.file_bounds(spark, path, keys).cache()
    for one in ({"customer": ("CUS-010000", "CUS-010300")}, {"day": (500, 900)}):
        assert len(layout.files_within(bounds, one)) <= 0.35 * bounds.count()


def test_rounds_of_one_value_and_of_no_rows(spark, tmp_path):
    same = spark.createDataFrame([(1, "x")] * 20 + [(None, None)] * 3, "day int, customer string")
    layout.write_z_ordered(same, str(tmp_path / "same"), ["day", "customer"], files=4, rounds=4)
    assert spark.read.parquet(str(tmp_path / "same")).count() == 23
    layout.write_z_ordered(same.limit(0), str(tmp_path / "none"), ["day", "customer"], files=4, rounds=4)
    none = spark.read.parquet(str(tmp_path / "none"))
    assert none.count() == 0 and none.columns == ["day", "customer"]


def test_a_round_is_shuffled_alone_and_set_aside_rows_go_with_it(spark, facts, tmp_path, monkeypatch):
    """Before, all rows were shuffled by one job over a table that stayed."""
    held, real, fact = [], layout.Files.delete, settle(facts, "z-fact")
    source = fact.inputFiles()[0].rsplit("/", 1)[0]

    def deleted(self, folder):
        if "_round=" in folder:
            assert not self.exists(source)  # the table behind the frame went before the first round was laid out
            held.append(spark.read.parquet(folder).count())
        real(self, folder)

    monkeypatch.setattr(layout.Files, "delete", deleted)
    path = str(tmp_path / "t")
    layout.write_z_ordered(fact, path, ["day", "customer"], files=32, rounds=8, read=lambda: real(layout.Files(spark, source), source))
    assert len(held) == 8 and sum(held) == spark.read.parquet(path).count() == facts.count()
    assert max(held) <= 1.3 * sum(held) / 8
    root = f"{checkpoint_root(spark)}/tidemark/{spark.sparkContext.applicationId}"
    assert not [n for n in layout.Files(spark, root).names(root) if n.startswith("z-rounds")]


def test_rows_are_set_aside_without_a_sort(spark, facts, tmp_path, monkeypatch):
    """A sort by round spilled more than the table itself, at 36 times sf0.1."""
    seen, real = [], layout.settings
    monkeypatch.setattr(layout, "settings", lambda s, values: (seen.append(values), real(s, values))[1])
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    layout.write_z_ordered(facts, str(tmp_path / "t"), ["day", "customer"], files=16, rounds=8)
    assert seen == [{"spark.sql.maxConcurrentOutputFileWriters": "9"}]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
