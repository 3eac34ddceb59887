"""Stored sketches and bitmaps against exact figures."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import drift, sketches

D0 = dt.date(2024, 3, 1)


@pytest.fixture(scope="module")
def values(spark):
    rnd = random.Random(5)
    rows = [(D0 + dt.timedelta(days=d), rnd.gauss(d / 20, 1), rnd.choice([1.0, 2.0, 2.0, 5.0]), None) for d in range(40) for _ in range(400)]
    return spark.createDataFrame(rows, "day date, x double, n double, empty double").cache()


def stored(spark, df, tmp_path, k):
    path = str(tmp_path / f"s{k}")
    sketches.day_sketches(df, ["x", "n", "empty"], "day", k).write.partitionBy("day").parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("k", [200, 4096])
def test_psi_keeps_the_stated_error(spark, values, tmp_path, k):
    half, end = D0 + dt.timedelta(days=19), D0 + dt.timedelta(days=39)
    held = stored(spark, values, tmp_path, k)
    windows = [sketches.window_sketches(held, "day", *days, k) for days in ((D0, half), (half + dt.timedelta(days=1), end))]
    got = {r.feature: r for r in sketches.psi_sketched(*windows).collect()}
    exact = drift.psi_report(values.where(F.col("day") <= half), values.where(F.col("day") > half), ["x", "n"])
    for r in exact.collect():
        assert (got[r.feature].n_reference, got[r.feature].n_current) == (r.n_reference, r.n_current)
        # Each share moves by at most twice the rank error; the derivative of a term is bounded by its logarithm plus one.
        slack = 10 * 2 * sketches.rank_error(k) * 8
        assert abs(got[r.feature].psi - r.psi) <= slack
    assert "empty" not in got


@pytest.mark.parametrize("k", [200, 4096])
def test_ranks_keep_the_stated_error(spark, values, tmp_path, k):
    merged = sketches.window_sketches(stored(spark, values, tmp_path, k), "day", D0, D0 + dt.timedelta(days=39), k).where("feature = 'x'")
    data = sorted(r.x for r in values.select("x").collect())
    for p in (0.01, 0.25, 0.5, 0.75, 0.99):
        value = data[int(p * len(data))]
        (rank,) = merged.select(sketches.shares_below(F.col("sketch"), [value])).first()[0]
        assert abs(rank - sum(x < value for x in data) / len(data)) <= sketches.rank_error(k)


def test_a_window_reads_only_its_days(spark, values, tmp_path):
    held = stored(spark, values, tmp_path, 256)
    plan = sketches.window_sketches(held, "day", D0, D0)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert len(sketches.window_sketches(held, "day", D0, D0).inputFiles()) >= 1


def test_small_days_are_exact(spark, tmp_path):
    df = spark.createDataFrame([(D0, float(i), 1.0, None) for i in range(100)], "day date, x double, n double, empty double")
    window = sketches.window_sketches(stored(spark, df, tmp_path, 4096), "day", D0, D0)
    below = window.where("feature = 'x'").select(sketches.shares_below(F.col("sketch"), range(100))).first()[0]
    assert list(below) == [i / 100 for i in range(100)]


def test_distinct_keys_of_any_window(spark):
    rnd = random.Random(2)
    rows = [(D0 + dt.timedelta(days=rnd.randrange(60)), f"K{rnd.randrange(70_000):06d}") for _ in range(30_000)] + [(D0, None)]
    df = spark.createDataFrame(rows, "day date, key string")
    numbers = sketches.key_numbers(df, "key").collect()
    keys = sorted({k for _, k in rows if k})
    assert sorted((r.key, r.number) for r in numbers) == [(k, i) for i, k in enumerate(keys)]
    more = sketches.key_numbers(spark.createDataFrame([("z1",), ("z2",)], "key string"), "key", first=len(keys)).collect()
    assert sorted(r.number for r in more) == [len(keys), len(keys) + 1]
    bitmaps = sketches.day_bitmaps(df.join(spark.createDataFrame(numbers), "key"), "day", "number").cache()
    for days in (1, 7, 30):
        got = {r[0]: r.keys_ for r in sketches.distinct_in(bitmaps, F.floor(F.date_diff("day", F.lit(D0)) / days)).withColumnRenamed("keys", "keys_").collect()}
        want = {}
        for day, key in rows:
            if key:
                want.setdefault((day - D0).days // days, set()).add(key)
        assert got == {w: len(s) for w, s in want.items()}


def test_no_rows(spark):
    none = spark.createDataFrame([], "day date, x double, key string, number long")
    assert sketches.day_sketches(none, ["x"], "day").count() == 0
    assert sketches.key_numbers(none, "key").count() == 0
    assert sketches.distinct_in(sketches.day_bitmaps(none, "day", "number"), F.col("day")).count() == 0
