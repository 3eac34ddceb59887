import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import ranking
from tidemark.session import settle

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 1.0]


def samples():
    rng = np.random.default_rng(7)
    return {
        "normal": rng.normal(size=2000),
        "hot": np.where(rng.random(3000) < 0.4, 5.0, rng.integers(0, 50, 3000)),
        "few": np.array([3.0, 1.0]),
        "one": np.array([4.0]),
        "constant": np.full(100, 2.5),
    }


def test_exact_quantiles_match_numpy(spark):
    data = samples()
    pairs = [(g, float(v)) for g, values in data.items() for v in values] + [("normal", None)]
    df = spark.createDataFrame(pairs, "g string, v double")
    got = {(r.g, r.p): r.quantile for r in ranking.exact_quantiles(df, "g", "v", PROBS, buckets=16).collect()}
    assert len(got) == len(data) * len(PROBS)
    for g, values in data.items():
        for p in PROBS:
            assert got[g, p] == pytest.approx(np.quantile(values, p), abs=1e-12), (g, p)


def test_running_totals_match_cumsum(spark):
    rng = np.random.default_rng(1)
    triples = [("a", float(x), int(rng.integers(0, 9))) for x in rng.permutation(500)]
    triples += [("b", float(x), 1) for x in range(3)]
    counts = settle(spark.createDataFrame(triples, "g string, x double, n bigint"), "t")
    got = {(r.g, r.x): (r.upto_n, r.total_n) for r in ranking.running_totals(counts, "g", "x", ["n"], 8).collect()}
    for g in "ab":
        running, mine = 0, sorted((x, n) for h, x, n in triples if h == g)
        whole = sum(n for _, n in mine)
        for x, n in mine:
            running += n
            assert got[g, x] == (running, whole)


def split_of(spark, labels, percent=20):
    df = spark.createDataFrame([(f"k{i}", y) for i, y in enumerate(labels)], "k string, y int")
    return [(r.k, r.y, r.in_test) for r in ranking.stratified_split(df, "k", "y", percent).collect()]


@pytest.mark.parametrize("labels", [[0] * 700 + [1] * 33, [1] * 5, [0, 1], [None] * 10 + [0] * 10])
def test_split_takes_the_share_of_every_label(spark, labels):
    got = split_of(spark, labels)
    assert len(got) == len(labels)
    for y in set(labels):
        mine = sorted((hashlib.md5(f"{k}|42".encode()).hexdigest(), k, t) for k, z, t in got if z == y)
        take = (len(mine) * 40 + 100) // 200
        assert [t for _, _, t in mine] == [1] * take + [0] * (len(mine) - take)


def test_split_is_repeatable(spark):
    assert sorted(split_of(spark, [0, 1] * 50)) == sorted(split_of(spark, [0, 1] * 50))


def test_hash_sample_is_a_fixed_subset(spark):
    df = spark.range(5000)
    got = {r.id for r in ranking.hash_sample(df, F.col("id"), 100).collect()}
    assert got == {i for i in range(5000) if i * 7919 % 1000 < 100}
