"""Versions from extract days, also where a key crosses range partitions."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.operators import history
from tidemark.plans.marts import OPEN_END

D0 = dt.date(2024, 1, 1)
SCHEMA = "k string, city string, tier string, note string, updated_at int, dt date"


def plain(rows):
    """The same rule over Python lists."""
    daily = {}
    for k, city, tier, note, at, day in rows:
        if k is not None and day is not None and (k, day) not in daily or (k, day) in daily and daily[k, day][0] < at:
            daily[k, day] = (at, city, tier, note)
    by = defaultdict(list)
    for (k, day), (_, city, tier, note) in sorted(daily.items()):
        if not by[k] or by[k][-1][:2] != [city, tier]:
            by[k].append([city, tier, note, day])
    out = set()
    for k, found in by.items():
        for n, (city, tier, note, day) in enumerate(found):
            last = n + 1 == len(found)
            end = OPEN_END if last else found[n + 1][3] - dt.timedelta(days=1)
            out.add((k, city, tier, note, day, end, n + 1, int(last)))
    return out


def rows_of(seed=0):
    rnd = random.Random(seed)
    rows = []
    for k in ["hot"] * 6 + [f"c{i}" for i in range(12)]:
        for day in rnd.sample(range(900), rnd.randint(1, 200)):
            rows.append((k, rnd.choice(["a", "a", "b", None]), rnd.choice(["x", "x", "x", "y"]), f"n{rnd.random()}", len(rows), D0 + dt.timedelta(days=day)))
    rows += [("once", "a", "x", "n", 1, D0), (None, "a", "x", "n", 1, D0), ("dayless", "a", "x", "n", 1, None)]
    return rows


def run(df):
    found = history.versions(df, "k", ["city", "tier"], kept=["note"])
    return [tuple(r) for r in found.select("k", "city", "tier", "note", "valid_from", "valid_to", "version", "is_current").collect()]


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_equals_the_plain_rule(spark, parts, monkeypatch):
    def dealt(rows, key, order):  # as many partitions as asked, so that keys cross several edges
        return history.settle(rows.repartitionByRange(parts, key, order).withColumn(history.PART, F.spark_partition_id()), "dealt")

    monkeypatch.setattr(history, "dealt", dealt)
    rows = rows_of()
    got = run(spark.createDataFrame(rows, SCHEMA))
    assert len(got) == len(set(got))
    assert set(got) == plain(rows)


def test_versions_leave_no_gap_and_do_not_overlap(spark):
    by = defaultdict(list)
    for k, *_, start, end, version, current in run(spark.createDataFrame(rows_of(1), SCHEMA)):
        by[k].append((start, end, version, current))
    for found in by.values():
        found.sort()
        assert [v for _, _, v, _ in found] == list(range(1, len(found) + 1))
        assert [c for *_, c in found] == [0] * (len(found) - 1) + [1]
        assert all(a[1] + dt.timedelta(days=1) == b[0] for a, b in zip(found, found[1:]))
        assert found[-1][1] == OPEN_END


def test_an_empty_table_and_repeated_rows(spark):
    assert run(spark.createDataFrame([], SCHEMA)) == []
    rows = [("k", "a", "x", "n", 1, D0)] * 5
    assert len(run(spark.createDataFrame(rows, SCHEMA))) == 1


def test_a_hot_key_is_spread_over_partitions(spark):
    days = spark.range(3000).select(
        F.lit("hot").alias("k"), F.expr("date_add(DATE '2000-01-01', cast(id as int))").alias("dt"), (F.col("id") % 7).cast("string").alias("city")
    )
    rows = history.dealt(days, "k", "dt")
    sizes = [r["count"] for r in rows.groupBy(history.PART).count().collect()]
    assert sum(sizes) == 3000
    assert len(sizes) == 1 or max(sizes) < 3000
