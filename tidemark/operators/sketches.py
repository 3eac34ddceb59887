"""Stored day sketches: quantiles and distinct counts over any window without reading old days again.

A day's values become a KLL sketch per feature, a day's keys a set of bitmaps. Both merge, so a window
of days is answered from its days' sketches, whose size does not follow the rows. The quantiles have
a stated rank error; the bitmaps, over dense key numbers, count exactly.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators import history
from tidemark.operators.drift import FLOOR, FREEZE_ABOVE, drift_state, unpivot
from tidemark.session import settle

K = 4096  # size parameter of the sketches


def rank_error(k: int = K) -> float:
    """Rank error of a KLL sketch that 99 % of single queries keep, as published for this family."""
    return 2.296 / k**0.9021


def day_sketches(df: DataFrame, features: Sequence[str], day: str, k: int = K) -> DataFrame:
    """day, feature, n, sketch: one row per day and feature; null and NaN values are left out."""
    long = unpivot(df, features, day)
    return long.groupBy(day, "feature").agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch"))


def window_sketches(stored: DataFrame, day: str, first: date, last: date, k: int = K) -> DataFrame:
    """feature, n, sketch over the days from `first` to `last`; the bounds prune the stored partitions."""
    inside = stored.where((F.col(day) >= F.lit(first)) & (F.col(day) <= F.lit(last)))
    return inside.groupBy("feature").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def shares_below(sketch: Column, values: Sequence[float]) -> Column:
    """Array with the share of the sketched values below each of `values`.

    A rank counts equal values, so it is asked for the number just under.
    """
    if not values:
        return F.array().cast("array<double>")
    return F.kll_sketch_get_rank_double(sketch, F.array(*[F.lit(math.nextafter(float(v), -math.inf)) for v in values]))


def psi_sketched(reference: DataFrame, current: DataFrame, bins: int = 10, threshold: float = FREEZE_ABOVE) -> DataFrame:
    """feature, psi, state, n_reference, n_current of features in both windows' sketches.

    The edges are quantiles of the reference, values that occur in it; the outer bins are open. They come
    to the driver, `bins` + 1 numbers a feature, because ranks are asked for constants. Each share is off by
    at most twice `rank_error`, and not at all while a window has fewer than k values.
    """
    r, c = reference.alias("r"), current.alias("c")
    both = settle(r.join(c, "feature").select(
        "feature", F.col("r.n").alias("n_reference"), F.col("c.n").alias("n_current"), F.col("r.sketch").alias("rs"), F.col("c.sketch").alias("cs")
    ), "window_sketches")
    probs = F.array(*[F.lit(i / bins) for i in range(bins + 1)])
    cuts = {x.feature: sorted(set(x.edges)) for x in both.select("feature", F.kll_sketch_get_quantile_double("rs", probs).alias("edges")).collect()}

    def upto(sketch: str) -> Column:
        shares = F.lit(None).cast("array<double>")
        for feature, edges in cuts.items():
            shares = F.when(F.col("feature") == feature, shares_below(F.col(sketch), edges[1:-1])).otherwise(shares)
        return F.concat(shares, F.array(F.lit(1.0)))

    def term(x: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get("upto", i - 1))
        a = F.greatest(x["c"] - F.coalesce(before["c"], F.lit(0.0)), F.lit(FLOOR))
        b = F.greatest(x["r"] - F.coalesce(before["r"], F.lit(0.0)), F.lit(FLOOR))
        return (a - b) * F.ln(a / b)

    asked = both.select("feature", "n_reference", "n_current", F.arrays_zip(upto("rs").alias("r"), upto("cs").alias("c")).alias("upto"))
    psi = F.aggregate(F.transform("upto", term), F.lit(0.0), lambda acc, x: acc + x)
    return asked.select("feature", psi.alias("psi"), drift_state(psi, threshold).alias("state"), "n_reference", "n_current")


def key_numbers(keys: DataFrame, key: str, first: int = 0) -> DataFrame:
    """key, number: distinct keys numbered from `first` without gaps, in order; for keys not numbered before.

    The order is laid out over range partitions, which are numbered one by one and shifted by their sizes.
    """
    rows = history.dealt(keys.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_all", F.lit(0)), "_all", key)
    numbered = history.with_number(rows, "_all", key, "number")
    return numbered.select(key, (F.col("number") - 1 + F.lit(first)).cast("long").alias("number"))


def day_bitmaps(df: DataFrame, day: str, number: str) -> DataFrame:
    """day, bucket, bits: the numbers of a day as bitmaps of 32,768; numbers given close together share few."""
    rows = df.where(F.col(number).isNotNull()).select(day, F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).alias("bit"))
    return rows.groupBy(day, "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def distinct_in(bitmaps: DataFrame, *by: Column) -> DataFrame:
    """The group columns and `keys`, the exact number of distinct keys: bitmaps of the group's days are joined by OR."""
    names = [f"_by{i}" for i in range(len(by))]
    merged = bitmaps.select(*[c.alias(n) for c, n in zip(by, names)], "bucket", "bits").groupBy(*names, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*names).agg(F.sum(F.bitmap_count("bits")).alias("keys"))
