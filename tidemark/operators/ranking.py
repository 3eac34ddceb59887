"""Running totals, exact quantiles and exact splits without a one-task window.

A window over a whole table, or over a group that holds much of it, sorts in one task. Here an
ordered group is first cut into buckets at approximate quantiles; each bucket is scanned on its
own, and a small table of bucket totals gives the offset that makes the result exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import settle

ROWS_PER_BUCKET = 20_000  # a bucket is one task of a window


def buckets_for(rows: int) -> int:
    return max(16, -(-rows // ROWS_PER_BUCKET))


def running_totals(counts: DataFrame, group: str, order: str, sums: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Adds per `c` in `sums`: `upto_<c>`, its sum over the group's rows with `order` up to this row's,
    and `total_<c>`, its sum over the group.

    `counts` has one row per (group, order) and is read three times, so pass a settled table. Cut
    points (one row per group) and offsets (one per bucket) are settled too: their size is then
    known, and Spark broadcasts them only if they are small.
    """
    buckets = buckets or buckets_for(counts.count())
    cuts = [i / buckets for i in range(1, buckets)]
    edges = settle(counts.groupBy(group).agg(F.percentile_approx(order, cuts, 40 * buckets).alias("_edges")), "edges")
    below = F.size(F.filter("_edges", lambda e: e < F.col(order)))
    placed = counts.join(edges, group).withColumn("_bucket", below).drop("_edges")
    per_bucket = placed.groupBy(group, "_bucket").agg(*[F.sum(c).alias(f"_sum_{c}") for c in sums])
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = [F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_before_{c}") for c in sums]
    totals = [F.sum(f"_sum_{c}").over(whole).alias(f"total_{c}") for c in sums]
    offsets = settle(per_bucket.select(group, "_bucket", *before, *totals), "offsets")
    inside = Window.partitionBy(group, "_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = placed.select("*", *[F.sum(c).over(inside).alias(f"_upto_{c}") for c in sums])
    return local.join(offsets, [group, "_bucket"]).select(
        *counts.columns,
        *[(F.col(f"_before_{c}") + F.col(f"_upto_{c}")).alias(f"upto_{c}") for c in sums],
        *[f"total_{c}" for c in sums],
    )


def exact_quantiles(df: DataFrame, group: str, value: str, probs: Sequence[float], buckets: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation: rows (group, p, quantile). NULLs are ignored.

    One pass over `df`, which collapses to its distinct values.
    """
    counted = df.where(F.col(group).isNotNull() & F.col(value).isNotNull())
    counted = counted.groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))
    return quantiles_of_counts(settle(counted, "value-counts"), group, value, "n", probs, buckets)


def quantiles_of_counts(
    counts: DataFrame, group: str, value: str, weight: str, probs: Sequence[float], buckets: int | None = None
) -> DataFrame:
    """`exact_quantiles` over a settled table of distinct values and their whole-number weights."""
    counts = counts.where(F.col(weight) > 0).select(group, value, F.col(weight).alias("n"))
    ranked = running_totals(counts, group, value, ["n"], buckets)

    def position(p: float) -> Column:
        at = F.lit(float(p)) * (F.col("total_n") - 1)
        return F.struct(F.lit(float(p)).alias("p"), F.floor(at).alias("lo"), (at - F.floor(at)).alias("frac"))

    # A row covers the ranks [upto - n, upto); a quantile needs rank lo and, between ranks, lo + 1.
    first, last = F.col("upto_n") - F.col("n"), F.col("upto_n")
    matched = F.filter(
        F.array(*[position(p) for p in probs]),
        lambda w: ((w["lo"] >= first) & (w["lo"] < last))
        | ((w["frac"] > 0) & (w["lo"] + 1 >= first) & (w["lo"] + 1 < last)),
    )
    hits = ranked.select(group, F.col(value).cast("double").alias("_v"), F.inline(matched))
    ends = hits.groupBy(group, "p", "frac").agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    return ends.select(group, "p", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("frac")).alias("quantile"))


def stratified_split(df: DataFrame, key: str, label: str, test_percent: int = 20, seed: int = 42) -> DataFrame:
    """Adds `in_test`: exactly round(n * percent / 100) rows of every label, chosen by a seeded hash.

    A hash prefix, longer with more rows, cuts a label into even buckets; their counts show in which
    bucket the test share ends, and only that bucket is ordered row by row to find the last hash
    inside. Four light passes over (key, label): pass a stored frame.
    """
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))
    digits = max(1, math.ceil(math.log(buckets_for(df.count()), 16)))
    bucket = F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")
    slim = df.select(F.col(key).cast("string").alias("_key"), F.col(label).alias("_label"), digest.alias("_hash"), bucket.alias("_bucket"))
    counts = slim.groupBy("_label", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy("_label").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    take = F.floor((F.sum("_n").over(Window.partitionBy("_label")) * test_percent * 2 + 100) / 200)
    share = counts.select("_label", "_bucket", "_n", (take - (F.sum("_n").over(upto) - F.col("_n"))).alias("_take"))
    # The bucket holding the last test row of its label; a label with no test row has none.
    border = settle(share.where((F.col("_take") >= 1) & (F.col("_take") <= F.col("_n"))), "split-border")
    inside = Window.partitionBy("_label").orderBy("_hash", "_key")
    same = F.col("s._label").eqNullSafe(F.col("b._label")) & (F.col("s._bucket") == F.col("b._bucket"))
    last = (
        slim.alias("s")
        .join(border.alias("b"), same)
        .select("s._label", "s._hash", "s._key", "b._take")
        .withColumn("_row", F.row_number().over(inside))
        .where(F.col("_row") == F.col("_take"))
        .select("_label", F.struct("_hash", "_key").alias("_last"))
    )
    last = settle(last, "split-last")
    mine = F.struct(digest.alias("_hash"), F.col(key).cast("string").alias("_key"))
    chosen = F.coalesce(mine <= F.col("_last"), F.lit(False)).cast("int")
    return df.join(last, df[label].eqNullSafe(last["_label"]), "left").select(*df.columns, chosen.alias("in_test"))


def hash_sample(df: DataFrame, key: Column, per_mille: int) -> DataFrame:
    """Opt-in deterministic sample of about `per_mille` / 1000 of the rows, by an integer key."""
    return df.where(F.pmod(key * 7919, F.lit(1000)) < per_mille)
