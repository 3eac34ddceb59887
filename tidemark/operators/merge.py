"""Latest-version picks, upserts and key-existence joins as DataFrame algebra.

Picks are aggregates, not windows: each map task keeps one row per key before the shuffle, so a
key holding a third of the rows costs its reducer one row per map task.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F


def pick_one(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One whole row per key: the largest by `order`, then by the remaining columns."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not [*order, *rest]:
        return df.distinct()
    best = F.max(F.struct(*order, *rest)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*").select(*df.columns)


def dedup_latest(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Latest version of each business key over every `dt` it was extracted on."""
    return pick_one(df, keys, order or ["updated_at", "dt"])


def left_any_join(left: DataFrame, right: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Left join that keeps the left grain: at most one right row per key, the largest by `order`."""
    return left.join(pick_one(right, [key], order), key, "left")


def with_match(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left rows whose key exists on the right; right keys are made unique before they are shuffled."""
    return left.join(right.select(*keys).distinct(), keys, "left_semi")


def without_match(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right.select(*keys).distinct(), keys, "left_anti")


def delete_insert(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key is not in the batch, plus every batch row."""
    return without_match(target, batch, keys).unionByName(batch)


def insert_ignore(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Target unchanged, plus batch rows with a new key (one row per new key)."""
    fresh = without_match(batch, target, keys)
    return target.unionByName(pick_one(fresh, keys, []))


def merge_latest(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Upsert that keeps the newest row per key whatever order the batches arrive in."""
    return pick_one(target.unionByName(batch), keys, order)


def keep_recent(df: DataFrame, column: str, as_of: date, days: int) -> DataFrame:
    """Retention: rows whose `column` is at most `days` old."""
    return df.where(F.col(column) >= F.date_sub(F.lit(as_of), days))


def orphans(fact: DataFrame, fk: str, dim: DataFrame, pk: str | None = None) -> DataFrame:
    """Foreign keys without a parent and the rows that carry them.

    The fact is reduced to one row per key before the join.
    """
    pk = pk or fk
    used = fact.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("fact_rows"))
    return without_match(used, dim.select(F.col(pk).alias(fk)), [fk])
