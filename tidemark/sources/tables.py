"""Gold tables on Parquet: full rebuilds, partition replacement and key upserts.

Parquet has no MERGE, and rewriting a whole fact for each batch does not scale. An upsert finds the
partitions its keys touch, rewrites those, and swaps them in from a staged copy. A run that dies
half way is finished by `finish_publish`, which every upsert calls first.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.session import scratch_scope, settle
from tidemark.sources import key_index
from tidemark.sources.files import Files

STAGED, READY = "_staged", "_READY"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
LEASE_SECONDS = 24 * 3600  # a staged run without a marker is another writer's for so long


def materialise(
    df: DataFrame, table: str, sort_by: Sequence[str] = (), partition_by: Sequence[str] = (), keep_others: bool = False
) -> None:
    """Rebuild of a managed table, laid out so file statistics can skip on `sort_by`.

    With `keep_others`, partitions that `df` has no row of stay as they are.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    elif sort_by:
        df = df.repartitionByRange(*sort_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    if keep_others and partition_by and df.sparkSession.catalog.tableExists(table):
        names = df.sparkSession.table(table).columns
        df.select(*names).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(table)
        return
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def append(df: DataFrame, path: str) -> None:
    """Append-only log write."""
    df.write.mode("append").parquet(path)


def high_water(df: DataFrame, column: str):
    """Largest value of a column, as a driver value that later filters push into scans. One job."""
    return df.agg(F.max(column)).first()[0]


def drop_old_partitions(spark: SparkSession, path: str, partition: str, as_of: date, days: int) -> list[str]:
    """Retention without a rewrite: deletes date partitions older than `days`; returns their folders."""
    fs, oldest = Files(spark, path), (as_of - timedelta(days=days)).isoformat()
    prefix = f"{partition}="
    dated = [n for n in fs.names(path) if n.startswith(prefix) and n != f"{prefix}{NULL_PARTITION}"]
    old = [n for n in dated if n[len(prefix) :] < oldest]
    for name in old:
        fs.delete(f"{path}/{name}")
    return old


def finish_publish(spark: SparkSession, path: str, lease: float = LEASE_SECONDS) -> list[str]:
    """Completes staged runs left behind by a lost driver; returns them.

    A run without a marker may be one that another writer is filling: it is dropped only when its
    folder is older than `lease` seconds.
    """
    fs, done = Files(spark, path), []
    for run in fs.names(f"{path}/{STAGED}"):
        staged = f"{path}/{STAGED}/{run}"
        if fs.exists(f"{staged}/{READY}"):
            _swap(fs, path, staged)
            done.append(run)
        elif fs.age(staged) < lease:
            continue
        fs.delete(staged)
    return done


def _swap(fs: Files, path: str, staged: str) -> None:
    """Moves staged partitions into place. Each step can be repeated after a crash."""
    for name in fs.names(f"{staged}/{READY}"):  # one marker per partition to replace
        fresh, live = f"{staged}/data/{name}", f"{path}/{name}"
        if fs.exists(fresh):
            fs.delete(live)
            fs.rename(fresh, live)
        elif not fs.exists(f"{staged}/kept/{name}"):
            fs.delete(live)  # the partition lost its last row


def _partitions(fs: Files, path: str, partition: str) -> set[str]:
    return {n for n in fs.names(path) if n.startswith(f"{partition}=")}


def _rounds(df: DataFrame, partition: str, rounds: int) -> list[DataFrame]:
    """The rows of `df` in up to `rounds` parts of about as many partitions each, none of them in two parts."""
    found = sorted((r[0] for r in df.select(partition).distinct().collect()), key=lambda v: (v is not None, v))  # at most one per folder
    n = min(rounds, len(found))
    if n < 2:
        return [df]
    groups = [found[len(found) * i // n : len(found) * (i + 1) // n] for i in range(n)]
    named = [F.col(partition).isin([v for v in group if v is not None]) for group in groups]
    if found[0] is None:
        named[0] = F.col(partition).isNull() | named[0]
    return [df.where(c) for c in named]


def replace_partitions(df: DataFrame, path: str, partition: str, touched: DataFrame, rounds: int = 1) -> None:
    """Replaces the `touched` partitions (one column of that name) of the table at `path` by the rows of `df`.

    Data is complete in the staging folder before the markers that allow the swap appear. Touched
    partitions are written as folders by the cluster, so their names come from a listing. With
    `rounds`, so many groups of partitions are written one after another: `df` is computed for each,
    and has to give the same rows every time, but only a group's rows are shuffled at once.
    """
    spark = df.sparkSession
    fs = Files(spark, path)
    run = f"{path}/{STAGED}/{uuid.uuid4().hex}"
    touched.select(partition, F.lit(1).alias("touched")).write.partitionBy(partition).parquet(f"{run}/touched")
    for part in _rounds(df, partition, rounds) if rounds > 1 else [df]:
        part.hint("rebalance", F.col(partition)).write.mode("append").partitionBy(partition).parquet(f"{run}/data")
    fresh = _partitions(fs, f"{run}/data", partition)
    for name in sorted(fresh):
        fs.make(f"{run}/kept/{name}")
    for name in sorted(fresh | _partitions(fs, f"{run}/touched", partition)):
        fs.make(f"{run}/marks/{name}")
    fs.make(f"{run}/marks")
    fs.rename(f"{run}/marks", f"{run}/{READY}")  # the commit point
    _swap(fs, path, run)
    fs.delete(run)


def upsert(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    partition: str,
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    moving: bool = True,
    indexed: bool = False,
    rounds: int = 1,
) -> None:
    """Merges `batch` into the partitioned table at `path`, rewriting only the partitions it touches.

    `merge(target, batch)` gets the rows of those partitions, e.g. `delete_insert` or `merge_latest`.
    A key may be in another partition than before, which takes a scan of the target's keys; where it
    cannot (`moving=False`) the partitions are those of the batch, and the scan of the target is
    pruned to them. With `indexed`, Bloom filters kept with the table name the partitions that the
    batch's keys may be in, and only these are scanned for them; every writer of the table then has to
    say so. The partition column is text, a date or a whole number. The first load is written in
    `rounds`, see `replace_partitions`.
    """
    spark = batch.sparkSession
    fs = Files(spark, path)
    finish_publish(spark, path)
    touched = batch.select(partition)
    if not _partitions(fs, path, partition):
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in batch.schema]
        empty = spark.range(1).select(*nothing).limit(0)  # known as empty when planned: no key of the batch is looked up in it
        first = merge(empty, batch)
        replace_partitions(first, path, partition, touched.limit(0), rounds)
        if indexed:
            key_index.refresh(spark, path, batch.schema, keys, partition, None, replace_partitions)
        return
    target = spark.read.schema(batch.schema).parquet(path)
    with scratch_scope(spark):
        if indexed:
            finish_publish(spark, f"{path}/{key_index.FOLDER}")
        if moving:
            searched = may_hold(spark, path, target, batch, keys, partition) if indexed else target
            touched = touched.unionByName(searched.join(batch.select(*keys), list(keys), "left_semi").select(partition))
        touched = settle(touched.distinct(), "touched")
        inside = key_index.in_partitions(target, partition, touched)
        if indexed:
            key_index.add(spark, path, batch.schema, batch, keys, partition, replace_partitions)
        replace_partitions(merge(inside, batch), path, partition, touched)
        if indexed:
            key_index.refresh(spark, path, batch.schema, keys, partition, touched, replace_partitions)


def may_hold(spark: SparkSession, path: str, target: DataFrame, batch: DataFrame, keys: Sequence[str], partition: str) -> DataFrame:
    """The rows of the partitions that may hold a key of the batch, by the table's filters; all if it has none."""
    index = key_index.stored(spark, path, batch.schema, partition)
    if index is None:
        return target
    named = key_index.candidates(index, batch, keys, partition)
    named = named.unionByName(key_index.without_filter(spark, path, batch.schema, partition, batch))
    return key_index.in_partitions(target, partition, named)
