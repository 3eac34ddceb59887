"""Z-order layout of Parquet files over several keys, with a table of the files' bounds.

Files sorted by a tuple of keys can be skipped by its first key alone. Here each key is cut into ranges of
equal numbers of rows, the bits of the range numbers are interleaved, and rows are laid out in the order
of that number, so that every file spans a small range of each key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import scratch_path, settings
from tidemark.sources.files import Files

BITS = 6  # 64 ranges of each key
ROW_GROUP = 16 << 20  # bytes a task holds for each round it sets rows aside for


def range_starts(df: DataFrame, column: str, ranges: int) -> list[Any]:
    """Least values of `ranges` ranges that hold about as many rows each, for a key of any sortable type."""
    dealt = df.select(column).where(F.col(column).isNotNull()).repartitionByRange(ranges, column)
    starts = dealt.groupBy(F.spark_partition_id().alias("part")).agg(F.min(column).alias("start"))
    return sorted(r.start for r in starts.collect())  # at most `ranges` values


def range_number(column: str, starts: Sequence[Any]) -> Column:
    """Number of the range a value lies in, by halving; null lies in the first."""

    def search(lo: int, hi: int) -> Column:
        if hi - lo <= 1:
            return F.lit(lo)
        middle = (lo + hi) // 2
        return F.when(F.col(column) < F.lit(starts[middle]), search(lo, middle)).otherwise(search(middle, hi))

    return search(0, max(len(starts), 1))


def z_number(numbers: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of several numbers in turn, highest first, as one long; a number keeps its highest `bits` of them."""
    total = F.lit(0).cast("long")
    for i in range(bits):
        for j, number in enumerate(numbers):
            bit = F.shiftright(number, i).bitwiseAND(F.lit(1)).cast("long")
            total = total + F.shiftleft(bit, i * len(numbers) + len(numbers) - 1 - j)
    return total


def _shares(numbered: DataFrame, files: int, rounds: int) -> dict[int, int]:
    """Least Z-number of each round and how many of `files` it gets, for rounds of about as many rows; one pass."""
    ends = [i / files for i in range(1, files)]
    cuts = [0, *(numbered.agg(F.percentile_approx("_z", ends, 100 * files)).first()[0] or [])] if ends else [0]
    shares: dict[int, int] = {}
    for r in range(n := min(rounds, len(cuts))):
        first, after = len(cuts) * r // n, len(cuts) * (r + 1) // n
        shares[cuts[first]] = shares.get(cuts[first], 0) + after - first  # a number that fills several rounds is in one
    return shares


def _write_rounds(numbered: DataFrame, path: str, keys: Sequence[str], files: int | None, rounds: int, read: Callable[[], None] | None) -> None:
    """Sets the rows aside by round, then lays out one round after another and deletes what it was read from."""
    spark = numbered.sparkSession
    shares = _shares(numbered, files or rounds, rounds)
    aside = scratch_path(spark, "z-rounds")
    # A task keeps a file open for each round, with small row groups, and so has nothing to sort and spill.
    with settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(len(shares) + 1)}):
        placed = numbered.withColumn("_round", range_number("_z", [*shares]))
        placed.write.option("parquet.block.size", ROW_GROUP).partitionBy("_round").parquet(aside)
    if read is not None:
        read()
    fs = Files(spark, aside)
    held = [(f"{aside}/_round={i}", share) for i, share in enumerate(shares.values())]
    held = [(folder, share) for folder, share in held if fs.exists(folder)] or [(aside, 1)]
    for i, (folder, share) in enumerate(held):
        part = spark.read.schema(numbered.schema).parquet(folder)
        dealt = part.repartitionByRange(share, "_z") if files else part.repartitionByRange("_z")
        dealt.sortWithinPartitions("_z", *keys).drop("_z").write.mode("append" if i else "error").parquet(path)
        fs.delete(folder)
    fs.delete(aside)


def write_z_ordered(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    files: int | None = None,
    bits: int = BITS,
    rounds: int = 1,
    read: Callable[[], None] | None = None,
) -> None:
    """Writes `df` to `path` in Z-order of `keys`; reads each key once more to find its ranges.

    A key value that fills several ranges is one of them, and its rows are dealt by the other keys.
    With `rounds`, the order is cut into so many stretches of about as many rows, written one after
    another: the rows of one are shuffled at once. They wait in a scratch table that shrinks meanwhile.
    `read` is called when `df` was read for the last time, e.g. to delete the table behind it.
    """
    if not 0 < bits * len(keys) <= 62:
        raise ValueError("the interleaved bits must fit a long")
    z = z_number([range_number(k, range_starts(df, k, 1 << bits)) for k in keys], bits)
    numbered = df.withColumn("_z", z)
    if rounds > 1:
        return _write_rounds(numbered, path, keys, files, rounds, read)
    dealt = numbered.repartitionByRange(files, "_z") if files else numbered.repartitionByRange("_z")
    dealt.sortWithinPartitions("_z", *keys).drop("_z").write.parquet(path)
    if read is not None:
        read()


def file_bounds(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """file, rows, and least_<key>, greatest_<key> of each file, and nulls_<key>: a table to store beside the files."""
    rows = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), *keys)
    bounds = [x for k in keys for x in (F.min(k).alias(f"least_{k}"), F.max(k).alias(f"greatest_{k}"), F.count_if(F.col(k).isNull()).alias(f"nulls_{k}"))]
    return rows.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), *bounds)


def files_within(bounds: DataFrame, ranges: dict[str, tuple[Any, Any]]) -> list[str]:
    """Files that may hold a row with every key in its range, ends included."""
    may = F.lit(True)
    for k, (low, high) in ranges.items():
        may = may & (F.col(f"greatest_{k}") >= F.lit(low)) & (F.col(f"least_{k}") <= F.lit(high))
    return sorted(r.file for r in bounds.where(may).select("file").collect())


def read_within(spark: SparkSession, path: str, bounds: DataFrame, ranges: dict[str, tuple[Any, Any]]) -> DataFrame:
    """The rows with every key in its range, ends included, from the files that may hold one."""
    named = files_within(bounds, ranges)
    whole = spark.read.parquet(path)
    rows = spark.read.schema(whole.schema).parquet(*named) if named else whole.limit(0)
    for k, (low, high) in ranges.items():
        rows = rows.where(F.col(k).between(F.lit(low), F.lit(high)))
    return rows
