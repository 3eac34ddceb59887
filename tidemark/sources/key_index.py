"""Bloom filters of a partitioned table's keys, kept with the table: which partitions may hold a key?

An upsert whose keys may have moved has to find the partitions of their old rows. The filters name them
without a scan of all keys: what they rule out holds none of the keys, what they let through in vain only
costs a scan. A partition's filter is stored as the 64-bit words that have a bit set; a key sets five bits
in each of two words, so a test reads two words whatever the filter's size.

Filters are always at least what their partition holds: new keys are added before the rows are published,
and the filter is made anew from the partition afterwards. A partition without a filter counts as one
that may hold any key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import settle
from tidemark.sources.files import Files

FOLDER = "_keys"
BITS_PER_KEY = 32  # two words of five bits a key and 32 bits of room: about one false answer in 100,000


def _columns(keys: Sequence[str], partition: str) -> list[str]:
    return [*[k for k in keys if k != partition], partition]


def _slot(keys: Sequence[str], which: int, words: Column) -> Column:
    """Word number and five bits of a key in one of its two words."""
    h = F.xxhash64(F.lit(which), *keys)
    bit = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
    mask = bit(0)
    for i in range(1, 5):
        mask = mask.bitwiseOR(bit(i))
    return F.struct(F.pmod(F.shiftrightunsigned(h, 30), words).alias("word"), mask.alias("mask"))


def in_partitions(target: DataFrame, partition: str, named: DataFrame) -> DataFrame:
    """The rows of the named partitions. Their values, at most one per folder, come to the driver, so the scan lists no others."""
    values = [r[0] for r in named.select(partition).distinct().collect()]
    wanted = F.col(partition).isin([v for v in values if v is not None])
    return target.where(wanted | F.col(partition).isNull() if None in values else wanted)


def filters(rows: DataFrame, keys: Sequence[str], partition: str, bits_per_key: int = BITS_PER_KEY) -> DataFrame:
    """words, word, bits, partition: the filters of the partitions of `rows`, sized by their number of rows.

    Sizes are powers of two, so a table has few different ones.
    """
    sizes = rows.groupBy(partition).agg(F.count(F.lit(1)).alias("n"))
    words = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.col("n") * bits_per_key / 64, F.lit(1.0))))).cast("long")
    sizes = sizes.select(F.col(partition).alias("_p"), words.alias("words"))
    sized = rows.select(*_columns(keys, partition)).join(sizes, F.col(partition).eqNullSafe(F.col("_p")))
    return _bits(sized, keys, partition)


def _bits(sized: DataFrame, keys: Sequence[str], partition: str) -> DataFrame:
    both = F.array(*[_slot(keys, i, F.col("words")) for i in (0, 1)])
    slots = sized.select(partition, "words", F.inline(both))
    return slots.groupBy("words", "word", partition).agg(F.bit_or("mask").alias("bits")).select("words", "word", "bits", partition)


def stored(spark: SparkSession, path: str, schema, partition: str) -> DataFrame | None:
    """The filters of the table at `path`, or None if it has none."""
    fs, folder = Files(spark, path), f"{path}/{FOLDER}"
    if not any(n.startswith(f"{partition}=") for n in fs.names(folder)):
        return None
    kind = schema[partition].dataType.simpleString()
    return spark.read.schema(f"words long, word long, bits long, `{partition}` {kind}").parquet(folder)


def candidates(index: DataFrame, batch: DataFrame, keys: Sequence[str], partition: str) -> DataFrame:
    """Distinct partitions whose filter lets at least one key of the batch through.

    A key is tested with the words of its first slot in all partitions; only what passes meets the
    second.
    """
    sizes = [r.words for r in index.select("words").distinct().collect()]  # powers of two: some forty at most
    asked = batch.select(*keys).distinct().withColumn("words", F.explode(F.array(*[F.lit(s) for s in sizes]).cast("array<bigint>")))
    one, two = (_slot(keys, i, F.col("words")) for i in (0, 1))
    slots = asked.select("words", one.alias("a"), two.alias("b")).select("words", "a.*", F.col("b.word").alias("word2"), F.col("b.mask").alias("mask2"))
    hit = slots.join(index, ["words", "word"]).where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
    hit = hit.select("words", F.col("word2").alias("word"), "mask2", F.col(partition).alias("_p")).distinct()
    both = hit.join(index, ["words", "word"]).where(F.col(partition).eqNullSafe(F.col("_p")))
    return both.where(F.col("bits").bitwiseAND(F.col("mask2")) == F.col("mask2")).select(partition).distinct()


def without_filter(spark: SparkSession, path: str, schema, partition: str, rows: DataFrame) -> DataFrame:
    """Partitions that the table's folder has and the index lacks, found by listing both; they have to be scanned."""
    fs, prefix = Files(spark, path), f"{partition}="
    lacking = sorted({n for n in fs.names(path) if n.startswith(prefix)} - {n for n in fs.names(f"{path}/{FOLDER}") if n.startswith(prefix)})
    if not lacking:
        return rows.select(partition).limit(0)
    return spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{n}" for n in lacking]).select(partition).distinct()


def add(spark: SparkSession, path: str, schema, batch: DataFrame, keys: Sequence[str], partition: str, replace) -> None:
    """Adds the batch's keys to the filters of its partitions, before its rows are published there."""
    index = stored(spark, path, schema, partition)
    if index is None:
        return  # the table is scanned until it has filters
    known = index.groupBy(F.col(partition).alias("_p")).agg(F.max("words").alias("words"))
    held = settle(batch.select(*_columns(keys, partition)).join(known, F.col(partition).eqNullSafe(F.col("_p"))).drop("_p"), "batch_keys")
    fresh = _bits(held, keys, partition)
    touched = held.select(partition).distinct()
    merged = in_partitions(index, partition, touched).unionByName(fresh).groupBy("words", "word", partition).agg(F.bit_or("bits").alias("bits"))
    replace(merged.select("words", "word", "bits", partition), f"{path}/{FOLDER}", partition, touched)


def refresh(spark: SparkSession, path: str, schema, keys: Sequence[str], partition: str, touched: DataFrame | None, replace) -> None:
    """Makes the filters of the touched partitions (all, if None) anew from what they hold now."""
    rows = spark.read.schema(schema).parquet(path).select(*_columns(keys, partition))
    if touched is None:
        touched = rows.select(partition).distinct()
    else:
        rows = in_partitions(rows, partition, touched)
    replace(filters(rows, keys, partition), f"{path}/{FOLDER}", partition, touched)
