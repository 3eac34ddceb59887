"""Small helpers shared by the operators: words, hashing, scratch tables and row identity."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import settle  # noqa: F401  (written intermediate tables in the shared folder)

#: A word is a run of bytes other than space and the five control characters from tab to return.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, nothing else changed; `lower` is the quick way where every character is ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the decimal text of an id, modulo n; a null id gives null."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the given values only."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def parts_for(rows: int, per_part: int) -> int:
    return max(1, math.ceil(rows / per_part))


def slices(batch: pa.RecordBatch, rows: int = 256, size: int = 4 << 20):
    """Consecutive parts of a batch of at most `rows` rows and, but for a longer text alone, `size` bytes of `text`."""
    sizes = np.zeros(batch.num_rows, np.int64)
    if "text" in batch.schema.names:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy().astype(np.int64)
    upto, at = np.cumsum(sizes), 0
    while at < batch.num_rows:
        fits = int(np.searchsorted(upto, size + (upto[at - 1] if at else 0), side="right"))
        end = min(at + rows, max(fits, at + 1))
        yield batch.slice(at, end - at)
        at = end


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct; frames that carry it beside columns of their own can clash with no name of `df`."""
    return F.struct(*[F.col(quoted(c)) for c in df.columns])


def row_digest(row: Column) -> Column:
    """SHA-256 of a struct of any types, maps included, as binary: the identity of a row, equal for equal rows."""
    return F.unhex(F.sha2(F.to_json(row), 256))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers, so that all bits depend on all bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
