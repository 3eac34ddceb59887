"""Exact dedup against history by a minimal perfect hash.

History is a table of documents seen before. Its distinct SHA-256 digests are dealt into buckets and
a minimal perfect hash is built for each bucket: level after level, digests that land alone on a bit
of the level keep it, the rest go on; a digest's slot is the rank of its bit, so n digests fill n
slots. A slot holds the full digest, the winner's locator (its id) and the number of copies.

Incoming digests are aggregated first (a text that a third of the rows share becomes one row per
task before the shuffle), meet their bucket of the index in a cogroup, and are compared byte by byte
with the digest in their slot. Members are repeats of history; nonmembers form groups of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import mix64, parts_for, settle, whole_row

BUCKET = 4096  # digests in a bucket on average: about 200 KB of index
GAMMA = 1.3  # bits of a level for each digest that is left
INDEX = "bucket long, sizes array<int>, bits binary, digests binary, winners binary, copies binary"
RESOLVED = "digest binary, keep_id long, group_size long, member boolean"
NO_ID = -(2**63)


def digest(text: Column) -> Column:
    """SHA-256 of the text in UTF-8 as 32 bytes; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def _words(digests: np.ndarray) -> np.ndarray:
    return digests.reshape(-1, 32).view("<u8")


def _place(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """Bit of each digest in a level; every level mixes all four words anew."""
    h = np.full(len(words), level + 1, np.uint64)
    for k in range(4):
        h = mix64(h ^ words[:, k])
    return (h % np.uint64(size)).astype(np.int64)


def build_hash(digests: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(bits of each level, the bits, slot of each digest) for distinct digests of shape (n, 32)."""
    words, left = _words(digests), np.arange(len(digests))
    sizes, levels, spot = [], [], np.empty(len(digests), np.int64)
    while len(left):
        size = max(64, int(len(left) * GAMMA))
        at = _place(words[left], len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        own = alone[at]
        spot[left[own]] = sum(sizes) + at[own]
        sizes.append(size)
        levels.append(alone)
        left = left[~own]
    bits = np.concatenate(levels) if levels else np.empty(0, bool)
    return sizes, bits, (np.cumsum(bits) - 1)[spot] if len(spot) else spot


def find_slots(digests: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """Slot of each digest; -1, or any slot, for digests that the hash was not built for."""
    words, ranks = _words(digests), np.cumsum(bits) - 1
    slots, left, base = np.full(len(digests), -1, np.int64), np.arange(len(digests)), 0
    for level, size in enumerate(sizes):
        at = base + _place(words[left], level, size)
        hit = bits[at]
        slots[left[hit]] = ranks[at[hit]]
        left, base = left[~hit], base + size
    return slots


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


def _longs(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64)


def _build(table: pa.Table) -> pa.Table:
    digests = _matrix(table["digest"])
    sizes, bits, slots = build_hash(digests)
    order = np.argsort(slots)
    row = {
        "bucket": [table["bucket"][0].as_py()],
        "sizes": [sizes],
        "bits": [np.packbits(bits).tobytes()],
        "digests": [digests[order].tobytes()],
        "winners": [_longs(table["last_id"])[order].tobytes()],
        "copies": [_longs(table["n"])[order].tobytes()],
    }
    kinds = [pa.int64(), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table({k: pa.array(v, t) for (k, v), t in zip(row.items(), kinds)})


def _resolve(incoming: pa.Table, index: pa.Table) -> pa.Table:
    """One row for each digest of history or of the incoming rows of a bucket."""
    seen, ids, n = np.empty((0, 32), np.uint8), np.empty(0, np.int64), np.empty(0, np.int64)
    if index.num_rows:
        row = index.to_pylist()[0]
        seen = np.frombuffer(row["digests"], np.uint8).reshape(-1, 32)
        ids, n = np.frombuffer(row["winners"], np.int64).copy(), np.frombuffer(row["copies"], np.int64).copy()
    new, new_ids, new_n = np.empty((0, 32), np.uint8), np.empty(0, np.int64), np.empty(0, np.int64)
    if incoming.num_rows:
        new, new_ids, new_n = _matrix(incoming["digest"]), _longs(incoming["last_id"]), _longs(incoming["n"])
    member = np.zeros(len(new), bool)
    if len(seen) and len(new):
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(row["sizes"])).astype(bool)
        slots = find_slots(new, row["sizes"], bits)
        member = slots >= 0
        member[member] = (seen[slots[member]] == new[member]).all(1)  # every byte of the digest
        ids[slots[member]] = np.maximum(ids[slots[member]], new_ids[member])
        n[slots[member]] += new_n[member]
    fresh = ~member
    keep = np.concatenate([ids, new_ids[fresh]])
    return pa.table(
        {
            "digest": pa.array([d.tobytes() for d in np.concatenate([seen, new[fresh]])], pa.binary()),
            "keep_id": pa.array(keep, pa.int64(), mask=keep == NO_ID),
            "group_size": pa.array(np.concatenate([n, new_n[fresh]]), pa.int64()),
            "member": pa.array(np.arange(len(keep)) < len(ids), pa.bool_()),
        }
    )


def _distinct(rows: DataFrame, n_buckets: int) -> DataFrame:
    return (
        rows.groupBy("digest")
        .agg(F.coalesce(F.max("id"), F.lit(NO_ID)).alias("last_id"), F.count("*").alias("n"))
        .withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(n_buckets)).cast("long"))
    )


def build_index(history: DataFrame, n_buckets: int) -> DataFrame:
    """Index over the distinct digests of `history` (columns digest, id), one row per bucket, written."""
    spread = _distinct(history, n_buckets).groupBy("bucket").applyInArrow(_build, INDEX)
    return settle(spread, "digest_index")


def resolve(history: DataFrame, incoming: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """One row per distinct digest of both tables (columns digest, id): keep_id (largest id; null if
    no copy has an id), group_size over both, member (whether history holds it)."""
    n_buckets = parts_for(history.count() + incoming.count(), bucket)
    index = build_index(history, n_buckets)
    return _distinct(incoming, n_buckets).groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(_resolve, RESOLVED)


def mark(documents: DataFrame, old: Column, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, in_history for every row of `documents`.

    Rows where `old` holds are history, the others (also where it is null) incoming. Texts are equal when
    identical; null counts as empty. Of equal texts the row with the largest id stays; rows without
    an id come last. Of rows that repeat both id and text one is marked kept. Other columns are not
    read. An empty table gives an empty result.
    """
    rows = settle(
        documents.select(F.col(doc_id).cast("long").alias("id"), digest(F.col(text)).alias("digest"), F.coalesce(old, F.lit(False)).alias("old")),
        "digests",
    )
    resolved = resolve(rows.where("old"), rows.where("not old"))
    copies = rows.groupBy("digest", "id").agg(F.count("*").alias("c"))
    return (
        copies.join(resolved, "digest")
        .select("*", F.explode(F.sequence(F.lit(1), F.col("c").cast("int"))).alias("k"))
        .select(
            F.col("id").alias("doc_id"),
            "keep_id",
            "group_size",
            (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("k") == 1)).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
            F.col("member").alias("in_history"),
        )
    )


def keep(documents: DataFrame, old: Column, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of `documents` that stay, with all their columns; see `mark`.

    Joined on digest and id together, so that copies of a hot text meet in no common task.
    """
    winners = mark(documents, old, text, doc_id).where("kept").select(
        F.unhex("text_sha256").alias("winner"), F.col("doc_id").alias("winner_id")
    )
    held = documents.select(whole_row(documents).alias("row"), digest(F.col(text)).alias("digest"), F.col(doc_id).cast("long").alias("id"))
    on = (F.col("digest") == F.col("winner")) & F.col("id").eqNullSafe(F.col("winner_id"))
    return held.join(winners, on, "left_semi").dropDuplicates(["digest", "id"]).select("row.*")
