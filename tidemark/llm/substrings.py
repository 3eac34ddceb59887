"""Removal of long repeated substrings by a difference cover over suffixes, one bucket at a time.

A byte goes if a string of `length` bytes that covers it starts anywhere else too. So suffixes matter
up to `length` bytes, and equal ranks matter, not their order: a rank is a 64-bit name of a string.

A difference cover D of period v has, for any two suffixes i and j, a shift l below v at which both
i + l and j + l are cover positions (residues in D). Three exchanges follow from it:

1. Cover samples. Every cover position's string of length - v + 1 bytes is sorted by name. Suffixes
   can be equal over `length` bytes only if a shared sample within their first v bytes is; suffixes
   without a repeated sample are done. Names are cut to 32 bits here: a collision only adds work.
2. Cover ranks. Repeated samples get a rank over the long context, v - 1 bytes before to `length`
   after. Suffixes that meet an equal context are long ties: they are known to repeat, and all but
   those at the first holder of the context drop out of the sort.
3. Suffixes. What is left, first holders and suffixes at the edges of repeats, is sorted by the names
   of their `length` bytes, one bucket of names at a time, with memory for one bucket.

Texts are packed into chunks that are stored bucketed by chunk, so no exchange moves a text again:
a chunk sends its sorted distinct names in one block per name bucket and gets a bit for each name
back. A string that a third of all documents share is one name per chunk.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import mix64, parts_for, settle
from tidemark.session import scratch_path

LENGTH = 200
#: Perfect difference sets, period and residues; every difference occurs once.
COVERS = {
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    31: (1, 5, 11, 24, 25, 27),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
    73: (0, 1, 3, 7, 15, 31, 36, 54, 63),
    91: (0, 1, 3, 9, 27, 49, 56, 61, 77, 81),
    133: (0, 9, 10, 12, 26, 30, 67, 74, 82, 109, 114, 120),
}
PERIOD = 133
CHUNK = 2 << 20  # bytes of text in a chunk; a longer text is a chunk of its own
BLOCK = 1 << 20  # bytes that are named at once
NAMES = 1 << 20  # names in a bucket, about

_ODD = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)]
_BYTES = np.random.default_rng(200).integers(0, 2**64, (2, 256), np.uint64)


class Names:
    """Names of strings given by start and length, from sums that wrap at 64 bits."""

    powers: dict = {}

    def __init__(self, text: np.ndarray):
        self.text = text

    def _powers(self, k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """n + 1 powers of the odd number and of its inverse."""
        if len(self.powers.get(k, ((),))[0]) <= n:
            factors = (int(_ODD[k]), pow(int(_ODD[k]), -1, 2**64))
            self.powers[k] = tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, np.uint64(f))]), dtype=np.uint64) for f in factors)
        return self.powers[k]

    def _sums(self, at: np.ndarray, size: np.ndarray, k: int) -> np.ndarray:
        out = np.empty(len(at), np.uint64)
        lo = 0
        while lo < len(at):
            base = int(at[lo])
            hi = int(np.searchsorted(at, base + BLOCK))
            end = int((at[lo:hi] + size[lo:hi]).max())
            n = end - base
            up, down = self._powers(k, n)
            sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTES[k][self.text[base:end]] * up[:n], dtype=np.uint64)])
            local = at[lo:hi] - base
            out[lo:hi] = (sums[local + size[lo:hi]] - sums[local]) * down[local]
            lo = hi
        return out

    def short(self, at: np.ndarray, length: int) -> np.ndarray:
        """Names for a filter; `at` is sorted."""
        return mix64(self._sums(at, np.full(len(at), length), 0))

    def long(self, at: np.ndarray, size: np.ndarray, salt: np.ndarray) -> np.ndarray:
        """Names to decide by, from two independent sums; `salt` (what else must agree) enters too."""
        first = mix64(self._sums(at, size, 0) + mix64(salt.astype(np.uint64)))
        return mix64(first ^ (mix64(self._sums(at, size, 1)) * np.uint64(0x9FB21C651E98DF25)))


def union(start: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Mask of n places that any of the intervals [start, end) covers; starts are sorted."""
    change = np.zeros(n + 1, np.int8)
    if len(start):
        reach = np.maximum.accumulate(end)
        new = np.concatenate([[True], start[1:] > reach[:-1]])
        last = np.concatenate([new[1:], [True]])
        change[start[new]] += 1
        change[reach[last]] -= 1
    return np.cumsum(change[:-1], dtype=np.int8).view(bool)


class Distinct:
    """The distinct names of a chunk in sorted order, and their blocks by name bucket."""

    def __init__(self, names: np.ndarray, n_buckets: int):
        self.values, self.first, self.inverse, counts = np.unique(names, return_index=True, return_inverse=True, return_counts=True)
        self.many = counts > 1
        bucket = ((self.values >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)
        self.buckets, at = np.unique(bucket.astype(np.int64), return_index=True)
        self.cuts = np.append(at, len(self.values))

    def blocks(self, kind: str):
        for b, lo, hi in zip(self.buckets.tolist(), self.cuts, self.cuts[1:]):
            part = self.values[lo:hi]
            yield b, (part.astype("<u4") if kind == "<u4" else part).tobytes()

    def answer(self, reply: dict[int, dict], mask: str) -> np.ndarray:
        """A bit for each distinct name, from the replies by bucket."""
        parts = [np.unpackbits(np.frombuffer(reply[b][mask], np.uint8), count=hi - lo) for b, lo, hi in zip(self.buckets.tolist(), self.cuts, self.cuts[1:])]
        return np.concatenate(parts).astype(bool) if parts else np.empty(0, bool)


class Chunk:
    """The texts of a chunk in one array, and what the exchanges so far have told about them."""

    def __init__(self, row: dict, length: int, period: int, n_buckets: int):
        self.text = np.frombuffer(row["blob"], np.uint8)
        self.ends = np.cumsum(np.array(row["sizes"], np.int64))
        self.starts = self.ends - np.array(row["sizes"], np.int64)
        self.length, self.period, self.n_buckets = length, period, n_buckets
        self.names = Names(self.text)
        self.replies = [{r["bucket"]: r for r in row.get(f"reply_{k}") or []} for k in range(3)]

    def sample_places(self) -> np.ndarray:
        """Cover positions, counted from each text's start, with a whole sample string after them."""
        short, cover = self.length - self.period + 1, np.array(sorted(COVERS[self.period]))
        places = []
        for start, end in zip(self.starts.tolist(), self.ends.tolist()):
            room = end - start - self.length + self.period  # a sample counts if a suffix can reach it
            if end - start >= self.length:
                turns = np.arange(0, room, self.period)[:, None] + cover
                places.append(start + turns.ravel()[turns.ravel() + short <= end - start])
        return np.concatenate(places) if places else np.empty(0, np.int64)

    def samples(self) -> Distinct:
        self.places = self.sample_places()
        return Distinct(self.names.short(self.places, self.length - self.period + 1), self.n_buckets)

    def contexts(self) -> Distinct:
        """Contexts of the repeated samples."""
        found = self.samples()
        repeated = (found.many | found.answer(self.replies[0], "many"))[found.inverse]
        self.places = self.places[repeated]
        text = np.searchsorted(self.ends, self.places, side="right")
        begin = np.maximum(self.starts[text], self.places - self.period + 1)
        end = np.minimum(self.ends[text], self.places + self.length)
        self.floor = begin
        order = np.argsort(begin, kind="stable")  # names want sorted starts; contexts start in order within a text
        names = np.empty(len(begin), np.uint64)
        names[order] = self.names.long(begin[order], (end - begin)[order], (self.places - begin)[order])
        return Distinct(names, self.n_buckets)

    def suffixes(self) -> Distinct:
        """Suffixes that the cover ranks leave to be sorted; `proven` marks those known to repeat."""
        found, n = self.contexts(), len(self.text)
        many = found.many | found.answer(self.replies[1], "many")
        holds = np.zeros(len(self.places), bool)
        holds[found.first] = found.answer(self.replies[1], "first")
        tied = many[found.inverse]
        cover = lambda some: union(self.floor[some], self.places[some] + 1, n)
        valid = union(self.starts[self.ends - self.starts >= self.length], (self.ends - self.length + 1)[self.ends - self.starts >= self.length], n)
        self.proven = cover(tied) & valid
        asked = cover(np.ones(len(self.places), bool)) & valid & ~cover(tied & ~holds)
        self.asked = np.flatnonzero(asked)
        size = np.full(len(self.asked), self.length)
        return Distinct(self.names.long(self.asked, size, np.zeros(len(self.asked))), self.n_buckets)

    def removed(self) -> np.ndarray:
        """Mask of the bytes that go."""
        found = self.suffixes()
        self.proven[self.asked[(found.many | found.answer(self.replies[2], "many"))[found.inverse]]] = True
        at = np.flatnonzero(self.proven)
        return union(at, at + self.length, len(self.text))


def _pack(limit: int):
    def run(batches):
        from pyspark import TaskContext

        part, n, held, ids, total = TaskContext.get().partitionId() << 32, 0, [], [], 0

        def chunk():
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
            row = (part + n, ids, [len(x) for x in held], b"".join(held))
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], ["chunk", "ids", "sizes", "blob"])

        for whole in batches:
            for doc_id, text in zip(whole.column("doc_id"), whole.column("text")):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                if held and total + len(data) > limit:
                    yield chunk()
                    n, held, ids, total = n + 1, [], [], 0
                held.append(data)
                ids.append(doc_id.as_py())
                total += len(data)
        if held:
            yield chunk()

    return run


def _send(step: str, kind: str, length: int, period: int, n_buckets: int):
    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                found = getattr(Chunk(row, length, period, n_buckets), step)()
                sent = list(found.blocks(kind))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, _ in sent], pa.int64()), pa.array([row["chunk"]] * len(sent), pa.int64()), pa.array([x for _, x in sent], pa.binary())],
                    ["bucket", "chunk", "names"],
                )

    return run


def _sort_buckets(kind: str):
    """Answers the names of one bucket after the other: whether other chunks have them, and who is first."""

    def answer(rows):
        held = [np.frombuffer(r["names"], kind) for r in rows]
        names = np.concatenate(held)
        order = np.argsort(names, kind="stable")  # rows come in order of their chunk
        same = np.diff(names[order].astype(np.uint64)) == 0
        many, first = np.zeros(len(names), bool), np.ones(len(names), bool)
        many[order[1:]] |= same
        many[order[:-1]] |= same
        first[order[1:]] = ~same
        cuts = np.cumsum([len(h) for h in held])[:-1]
        pack = lambda mask: pa.array([np.packbits(m).tobytes() for m in np.split(mask, cuts)], pa.binary())
        chunks, buckets = (pa.array([r[c] for r in rows], pa.int64()) for c in ("chunk", "bucket"))
        return pa.RecordBatch.from_arrays([chunks, buckets, pack(many), pack(first)], ["chunk", "bucket", "many", "first"])

    def run(batches):
        rows = []
        for batch in batches:
            for row in batch.to_pylist():
                if rows and rows[-1]["bucket"] != row["bucket"]:
                    yield answer(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield answer(rows)

    return run


def _finish(length: int, period: int, n_buckets: int):
    def run(batches):
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                chunk = Chunk(row, length, period, n_buckets)
                gone = chunk.removed()
                spans, kept = [], []
                for a, b in zip(chunk.starts.tolist(), chunk.ends.tolist()):
                    edges = np.flatnonzero(np.diff(gone[a:b].view(np.int8), prepend=0, append=0))
                    spans.append([{"start": int(x), "end": int(y)} for x, y in zip(edges[::2], edges[1::2])])
                    kept.append(chunk.text[a:b][~gone[a:b]].tobytes() if len(edges) else row["blob"][a:b])
                sizes = pa.array(row["sizes"], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(row["ids"], pa.int64()), sizes, pa.array(spans, span), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    return run


def remove_repeats(
    documents: DataFrame,
    length: int = LENGTH,
    period: int = PERIOD,
    chunk: int = CHUNK,
    names: int = NAMES,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """doc_id, n_bytes, spans ([start, end) of the bytes that go), kept (the bytes that stay) per row.

    Texts are their UTF-8 bytes, null counts as empty; matches stay within a text, may overlap, and
    are judged on the input. A text shorter than `length` keeps all. Repeated rows are copies of each
    other and lose all they share; null ids are kept; other columns are not read. An empty table
    gives an empty result. `period` must be in COVERS and at most `length`. A task holds one chunk or
    one name bucket, a few times the longest text at least.
    """
    spark = documents.sparkSession
    packed = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(_pack(chunk), "chunk long, ids array<long>, sizes array<long>, blob binary")
    table, n = f"chunks_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = packed.write.format("parquet").bucketBy(n, "chunk").sortBy("chunk").option("compression", "zstd")
    writer.option("path", scratch_path(spark, "chunks")).saveAsTable(table)
    chunks = spark.table(table)
    total = chunks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    n_buckets = parts_for(total * len(COVERS[period]) // period, names)
    for k, (step, kind) in enumerate((("samples", "<u4"), ("contexts", "<u8"), ("suffixes", "<u8"))):
        sent = chunks.mapInArrow(_send(step, kind, length, period, n_buckets), "bucket long, chunk long, names binary")
        dealt = sent.repartition("bucket").sortWithinPartitions("bucket", "chunk")
        told = settle(dealt.mapInArrow(_sort_buckets(kind), "chunk long, bucket long, many binary, first binary"), f"replies_{k}")
        masks = ["bucket", "many", "first"] if k == 1 else ["bucket", "many"]
        reply = told.groupBy(F.col("chunk").alias("_c")).agg(F.collect_list(F.struct(*masks)).alias(f"reply_{k}"))
        chunks = chunks.join(reply, F.col("chunk") == F.col("_c"), "left").drop("_c")
    spans = "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"
    return chunks.mapInArrow(_finish(length, period, n_buckets), spans)
