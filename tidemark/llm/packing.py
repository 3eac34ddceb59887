"""Best-fit packing into sequences of several permitted lengths.

A document's length is its number of words and one separator. A document longer than the longest
permitted sequence is cut into full sequences and a rest. Rests and shorter documents are dealt by a
hash into shards of about `shard` pieces, so that no task grows with the data, and a shard is packed
in falling order of length: a piece goes to the open sequence with the least room that still holds
it; if there is none, the length is opened whose cost per word is least, given what can still fill
it. A shard is packed once for each longest length that may be opened, and for each length alone; the
plan of least total cost stands, after every sequence was downsized to the shortest permitted length
that holds it.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import parts_for, row_digest, settle, word_count

LENGTHS = (512, 1024, 2048, 4096, 8192)
SHARD = 4096
PLAN = "doc_id long, key binary, piece int, start long, length long, bin_id string, capacity int, position int"


def cost(capacity: int) -> float:
    """Cost of one sequence: linear work, attention over its length, and a fixed part."""
    return capacity * (1 + capacity / 16384) + 64


def pack(lengths: list[int], permitted: tuple[int, ...], price=cost) -> tuple[list[int], list[int]]:
    """(bin of each piece, capacity of each bin) for lengths in falling order, none above the longest permitted."""
    tops = [i for i, c in enumerate(permitted) if not lengths or c >= lengths[0]]
    best = None
    for opened in [permitted[: i + 1] for i in tops] + [permitted[i : i + 1] for i in tops if i]:
        bins, caps = _best_fit(lengths, opened, price)
        used = [0] * len(caps)
        for size, b in zip(lengths, bins):
            used[b] += size
        caps = [permitted[bisect_left(permitted, u)] for u in used]
        total = sum(map(price, caps))
        if best is None or total < best[0]:
            best = total, bins, caps
    return best[1:] if best else ([], [])


def _best_fit(lengths, permitted, price):
    left = sum(lengths)  # words of the pieces that are still to come
    rooms, by_room, bins, caps = [], defaultdict(list), [], []
    for size in lengths:
        left -= size
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(at)
        else:
            room = min((c for c in permitted if c >= size), key=lambda c: (price(c) / min(c, size + left), c))
            b = len(caps)
            caps.append(room)
        bins.append(b)
        room -= size
        if room:
            if not by_room[room]:
                insort(rooms, room)
            by_room[room].append(b)
    return bins, caps


def _shards(permitted):
    def run(batches):
        held, shard = [], None

        def plan():
            bins, caps = pack([r["length"] for r in held], permitted)
            filled = [0] * len(caps)
            for row, b in zip(held, bins):
                row |= {"bin_id": f"{shard}-{b}", "capacity": caps[b], "position": filled[b]}
                filled[b] += row["length"]
            names = ("doc_id", "key", "piece", "start", "length", "bin_id", "capacity", "position")
            kinds = (pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_pydict({n: pa.array([r[n] for r in held], k) for n, k in zip(names, kinds)})

        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != shard:
                    if held:
                        yield plan()
                    held, shard = [], row["shard"]
                held.append(row)
        if held:
            yield plan()

    return run


#: A word with the blanks after it; the first one has the blanks before it too.
SPACED = r"(?:^[\x20\x09-\x0D]+)?[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"


def identity(doc_id: str, text: str):
    return row_digest(F.struct(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")))


def plan(
    documents: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    permitted: tuple[int, ...] = LENGTHS,
    shard: int = SHARD,
) -> DataFrame:
    """One row per piece: doc_id, key, piece, start (first word), length, bin_id, capacity, position.

    `length` counts the piece's words and, for a document's last piece, the separator; `position` is
    where the piece starts in its sequence. A null or wordless text is one piece of length 1. `key`
    is a SHA-256 of id and text: rows that repeat both are packed once each. Null ids are kept; other
    columns are not read. Every row is packed; an empty table gives an empty plan. Reruns agree.
    """
    permitted = tuple(sorted(permitted))
    top = permitted[-1]
    rows = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        identity(doc_id, text).alias("key"),
        (word_count(F.col(text)) + 1).alias("n"),
    )
    # Rows that repeat id and text are told apart by a number, from one row with their count.
    rows = rows.groupBy("doc_id", "key", "n").agg(F.count("*").cast("int").alias("c"))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("c")))).drop("c")
    pieces = settle(
        rows.withColumn("piece", F.explode(F.sequence(F.lit(0), ((F.col("n") - 1) / top).cast("int"))))
        .withColumn("start", F.col("piece").cast("long") * top)
        .withColumn("length", F.least(F.lit(top).cast("long"), F.col("n") - F.col("start")))
        .drop("n"),
        "pieces",
    )
    whole = pieces.where(F.col("length") == top).select(
        "doc_id", "key", "piece", "start", "length",
        F.concat_ws("-", F.lit("full"), F.col("doc_id"), F.hex("key"), F.col("copy"), F.col("piece")).alias("bin_id"),
        F.lit(top).alias("capacity"), F.lit(0).alias("position"),
    )
    short = pieces.where(F.col("length") < top)
    n_shards = parts_for(short.count(), shard)
    dealt = short.withColumn("shard", F.pmod(F.xxhash64("key", "copy", "piece"), F.lit(n_shards)))
    order = ["shard", F.desc("length"), F.xxhash64("key"), "key", "doc_id", "piece"]
    packed = dealt.repartition("shard").sortWithinPartitions(*order).mapInArrow(_shards(permitted), PLAN)
    return whole.unionByName(packed)


def sequences(
    documents: DataFrame,
    planned: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    permitted: tuple[int, ...] = LENGTHS,
    separator: str = "<|end|>",
) -> DataFrame:
    """One row per sequence: bin_id, capacity, used, doc_ids, starts, lengths, the packed text and spans.

    A piece is cut out of its document as it stands, with its line breaks, tabs and blanks, so a document's
    pieces in order, joined, are its text, byte for byte; a null text is empty. After a document's last
    piece come a blank and the separator, between pieces a blank. `spans` has the [start, end) of each piece in
    characters of the packed text, separator not included. A sequence gathers at most `capacity` words.
    """
    top = max(permitted)
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = documents.select(identity(doc_id, text).alias("_key"), whole.alias("_whole"), F.regexp_extract_all(whole, F.lit(SPACED), F.lit(0)).alias("_words"))
    last = F.floor(F.size("_words") / top).cast("int")
    texts = F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice("_words", i * top + 1, F.lit(top)), ""))
    texts = F.when(F.size("_words") == 0, F.array("_whole")).otherwise(texts)
    held = rows.select("_key", last.alias("_last"), F.posexplode(texts).alias("_piece", "_text")).dropDuplicates(["_key", "_piece"])
    joined = planned.join(held, (F.col("key") == F.col("_key")) & (F.col("piece") == F.col("_piece")))
    tail = F.when(F.col("_piece") == F.col("_last"), F.lit(f" {separator}")).otherwise("")
    piece = F.struct("position", "doc_id", "start", "length", F.col("_text").alias("text"), tail.alias("tail"))
    held = joined.groupBy("bin_id", "capacity").agg(F.sort_array(F.collect_list(piece)).alias("p"))

    def upto(done, x):
        begin = F.when(F.size(done) > 0, F.element_at(done, -1)["next"]).otherwise(0)
        end = begin + F.length(x["text"])
        return F.concat(done, F.array(F.struct(begin.alias("start"), end.alias("end"), (end + F.length(x["tail"]) + 1).alias("next"))))

    none = F.array().cast("array<struct<start:int,end:int,next:int>>")
    spans = F.transform(F.aggregate("p", none, upto), lambda s: F.struct(s["start"], s["end"]))
    return held.select(
        "bin_id",
        "capacity",
        F.aggregate("p.length", F.lit(0).cast("long"), lambda a, x: a + x).alias("used"),
        F.col("p.doc_id").alias("doc_ids"),
        F.col("p.start").alias("starts"),
        F.col("p.length").alias("lengths"),
        F.array_join(F.transform("p", lambda x: F.concat(x["text"], x["tail"])), " ").alias("text"),
        spans.alias("spans"),
    )
