"""Chat formatting by perspective rotation.

A dialogue is rendered once for each participant, with that speaker as the assistant, all others as
named users and system turns as they are; the loss mask covers what the assistant says.

A dialogue may have any number of turns, so it is never one task's group. Turns are range-partitioned
by dialogue and place, numbered within partitions, and the numbers are shifted by the partitions'
counts. A rendering comes in parts of `per_part` turns with their offset in the whole: the parts in
order, joined, are the rendering.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import settle

PER_PART = 64
SYSTEM = "system"
NOBODY = "unknown"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _number(schema_names):
    """Numbers rows within each dialogue of a sorted partition; adds the partition's number."""

    def run(batches):
        from pyspark import TaskContext

        part, last, n = TaskContext.get().partitionId(), object(), 0
        for batch in batches:
            convs, local = batch.column("conv_id").to_pylist(), np.empty(batch.num_rows, np.int64)
            for i, conv in enumerate(convs):
                n = n + 1 if conv == last else 0
                local[i], last = n, conv
            columns = [*batch.columns, pa.array(np.full(batch.num_rows, part), pa.int32()), pa.array(local)]
            yield pa.RecordBatch.from_arrays(columns, [*schema_names, "part", "local"])

    return run


def placed(turns: DataFrame) -> DataFrame:
    """`turns` (conv_id, turn, speaker, text) with `place`, the number of the turn in its dialogue from 0.

    Order: turn (null last), speaker, a hash of the text. The place of a row among equal rows does
    not matter, so a running number may split them over tasks.
    """
    order = [F.asc_nulls_last("conv_id"), F.asc_nulls_last("turn"), "speaker", "h"]
    rows = turns.withColumn("h", F.xxhash64("text")).withColumn("any", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order, "any").sortWithinPartitions(*order, "text").select("conv_id", "turn", "speaker", "text")
    rows = settle(rows.mapInArrow(_number(rows.columns), "conv_id long, turn long, speaker string, text string, part int, local long"), "chat_turns")
    before = rows.groupBy(F.col("conv_id").alias("_c"), F.col("part").alias("_p")).agg(F.count("*").alias("n"))
    before = before.withColumn("before", F.expr("sum(n) over (partition by _c order by _p) - n")).drop("n")
    joined = rows.join(before, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("part") == F.col("_p")))
    return joined.select("conv_id", "turn", "speaker", "text", (F.col("before") + F.col("local")).alias("place"))


def safe_name(name):
    """A name that fits in a header: other characters become _, and a checksum tells such names apart."""
    clean = F.regexp_replace(name, r"[^\p{L}\p{N}_.-]", "_")
    return F.when(clean == name, name).otherwise(F.concat(clean, F.lit("-"), F.hex(F.crc32(name.cast("binary")))))


def rotate(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text", per_part: int = PER_PART) -> DataFrame:
    """conv_id, speaker, part, offset, n_turns, text, spans: one row per participant and `per_part` turns.

    Every speaker but `system` is a participant; a null or blank speaker is called `unknown`. A
    dialogue of system turns alone has no rendering. `spans` lists [start, end) of what the
    assistant says, its end mark included, in characters of the part's text; `offset` is the part's
    place in the whole. Markers within a text get a zero-width space, so they open no turn. A null
    text counts as empty; empty assistant turns still train their end mark. Turns without an id form a
    dialogue of their own; repeated rows are repeated turns. Other columns are not read. An empty
    table gives an empty result.
    """
    who = F.col(speaker).cast("string")
    turns = conversations.select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.when(who.isNull() | (F.trim(who) == ""), NOBODY).otherwise(who).alias("speaker"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    turns = placed(turns)
    people = turns.where(F.col("speaker") != SYSTEM).select(F.col("conv_id").alias("_c"), F.col("speaker").alias("me")).distinct()
    seen = turns.join(people, F.col("conv_id").eqNullSafe(F.col("_c"))).drop("_c")
    mine = F.col("speaker") == F.col("me")
    role = F.when(mine, "assistant").when(F.col("speaker") == SYSTEM, SYSTEM).otherwise(F.concat(F.lit("user name="), safe_name(F.col("speaker"))))
    head = F.concat(F.lit(OPEN), role, F.lit("\n"))
    body = F.concat(F.replace(F.col("text"), F.lit("<|"), F.lit("<​|")), F.lit(CLOSE))
    seen = seen.select("conv_id", "me", "place", mine.alias("mine"), F.length(head).alias("head"), F.concat(head, body, F.lit("\n")).alias("said"))
    part = F.expr(f"place div {per_part}")
    parts = seen.groupBy("conv_id", "me", part.alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("place", "mine", "head", "said"))).alias("t")
    )
    ends = F.aggregate(
        "t.said", F.array(F.lit(0)), lambda done, said: F.concat(done, F.array(F.element_at(done, -1) + F.length(said)))
    )
    parts = parts.withColumn("ends", ends)
    spans = F.transform("t", lambda x, i: F.struct((F.get("ends", i) + x["head"]).alias("start"), (F.get("ends", i + 1) - 1).alias("end"), x["mine"].alias("mine")))
    spans = F.transform(F.filter(spans, lambda s: s["mine"]), lambda s: F.struct(s["start"], s["end"]))
    sized = parts.select(
        "conv_id", F.col("me").alias("speaker"), "part", F.size("t").alias("n_turns"),
        F.array_join("t.said", "").alias("text"), spans.alias("spans"), F.element_at("ends", -1).cast("long").alias("n_chars"),
    )
    sized = settle(sized, "chat_parts")
    # Offsets come from the parts' sizes alone, so that no task gathers a dialogue's text.
    offset = F.expr("sum(n_chars) over (partition by conv_id, speaker order by part) - n_chars")
    at = sized.select(F.col("conv_id").alias("_c"), F.col("speaker").alias("_s"), F.col("part").alias("_p"), offset.alias("offset"))
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("speaker") == F.col("_s")) & (F.col("part") == F.col("_p"))
    return sized.join(at, same).select("conv_id", "speaker", "part", "offset", "n_turns", "text", "spans")
