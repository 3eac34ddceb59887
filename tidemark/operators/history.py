"""Version history of a slowly changing entity from the days on which it was extracted.

A key's extracts, in order of time, fall into runs of equal attributes; each run is a version. Runs are
found by comparing a row with the one before it in the order of (key, day). That order is laid out over
range partitions, not over keys: rows within a partition see each other through a window per partition,
and what crosses an edge is carried by one row per partition. A key that has a third of all rows is
spread over as many partitions as its rows fill.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.columns import surrogate
from tidemark.operators.merge import pick_one
from tidemark.plans.marts import OPEN_END
from tidemark.session import settle

PART = "_part"


def dealt(rows: DataFrame, key: str, order: str) -> DataFrame:
    """`rows` in range partitions of (key, order), written with the number of the partition."""
    return settle(rows.repartitionByRange(key, order).withColumn(PART, F.spark_partition_id()), "dealt")


def carried(rows: DataFrame, key: str, order: str, columns: Sequence[str], back: bool) -> DataFrame:
    """One row per partition: `columns` of the row just before its first (`back`) or just after its last."""
    whole, place = F.struct(key, *columns), F.struct(key, order)
    edge = (F.max_by if back else F.min_by)(whole, place)
    edges = rows.groupBy(PART).agg(edge.alias("edge"))
    # As many rows as partitions; an empty partition has none, so the neighbour is the next that has rows.
    beside = (F.lag if back else F.lead)("edge").over(Window.orderBy(PART))
    return edges.select(PART, beside.alias("_carried"))


def with_neighbour(rows: DataFrame, key: str, order: str, columns: Sequence[str], name: str, back: bool = True) -> DataFrame:
    """Adds struct `name`: `columns` of the row before (or after) in the same key, null where there is none."""
    inside = (F.lag if back else F.lead)(F.struct(key, *columns)).over(Window.partitionBy(PART).orderBy(key, order))
    beside = rows.withColumn("_beside", inside).join(carried(rows, key, order, columns, back), PART)
    found = F.coalesce("_beside", "_carried")
    return beside.withColumn(name, F.when(found[key].eqNullSafe(F.col(key)), found)).drop("_beside", "_carried")


def with_number(rows: DataFrame, key: str, order: str, name: str) -> DataFrame:
    """Adds the row's number within its key, from 1; only keys that cross an edge take part in more than a partition."""
    ends = rows.groupBy(PART).agg(F.min(key).alias("first"), F.max(key).alias("last"))
    ends = ends.select(PART, F.explode(F.array_distinct(F.array("first", "last"))).alias(key))
    counts = rows.groupBy(PART, key).agg(F.count(F.lit(1)).alias("n")).join(ends, [PART, key], "left_semi")
    before = counts.withColumn("_before", F.sum("n").over(Window.partitionBy(key).orderBy(PART)) - F.col("n")).drop("n")
    inside = F.row_number().over(Window.partitionBy(PART, key).orderBy(order))
    numbered = rows.withColumn("_inside", inside).join(before, [PART, key], "left")
    return numbered.withColumn(name, (F.col("_inside") + F.coalesce("_before", F.lit(0))).cast("int")).drop("_inside", "_before")


def versions(
    days: DataFrame, key: str, attributes: Sequence[str], day: str = "dt", order: Sequence[str] = ("updated_at",), kept: Sequence[str] = ()
) -> DataFrame:
    """customer_sk-style history: key, attributes, kept columns, valid_from, valid_to, version, is_current.

    Of several extracts of a key on one day the last by `order` counts. A version starts on the first day
    of a run of equal `attributes` (null equals null) and ends on the day before the next one, the last
    one never; so versions neither overlap nor leave gaps, and a value that comes back is a new version.
    `kept` columns are those of the version's first day. Rows without key or day are left out.
    """
    attributes, kept = list(attributes), list(kept)
    daily = pick_one(days.where(F.col(key).isNotNull() & F.col(day).isNotNull()), [key, day], [c for c in order if c != day])
    rows = dealt(daily.select(key, day, *attributes, *[c for c in kept if c not in attributes]), key, day)
    seen = with_neighbour(rows, key, day, attributes, "_last")
    same = F.col("_last").isNotNull()
    for c in attributes:
        same = same & F.col(f"_last.{c}").eqNullSafe(F.col(c))
    starts = settle(seen.where(~same).drop("_last"), "version_starts")
    numbered = with_number(with_neighbour(starts, key, day, [day], "_next", back=False), key, day, "version")
    ends = F.coalesce(F.date_sub(F.col(f"_next.{day}"), 1), F.lit(OPEN_END))
    return numbered.select(
        surrogate(key, day).alias("version_sk"),
        key,
        *attributes,
        *[c for c in kept if c not in attributes],
        F.col(day).alias("valid_from"),
        ends.alias("valid_to"),
        "version",
        F.col("_next").isNull().cast("int").alias("is_current"),
    )
