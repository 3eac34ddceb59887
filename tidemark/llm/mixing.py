"""Mixing sources to target weights by pivotal dependent rounding.

A source's target over its size is the number of copies each of its documents should have. The whole
part is taken for all; the fraction is rounded dependently: two documents with fractional copies
meet and mass (in words) moves between them, in a random direction that leaves both expectations as
they were, until one of them is integral; the other meets the next. So the source's taken words stay
at the target to the last document, and each document's expected copies are exact.

Documents of a source are dealt into leaves of about `leaf` rows (a hot source into many). A leaf is
streamed in falling order of size with one open document in memory and leaves at most one residual;
residuals of `leaf` leaves meet in the next level, until one is left for each source, which is
rounded at random. Random numbers are hashes of the document and the level, so reruns agree.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import row_digest, settle, uniform, whole_row, word_count

LEAF = 512
WEIGHTS = (5.0, 2.0, 1.0)
LIMIT = 3.0
CARRIED = ("source", "leaf", "key", "doc_id", "size", "p", "whole", "source_size", "target")
STATE = "source string, leaf long, key binary, doc_id long, size long, p double, whole int, source_size long, target double, extra int"


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, limit: float = LIMIT) -> DataFrame:
    """(source, source_size, target) from (source, size) rows.

    Sources by code point, null last, weigh `weights` in turn and share the sum of all sizes; a
    target stops at `limit` times its source's size and the excess is shared again by weight until
    none is above. Only sums come to the driver. The rank of a source is one window over one row per
    source.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.expr("row_number() over (order by source is null, source)") - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    table = settle(by_source.withColumn("weight", weight), "source_sizes")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    while True:
        full = F.col("weight") * level > F.col("source_size") * limit
        row = table.agg(
            F.count(F.when(full, 1)).alias("n"),
            F.sum(F.when(full, F.col("source_size")).otherwise(0)).alias("held"),
            F.sum(F.when(~full, F.col("weight")).otherwise(0.0)).alias("open"),
        ).first()
        if row["n"] == stopped or not row["open"]:
            break
        stopped, level = row["n"], (total - limit * row["held"]) / row["open"]
    target = F.least(F.col("weight") * level, F.col("source_size") * F.lit(float(limit)))
    return table.select("source", "source_size", target.alias("target"))


def move_mass(p: float, size: int, q: float, other: int, u: float) -> tuple[float, float]:
    """Copies (p, q) of two documents after mass went one way or the other, by the random number u.

    p * size + q * other stays as it is, the expectations too, and one of the two is 0 or 1 after.
    """
    up = min((1 - p) * size, q * other)  # words that the first can gain from the second
    down = min(p * size, (1 - q) * other)
    if u * (up + down) < down:
        return (1.0, q - up / other) if (1 - p) * size <= q * other else (p + up / size, 0.0)
    return (0.0, q + down / other) if p * size <= (1 - q) * other else (p - down / size, 1.0)


EDGE = 1e-9


def _level(level: int, last: bool):
    """A pass over rows sorted by source and leaf: all documents but one of each leaf are settled."""

    def run(batches):
        open_row, group = None, None

        def close(row):
            if last and row is not None:
                row["p"], row["extra"] = 0.0, int(row["u"] < row["p"])
            return [row] if row is not None else []

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if (row["source"], row["leaf"]) != group:
                    out += close(open_row)
                    open_row, group = None, (row["source"], row["leaf"])
                if open_row is None:
                    pair = [row]
                else:
                    open_row["p"], row["p"] = move_mass(open_row["p"], open_row["size"], row["p"], row["size"], row["u"])
                    pair = [open_row, row]
                open_row = None
                for x in pair:
                    if EDGE < x["p"] < 1 - EDGE:
                        open_row = x
                    else:
                        x["extra"], x["p"] = round(x["p"]), 0.0
                        out.append(x)
            if out:
                yield _rows(out)
        if open_row is not None:
            yield _rows(close(open_row))

    return run


def _rows(rows: list[dict]) -> pa.RecordBatch:
    long, real, small = pa.int64(), pa.float64(), pa.int32()
    kinds = dict(zip((*CARRIED, "extra"), (pa.string(), long, pa.binary(), long, long, real, small, long, real, small)))
    return pa.RecordBatch.from_pydict({k: pa.array([r.get(k) for r in rows], t) for k, t in kinds.items()})


def round_copies(fractions: DataFrame, leaf: int = LEAF, seed: int = 3) -> DataFrame:
    """`extra`, 0 or 1, for rows (source, key, doc_id, size, p and what is carried along) with 0 < p < 1 and
    size > 0. Each level is written to the shared folder."""
    fractions = settle(fractions, "fractions")
    counts = fractions.groupBy(F.col("source").alias("_s")).agg(F.ceil(F.count("*") / leaf).alias("leaves"))
    widest = counts.agg(F.max("leaves")).first()[0] or 0
    rows = (
        fractions.join(counts, F.col("source").eqNullSafe(F.col("_s")))
        .withColumn("leaf", F.pmod(F.xxhash64(F.lit(seed), "key", "doc_id"), "leaves").cast("long"))
        .select(*CARRIED)
    )
    done, level = [], 0
    while True:
        last = widest <= 1
        rows = rows.withColumn("u", uniform(F.lit(seed), F.lit(level), "key", "doc_id", "size"))
        order = ["source", "leaf", F.desc("size"), F.xxhash64("key"), "key", "doc_id"]
        met = rows.repartition("source", "leaf").sortWithinPartitions(*order).mapInArrow(_level(level, last), STATE)
        met = settle(met, f"mixing_level_{level}")
        done.append(met.where("extra is not null"))
        if last:
            break
        widest = -(-widest // leaf)
        rows = met.where("extra is null").withColumn("leaf", F.expr(f"leaf div {leaf}")).drop("extra")
        level += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("leaf")


def mix(
    documents: DataFrame,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
    weights: tuple[float, ...] = WEIGHTS,
    limit: float = LIMIT,
    leaf: int = LEAF,
    seed: int = 3,
) -> DataFrame:
    """key, doc_id, source, size, source_size, target, copies, taken for every row of `documents`.

    Size is the number of words, 0 for null. `copies` times `size` is `taken`; documents without
    words get no copy. `key` is a SHA-256 of the whole row: equal rows are interchangeable. A null source
    is a source of its own, a null id an id like any other; other columns only enter the key. An
    empty table gives an empty result.
    """
    rows = documents.select(
        F.col(source).cast("string").alias("source"),
        row_digest(whole_row(documents)).alias("key"),
        F.col(doc_id).cast("long").alias("doc_id"),
        word_count(F.col(text)).alias("size"),
    )
    rows = settle(rows, "mixing_rows")
    goal = targets(rows, weights, limit).withColumnRenamed("source", "_s")
    share = F.col("target") / F.col("source_size")
    whole = F.floor(share + F.lit(EDGE))
    rows = settle(
        rows.join(goal, F.col("source").eqNullSafe(F.col("_s")))
        .drop("_s")
        .withColumn("whole", F.when(F.col("size") > 0, whole).otherwise(0).cast("int"))
        .withColumn("p", F.when((F.col("size") > 0) & (share - whole > EDGE), share - whole).otherwise(0.0)),
        "mixing_shares",
    )
    sure = rows.where("p = 0").withColumn("extra", F.lit(0))
    out = sure.unionByName(round_copies(rows.where("p > 0"), leaf, seed))
    copies = (F.col("whole") + F.col("extra")).cast("int")
    return out.select("key", "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"))


def mixed(documents: DataFrame, **options) -> DataFrame:
    """The rows of `documents` as often as the mix takes them, with all their columns."""
    copies = mix(documents, **options).groupBy("key").agg(F.sum("copies").cast("int").alias("copies"))
    rows = documents.select(whole_row(documents).alias("row")).withColumn("key", row_digest(F.col("row"))).dropDuplicates(["key"])
    taken = rows.join(copies.where("copies > 0"), "key")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("n")).select("row.*")
