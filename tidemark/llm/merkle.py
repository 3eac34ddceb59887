"""Merkle manifest of a dataset: a persistent tree that is changed by copying paths.

Rows become leaves; each language's leaves, in order, are hashed in runs of eight until one node is
left, its subroot, and the subroots are hashed the same way into the root. Leaves are numbered by range
partitions and partition counts, so a language with most of the rows is never one task's group.

The tree is built and read in aligned blocks of 8^4 nodes, one task's group at a time: a block gives its
root, the block roots are the leaves of the next round, and 8^4-fold shrinking leaves a handful of
rounds. On the way down each block learns the siblings between its root and the whole tree's root.

Versions are persistent. A changed leaf makes a version that shares every node but its leaf's
ancestors: those within the block are copied there, those above by folding the block's copy with the
siblings above, one row per version, however many versions lie below one upper node.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tidemark.llm.common import lower_ascii, settle

FAN = 8
ROUND = 4  # levels of a block
BLOCK = FAN**ROUND

NODE = "grp long, pos long, n long, digest string"
PATH = "grp long, pos long, lefts array<string>, rights array<string>"


def encoded(value: Column) -> Column:
    """`-` for null, otherwise UTF-8 byte count, colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def height(n: int) -> int:
    """Levels above n nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def parent(digests: list[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def climb(digests: list[str], n: int) -> list[list[str]]:
    """A block's nodes level by level; `n` is the number of nodes of the whole group on the lowest of them."""
    levels = [digests]
    for _ in range(min(ROUND, height(n))):
        below = levels[-1]
        levels.append([parent(below[i : i + FAN]) for i in range(0, len(below), FAN)])
    return levels


def siblings(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    """What stands left and right of a node and its ancestors in their runs, up to the block's root."""
    found = []
    for nodes in levels[:-1]:
        start = at - at % FAN
        found.append(("".join(nodes[start:at]), "".join(nodes[at + 1 : start + FAN])))
        at //= FAN
    return found


def fold(digest: str, steps: list[tuple[str, str]]) -> list[str]:
    """The copies that a changed node makes of its ancestors."""
    copies = []
    for left, right in steps:
        digest = sha256(f"{left}{digest}{right}".encode()).hexdigest()
        copies.append(digest)
    return copies


def _number(columns: list[str], group: str):
    """Numbers rows within each group of a sorted partition and adds the partition's number."""

    def run(batches):
        from pyspark import TaskContext

        part, last, at = TaskContext.get().partitionId(), object(), 0
        for batch in batches:
            local = []
            for value in batch.column(group).to_pylist():
                at = at + 1 if value == last else 0
                last = value
                local.append(at)
            rows = [*batch.columns, pa.array([part] * len(local), pa.int32()), pa.array(local, pa.int64())]
            yield pa.RecordBatch.from_arrays(rows, [*columns, "part", "local"])

    return run


def placed(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """`rows` with `pos`, the number of the row in its group from 0, nulls first; no group is gathered in one task."""
    by = [F.asc_nulls_first(c) for c in (group, *order)]
    schema = StructType([*rows.schema.fields, StructField("part", IntegerType()), StructField("local", LongType())])
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(_number(rows.columns, group), schema)
    dealt = settle(dealt, "placed")
    before = dealt.groupBy(F.col(group).alias("_group"), F.col("part").alias("_part")).agg(F.count("*").alias("_n"))
    before = before.withColumn("before", F.expr("sum(_n) over (partition by _group order by _part) - _n"))
    joined = dealt.join(before, F.col(group).eqNullSafe(F.col("_group")) & (F.col("part") == F.col("_part")))
    return joined.select(*rows.columns, (F.col("before") + F.col("local")).alias("pos"))


def block_of(pos: str = "pos") -> Column:
    return F.expr(f"{pos} div {BLOCK}")


def _block_root(key: tuple, table: pa.Table) -> pa.Table:
    table = table.sort_by("pos")
    n = table["n"][0].as_py()
    top = climb(table["digest"].to_pylist(), n)[-1]
    row = {"grp": [key[0].as_py()], "pos": [key[1].as_py()], "n": [-(-n // BLOCK)], "digest": top}
    return pa.table({k: pa.array(v, pa.string() if k == "digest" else pa.int64()) for k, v in row.items()})


def rounds(nodes: DataFrame) -> list[DataFrame]:
    """Nodes (grp, pos, n, digest) of the lowest level of each round of blocks; the last has one node per group."""
    found = [settle(nodes, "merkle_nodes")]
    while (found[-1].agg(F.max("n")).first()[0] or 1) > 1:
        roots = found[-1].groupBy("grp", block_of().alias("block")).applyInArrow(_block_root, NODE)
        found.append(settle(roots, "merkle_nodes"))
    return found


def _steps(key: tuple, nodes: pa.Table, above: pa.Table) -> pa.Table:
    nodes = nodes.sort_by("pos")
    levels = climb(nodes["digest"].to_pylist(), nodes["n"][0].as_py())
    lefts, rights = above["lefts"][0].as_py(), above["rights"][0].as_py()
    steps = [siblings(levels, i) for i in range(nodes.num_rows)]
    return pa.table(
        {
            "grp": nodes["grp"],
            "pos": nodes["pos"],
            "lefts": pa.array([[a for a, _ in s] + lefts for s in steps], pa.list_(pa.string())),
            "rights": pa.array([[b for _, b in s] + rights for s in steps], pa.list_(pa.string())),
        }
    )


def paths(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """(grp, pos, lefts, rights): siblings from each node of the lowest round up to the root; `above` starts at the groups' roots."""
    for nodes in reversed(levels):
        blocks = nodes.groupBy("grp", block_of().alias("block")).cogroup(above.groupBy("grp", F.col("pos").alias("block")))
        above = settle(blocks.applyInArrow(_steps, PATH), "merkle_paths")
    return above


PROVED = "row long, doc_id long, lang_no long, pos long, n long, leaf string, changed boolean, proof_sha256 string, copies array<string>, node string"


def _prove(key: tuple, leaves: pa.Table, above: pa.Table) -> pa.Table:
    leaves = leaves.sort_by("pos")
    digests = leaves["leaf"].to_pylist()
    levels = climb(digests, leaves["n"][0].as_py())
    upper = "".join(a + b for a, b in zip(above["lefts"][0].as_py(), above["rights"][0].as_py()))
    proofs, copies, nodes = [], [], []
    for i, new in enumerate(leaves["new_leaf"].to_pylist()):
        steps = siblings(levels, i)
        proofs.append(sha256(("".join(a + b for a, b in steps) + upper).encode()).hexdigest())
        digest = digests[i] if new is None else new
        made = fold(digest, steps)
        nodes.append(made[-1] if made else digest)
        copies.append(None if new is None else made)
    out = {c: leaves[c] for c in ("row", "doc_id", "lang_no", "pos", "n", "leaf")}
    out |= {"changed": leaves["new_leaf"].is_valid(), "proof_sha256": pa.array(proofs), "copies": pa.array(copies, pa.list_(pa.string()))}
    return pa.table(out | {"node": pa.array(nodes)})


class Manifest:
    """A built tree: `proved` has a row per leaf, `root` the root (None for an empty table)."""

    def __init__(self, docs: DataFrame, tampered: Column | None = None):
        """`tampered` tells which rows get a version in which A-Z of the text are in lower case."""
        columns = ("doc_id", "source", "lang", "n_chars", "text")
        digest, new = (leaf_digest(*[F.col(c) for c in columns[:-1]], t) for t in (F.col("text"), lower_ascii(F.col("text"))))
        tampered = F.lit(False) if tampered is None else tampered
        rows = docs.select(
            F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
            digest.alias("leaf"), F.when(tampered, new).alias("new_leaf"),
        )
        leaves = settle(placed(settle(rows, "merkle_leaves"), "lang", "doc_id", "leaf", "row"), "merkle_places")
        groups = leaves.groupBy("lang").agg(F.count("*").alias("n")).withColumn("all", F.lit(0))
        groups = settle(placed(groups, "all", "lang").select("n", F.col("lang").alias("_lang"), F.col("pos").alias("lang_no")), "merkle_langs")
        self.leaves = settle(leaves.join(groups, F.col("lang").eqNullSafe(F.col("_lang"))).drop("_lang"), "merkle_numbered")

        inner = rounds(self.leaves.select(F.col("lang_no").alias("grp"), "pos", "n", F.col("leaf").alias("digest")))
        one = F.lit(0).cast("long")
        subroots = inner[-1].select(one.alias("grp"), F.col("grp").alias("pos"), F.lit(groups.count()).cast("long").alias("n"), "digest")
        top = rounds(subroots)
        found = top[-1].first()
        self.root = found["digest"] if found else None

        none = F.array().cast("array<string>")
        over = paths(top, top[-1].select("grp", "pos", none.alias("lefts"), none.alias("rights")))
        self.above = over.select(F.col("pos").alias("grp"), one.alias("pos"), "lefts", "rights")
        subroot = subroots.select(F.col("pos").alias("lang_no"), F.col("digest").alias("subroot"))
        if len(inner) > 1:
            self.above = paths(inner[1:], self.above)
        blocks = self.leaves.groupBy("lang_no", block_of().alias("block")).cogroup(self.above.groupBy(F.col("grp").alias("lang_no"), F.col("pos").alias("block")))
        self.proved = settle(blocks.applyInArrow(_prove, PROVED), "merkle_proved").join(subroot, "lang_no")

    def _upper(self) -> DataFrame:
        """Every leaf with the copies of its ancestors above its block."""
        above = self.above.select(F.col("grp").alias("lang_no"), F.col("pos").alias("block"), "lefts", "rights")
        digest = lambda made: F.element_at(made, -1)
        made = F.aggregate(
            F.arrays_zip("lefts", "rights"),
            F.array("node"),
            lambda made, step: F.concat(made, F.array(F.sha2(F.concat(step["lefts"], digest(made), step["rights"]), 256))),
        )
        rows = self.proved.withColumn("block", block_of()).join(above, ["lang_no", "block"])
        return rows.withColumn("upper", made).withColumn("folded_root", digest(F.col("upper"))).drop("block", "lefts", "rights")

    def verify(self) -> DataFrame:
        """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: one row per leaf.

        `folded_root` is computed from the changed leaf, where the row has a version, and the original
        siblings; `proof_sha256` hashes these siblings from leaf to root.
        """
        told = self._upper().withColumn("root", F.lit(self.root).cast("string"))
        return told.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))

    def versions(self) -> DataFrame:
        """version, doc_id, lang_no, pos, level, digest: the nodes that each version has of its own, from level 1 to its root.

        `version` is the changed row's number; every other node is shared with the tree itself.
        """
        changed = self._upper().where("changed").withColumn("own", F.concat("copies", F.slice("upper", 2, F.size("upper"))))
        return changed.select(F.col("row").alias("version"), "doc_id", "lang_no", "pos", F.posexplode("own").alias("level", "digest")).withColumn("level", F.col("level") + 1)


def manifest(docs: DataFrame, tampered: Column | None = None) -> Manifest:
    """The tree over all rows, which must have doc_id, source, lang, n_chars and text.

    Null values are hashed as `-`; rows without a language form the first language, rows without an id
    come first in theirs. Rows of one id are ordered by leaf; equal rows are leaves of their own and
    interchangeable. Texts of any length are hashed whole. Further columns are not read; an empty
    table has no root and gives no rows.
    """
    return Manifest(docs, tampered)
