"""Exact top-k by inner product with MaxScore.

Vectors become integers floor(64 * x). A dimension is a term and a shard's column of values its
posting list; relative to the column's least (or, for a negative query weight, greatest) value every
contribution is nonnegative, so a term has a score bound: weight times the column's spread. For each
query the terms are ordered by their bounds. The terms whose bounds together cannot lift a vector
from the floor to the k-th best score so far are non-essential. Only essential lists are traversed for
all vectors of a block; the other terms are probed one by one, largest bound first, for the vectors
that can still reach the k-th best score, or all at once where these are many. Queries go through a
shard in groups, as one product.

Shards and blocks of queries have bounded numbers of rows and meet pair by pair, so neither side is
broadcast. A shard gives at most k rows a query; these are merged by rank.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import parts_for, settle

SHARD = 4096
QUERIES = 4096
BLOCK = 2048
PROBES = 64  # vectors of a block that a query probes term by term
EXACT = 2**53  # doubles hold integers below exactly


def integers(vector: Column, scale: int = 64) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(id, v) of rows with an id and a vector without null or non-finite components; equal rows once."""
    v = F.col(embedding)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.where(F.col(vec_id).isNotNull() & v.isNotNull() & fine)
    return rows.select(F.col(vec_id).cast("long").alias("id"), integers(v).alias("v")).distinct()


def matrix(column) -> np.ndarray:
    """Rows of a list column, padded with zeros to the longest."""
    lists = column.to_pylist()
    width = max(map(len, lists), default=0)
    out = np.zeros((len(lists), width), np.int64)
    for i, v in enumerate(lists):
        out[i, : len(v)] = v
    return out


def best_of(query: np.ndarray, score: np.ndarray, vec: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best (query, score, id) rows of each query, sorted: higher score first, then smaller id."""
    order = np.lexsort((vec, -score, query))
    query, score, vec = query[order], score[order], vec[order]
    first = np.searchsorted(query, query)
    keep = np.arange(len(query)) - first < k
    return query[keep], score[keep], vec[keep]


def raise_least(least: np.ndarray, rows: np.ndarray, score: np.ndarray, k: int, own: tuple[np.ndarray, np.ndarray], below) -> None:
    """Partial scores only rise, so the k-th best is at least the k-th of them; `own` places (row, vector) do not count."""
    if score.shape[1] >= k:
        if len(own[0]):
            score = score.copy()
            score[own] = below
        least[rows] = np.maximum(least[rows], np.partition(score, -k, axis=1)[:, -k])


def max_score(queries: np.ndarray, own: np.ndarray, ids: np.ndarray, columns: np.ndarray, bounds: list, k: int, seen=None):
    """(query row, score, id) of the k best vectors of a shard for each query; `columns` is (dimensions, vectors).

    `bounds` lists each block's (start, end, least value, greatest value of every dimension). Numbers
    are doubles while every possible score is exact in them, 64-bit integers otherwise. `seen` collects
    how many (query, vector, term) products were made.
    """
    m, d = queries.shape
    top_q, top_s, top_i = np.empty(0, np.int64), np.empty(0, columns.dtype), np.empty(0, np.int64)
    below = -(2**62) if columns.dtype.kind == "i" else -np.inf
    least = np.full(m, below, columns.dtype)  # the k-th best score, of queries that have k
    rows = np.arange(m)[:, None]
    for start, end, low, high in bounds:
        base = np.where(queries > 0, low, high)
        spread = np.abs(queries) * (high - low)
        order = np.argsort(-spread, axis=1, kind="stable")
        rest = np.zeros((m, d + 1), columns.dtype)  # bound of the terms from a rank on
        rest[:, :d] = np.cumsum(spread[rows, order][:, ::-1], axis=1)[:, ::-1]
        floor = (queries * base).sum(1)
        # Terms from rank `essential` on cannot lift a vector from the floor to the k-th best score.
        able = floor[:, None] + rest >= least[:, None]
        essential = np.minimum(able.sum(1), d)
        live = np.flatnonzero(able[:, 0])
        if not len(live):
            continue
        chosen = np.zeros((len(live), d), bool)
        chosen[np.arange(len(live))[:, None], order[live]] = np.arange(d) < essential[live, None]
        weights = np.where(chosen, queries[live], 0)
        score = weights @ columns[:, start:end] + (floor[live] - (weights * base[live]).sum(1))[:, None]
        done = essential.copy()
        mine = np.nonzero(own[live][:, None] == ids[start:end])
        raise_least(least, live, score, k, mine, below)
        hopes = score + rest[live, done[live], None] >= least[live, None]
        many = np.flatnonzero((hopes.sum(1) > PROBES) & (done[live] < d))
        if len(many):  # so many can still compete that the other terms are cheaper as a product too
            others = np.where(chosen[many], 0, queries[live[many]])
            score[many] += others @ columns[:, start:end] - (others * base[live[many]]).sum(1)[:, None]
            done[live[many]] = d
            mine = np.nonzero(own[live[many]][:, None] == ids[start:end])
            raise_least(least, live[many], score[many], k, mine, below)
            hopes[many] = score[many] >= least[live[many], None]
        if seen is not None:
            seen.append(int(done[live].sum()) * (end - start))
        q, at = np.nonzero(hopes)
        score, q, at = score[q, at], live[q], at + start
        done = done[q]
        while (open_ := done < d).any():  # probe one more term for all that can still compete
            term = order[q[open_], done[open_]]
            score[open_] += queries[q[open_], term] * (columns[term, at[open_]] - base[q[open_], term])
            done[open_] += 1
            if seen is not None:
                seen.append(int(open_.sum()))
            stay = score + rest[q, done] >= least[q]
            q, at, score, done = q[stay], at[stay], score[stay], done[stay]
        other = ids[at] != own[q]
        parts = zip((top_q, top_s, top_i), (q[other], score[other], ids[at[other]]))
        top_q, top_s, top_i = best_of(*[np.concatenate(p) for p in parts], k)
        last = np.flatnonzero(np.diff(top_q, append=-1))  # each query's worst row so far
        last = last[np.bincount(top_q, minlength=m)[top_q[last]] >= k]
        least[top_q[last]] = np.maximum(least[top_q[last]], top_s[last])
    return top_q, top_s, top_i


PACKED = "part long, width int, kind string, ids binary, v binary"


def _pack(table: pa.Table) -> pa.Table:
    v = matrix(table["v"])
    kind = next(t for t in ("<i2", "<i4", "<i8") if (v == v.astype(t)).all())
    row = (table["part"][0].as_py(), v.shape[1], kind, table["id"].to_numpy().astype("<i8").tobytes(), v.astype(kind).tobytes())
    kinds = (pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.binary())
    return pa.table({n: pa.array([x], t) for n, x, t in zip(("part", "width", "kind", "ids", "v"), row, kinds)})


def _parts(rows: DataFrame, per_part: int) -> tuple[DataFrame, int]:
    n = parts_for(rows.count(), per_part)
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(n)).cast("long"))
    return settle(dealt.groupBy("part").applyInArrow(_pack, PACKED), "vector_parts"), n


def _unpack(row: dict, side: str) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row[f"{side}ids"], "<i8")
    v = np.frombuffer(row[f"{side}v"], row[f"{side}kind"]).astype(np.int64)
    return ids, v.reshape(len(ids), row[f"{side}width"])


def _search(k: int, block: int, group: int = 256):
    names = ["query_id", "vec_id", "score"]

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                query_ids, queries = _unpack(row, "q_")
                ids, vectors = _unpack(row, "")
                width = max(queries.shape[1], vectors.shape[1])
                queries, vectors = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (queries, vectors))
                most = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(width, 1)
                kind = np.float64 if most < EXACT else np.int64
                queries, columns = queries.astype(kind), np.ascontiguousarray(vectors.T.astype(kind))
                bounds = []
                for start in range(0, len(ids), block):
                    part = columns[:, start : start + block]
                    bounds.append((start, start + part.shape[1], part.min(1), part.max(1)))
                for q in range(0, len(queries), group):
                    who, score, vec = max_score(queries[q : q + group], query_ids[q : q + group], ids, columns, bounds, k)
                    if len(who):
                        found = [pa.array(query_ids[q : q + group][who]), pa.array(vec), pa.array(score.astype(np.int64))]
                        yield pa.RecordBatch.from_arrays(found, names)

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, shard: int = SHARD, per_block: int = QUERIES, block: int = BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest integer inner products.

    Both tables are (id, v) with integer vectors, see `usable`; ties go to the smaller id and a query
    is no candidate of its own. Vectors of other lengths count as filled up with zeros. All
    candidates are given if there are fewer than k; an empty side gives an empty result. An id with
    several vectors is a candidate with each of them, and none of these for queries of that id, whose
    vectors share one ranking.
    """
    shards, _ = _parts(vectors, shard)
    blocks, n_blocks = _parts(queries, per_block)
    blocks = blocks.select(F.col("part").alias("q_part"), *[F.col(c).alias(f"q_{c}") for c in ("width", "kind", "ids", "v")])
    pairs = shards.withColumn("q_part", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)).cast("array<long>")))
    pairs = pairs.join(blocks, "q_part").repartition("part", "q_part")
    found = pairs.mapInArrow(_search(k, block), "query_id long, vec_id long, score long")
    rank = F.expr("row_number() over (partition by query_id order by score desc, vec_id)")
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
