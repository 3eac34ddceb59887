import math

import numpy as np
import pytest

from tidemark.llm import topk

KINDS = "vec_id long, embedding array<float>, label int, id int, part int, v int"


def brute(rows, k):
    usable = {}
    for i, v, *_ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable[i] = [math.floor(64 * float(np.float32(x))) for x in v]
    out = []
    for q, a in usable.items():
        if q % 5 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable.items() if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def rows_of(n, seed=0, common=0):
    rnd = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rnd.normal(0, 0.2, 12)]) for i in range(n)]
    for i in range(common):
        rows[-1 - i] = (rows[-1 - i][0], rows[0][1])  # ties: one common vector
    rows += [(n, None), (n + 1, [1.0, None] + [0.0] * 10), (n + 2, [float("nan")] * 12), (n + 3, [float("inf")] * 12), (None, [0.1] * 12)]
    rows += [rows[3], (n + 5 - n % 5, []), (n + 10 - n % 5, [0.5, -0.5])]
    return [(i, v, 0, 1, 2, 3) for i, v in rows]


@pytest.mark.parametrize("shape", [dict(shard=4096, per_block=4096, block=2048), dict(shard=60, per_block=16, block=7)])
def test_matches_brute_force(spark, shape):
    rows = rows_of(300, common=90)
    vectors = topk.usable(spark.createDataFrame(rows, KINDS))
    got = topk.top_k(vectors, vectors.where("id % 5 = 0"), k=20, **shape)
    assert sorted(map(tuple, got.collect())) == brute(rows, 20)


def test_fewer_candidates_than_k(spark):
    rows = rows_of(8)
    vectors = topk.usable(spark.createDataFrame(rows, KINDS))
    got = topk.top_k(vectors, vectors.where("id % 5 = 0"))
    assert sorted(map(tuple, got.collect())) == brute(rows, 20)


def test_empty_tables(spark):
    vectors = topk.usable(spark.createDataFrame([], KINDS))
    assert topk.top_k(vectors, vectors).count() == 0


def test_later_blocks_are_skipped_or_pruned():
    """Once k good vectors are known, a block whose bound is too low is not traversed, others in part."""
    rnd = np.random.default_rng(1)
    good, fair, poor = rnd.integers(50, 60, (40, 8)), rnd.integers(0, 56, (400, 8)), rnd.integers(0, 5, (4000, 8))
    columns = np.concatenate([good, fair, poor]).T.astype(float)
    bounds = [(s, e, columns[:, s:e].min(1), columns[:, s:e].max(1)) for s, e in ((0, 40), (40, 440), (440, 4440))]
    queries, seen = rnd.integers(1, 5, (30, 8)).astype(float), []
    who, scores, ids = topk.max_score(queries, np.full(30, -1), np.arange(4440), columns, bounds, 20, seen)
    for q in range(30):
        assert (scores[who == q] == np.sort(queries[q] @ columns)[::-1][:20]).all()
    assert sum(seen) < 30 * 8 * 440 + 1  # of 4440 vectors, none of the last 4000
    assert sum(seen[1:]) < 0.9 * 30 * 8 * 400


def test_several_vectors_of_the_querys_id_prune_no_other():
    columns = np.array([[100.0, 99, 10, 5, 1]])
    bounds = [(0, 5, columns.min(1), columns.max(1))]
    _, scores, found = topk.max_score(np.array([[1.0]]), np.array([7]), np.array([7, 7, 1, 2, 3]), columns, bounds, 2)
    assert scores.tolist() == [10, 5] and found.tolist() == [1, 2]


def test_an_id_with_several_vectors_against_brute_force(spark):
    rnd = np.random.default_rng(2)
    vectors = [(i % 40 if i < 60 else i, [float(x) for x in rnd.normal(0, 0.2, 6)]) for i in range(200)]
    table = topk.usable(spark.createDataFrame([(i, v, 0, 1, 2, 3) for i, v in vectors], KINDS))
    whole = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in vectors]
    ranked = {}
    for q in (5, 70):
        mine = [v for i, v in whole if i == q]
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for a in mine for i, b in whole if i != q)
        ranked[q] = [(i, -s) for s, i in scored[:5]]
    for q, want in ranked.items():
        have = topk.top_k(table, table.where(f"id = {q}"), k=5, block=16).orderBy("rank").collect()
        assert [(r.vec_id, r.score) for r in have] == want
