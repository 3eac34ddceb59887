import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup
from tidemark.llm.common import crc_mod


def brute(rows):
    groups = defaultdict(list)
    for d, t, *_ in rows:
        groups[t or ""].append(d)
    out = Counter()
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep, kept = max(known, default=None), False
        for i in ids:
            mine = i == keep and not kept
            kept |= mine
            out[i, keep, len(ids), mine, hashlib.sha256(t.encode()).hexdigest()] += 1
    return out


def got(df):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect())


@pytest.mark.parametrize("old", ["even", "all", "none"])
def test_marks_match_brute_force(edge, edge_list, old):
    which = {"even": crc_mod(F.col("doc_id"), 2) == 0, "all": F.lit(True), "none": F.lit(None).cast("boolean")}[old]
    assert got(exact_dedup.mark(edge, which)) == brute(edge_list)


def test_kept_rows_keep_their_columns(edge, edge_list):
    kept = exact_dedup.keep(edge, F.col("doc_id") < 50)
    assert kept.columns == edge.columns
    assert Counter(r.text or "" for r in kept.collect()) == Counter({t or "": 1 for _, t, *_ in edge_list})


def test_empty_table(no_docs):
    assert exact_dedup.mark(no_docs, F.lit(True)).count() == 0
    assert exact_dedup.keep(no_docs, F.lit(True)).count() == 0


def test_hash_is_minimal_and_perfect_and_foreign_digests_do_not_match():
    digests = np.frombuffer(b"".join(hashlib.sha256(bytes([i % 256, i // 256])).digest() for i in range(3000)), np.uint8).reshape(-1, 32)
    own, foreign = digests[:2000], digests[2000:]
    sizes, bits, slots = exact_dedup.build_hash(own)
    assert sorted(slots) == list(range(2000))
    assert (exact_dedup.find_slots(own, sizes, bits) == slots).all()
    table = np.empty_like(own)
    table[slots] = own
    at = exact_dedup.find_slots(foreign, sizes, bits)
    assert not (table[at[at >= 0]] == foreign[at >= 0]).all(1).any()


def test_many_buckets(spark, edge, edge_list):
    rows = edge.select(F.col("doc_id").alias("id"), exact_dedup.digest(F.col("text")).alias("digest"))
    out = exact_dedup.resolve(rows.where("id < 40"), rows.where("id >= 40 or id is null"), bucket=8).collect()
    sizes = Counter(hashlib.sha256((t or "").encode()).digest() for _, t, *_ in edge_list)
    assert {bytes(r.digest): r.group_size for r in out} == dict(sizes)
    history = {hashlib.sha256((t or "").encode()).digest() for d, t, *_ in edge_list if d is not None and d < 40}
    assert {bytes(r.digest) for r in out if r.member} == history
