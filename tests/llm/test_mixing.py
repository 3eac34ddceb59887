import math
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, strategies as st

from tidemark.llm import mixing

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def size_of(text):
    return len(WORD.findall((text or "").encode()))


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, stopped, target = sum(sizes.values()), set(), {}
    while True:
        rest = total - sum(3 * sizes[s] for s in stopped)
        open_ = [s for s in names if s not in stopped]
        target = {s: 3.0 * sizes[s] if s in stopped else rest * weight[s] / sum(weight[o] for o in open_) for s in names}
        above = {s for s in open_ if target[s] > 3 * sizes[s]}
        if not above:
            return target
        stopped |= above


@pytest.fixture(scope="module")
def mixed(edge):
    return mixing.mix(edge, leaf=4).collect()


def test_targets_and_sizes(mixed, edge_list):
    sizes = defaultdict(int)
    for _, t, _, s in edge_list:
        sizes[s] += size_of(t)
    want = brute_targets(sizes)
    assert Counter((r.doc_id, r.size) for r in mixed) == Counter((d, size_of(t)) for d, t, *_ in edge_list)
    for r in mixed:
        assert r.source_size == sizes[r.source]
        assert math.isclose(r.target, want[r.source], rel_tol=1e-9)
    assert math.isclose(sum(want.values()), sum(sizes.values()))


def test_taken_words_come_near_the_targets(mixed):
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    for r in mixed:
        assert r.taken == r.copies * r.size and 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
    for s in target:
        assert abs(taken[s] - target[s]) <= largest[s] + 1e-6


def test_reruns_agree_whatever_the_partitions(edge, mixed):
    again = mixing.mix(edge.repartition(3), leaf=4).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, mixed))


def test_expected_copies_over_many_seeds(spark):
    rows = [(i, " ".join("w" * (1 + i % 7)), "en", "ab"[i % 5 == 0]) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    total, share = Counter(), {}
    for seed in range(12):
        for r in mixing.mix(docs, leaf=8, seed=seed).collect():
            total[r.doc_id] += r.copies
            share[r.doc_id] = r.target / r.source_size
    mean = sum(total.values()) / sum(share.values()) / 12
    assert abs(mean - 1) < 0.05


def test_copies_take_effect(edge, mixed):
    out = mixing.mixed(edge, leaf=4)
    assert out.columns == edge.columns
    want = Counter()
    for r in mixed:
        want[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in out.collect()) == +want


def test_empty_table(no_docs):
    assert mixing.mix(no_docs).count() == 0
    assert mixing.mixed(no_docs).count() == 0


@given(st.floats(0.01, 0.99), st.integers(1, 10**6), st.floats(0.01, 0.99), st.integers(1, 10**6), st.floats(0, 0.999))
def test_mass_moves_until_one_is_whole(p, s, q, t, u):
    a, b = mixing.move_mass(p, s, q, t, u)
    assert math.isclose(a * s + b * t, p * s + q * t, rel_tol=1e-6, abs_tol=1e-6)
    assert -1e-9 <= a <= 1 + 1e-9 and -1e-9 <= b <= 1 + 1e-9
    assert a in (0.0, 1.0) or b in (0.0, 1.0)
