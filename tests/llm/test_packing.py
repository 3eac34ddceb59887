import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, strategies as st

from tidemark.llm import packing

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PERMITTED = (16, 64, 256)


@pytest.fixture(scope="module")
def planned(edge):
    return packing.plan(edge, permitted=PERMITTED, shard=32).cache()


def test_pieces_cover_every_document_once(planned, edge_list):
    pieces = defaultdict(list)
    for r in planned.collect():
        pieces[r.doc_id, r.key].append((r.start, r.length))
    want = Counter((d, len(WORD.findall(t or "")) + 1) for d, t, *_ in edge_list)
    have = Counter()
    for (d, _), found in pieces.items():
        copies = Counter(found)[0, dict(found)[0]]
        found, end = sorted(set(found)), 0
        for start, length in found:
            assert start == end
            end += length
        have[d, end] += copies
    assert have == want


def test_sequences_hold_their_pieces_and_are_downsized(planned):
    bins = defaultdict(list)
    for r in planned.collect():
        bins[r.bin_id, r.capacity].append((r.position, r.length))
    assert len(bins) == len({b for b, _ in bins})
    for (_, capacity), held in bins.items():
        end = 0
        for position, length in sorted(held):
            assert position == end
            end += length
        assert end <= capacity == min(c for c in PERMITTED if c >= end)


def test_texts_round_trip(edge, edge_list, planned):
    whole = defaultdict(dict)
    for r in packing.sequences(edge, planned, permitted=PERMITTED).collect():
        words, at = WORD.findall(r.text), 0
        assert r.used == len(words) == sum(r.lengths)
        for d, start, length in zip(r.doc_ids, r.starts, r.lengths):
            whole[d][start, length] = words[at : at + length]
            at += length
    for d, t, *_ in edge_list:
        if d is not None and d != 5:
            assert [w for _, ws in sorted(whole[d].items()) for w in ws] == WORD.findall(t or "") + ["<|end|>"]


def test_pieces_joined_are_the_text_byte_for_byte(spark):
    texts = ["  lead\n\tand\r\n  tail \n", "one", "", " \t ", None, "a b  c\n" * 60, "é ß\x0b𝄞  x", "w " * 16, " " + "w\n" * 32]
    docs = spark.createDataFrame([(i, t, 1, {"k": 2}) for i, t in enumerate(texts)], "doc_id long, text string, key int, piece map<string,int>")
    planned = packing.plan(docs, permitted=PERMITTED, shard=4)
    pieces = defaultdict(dict)
    for r in packing.sequences(docs, planned, permitted=PERMITTED).collect():
        for d, start, length, span in zip(r.doc_ids, r.starts, r.lengths, r.spans):
            pieces[d][start, length] = r.text[span.start : span.end]
    assert {d: "".join(t for _, t in sorted(p.items())) for d, p in pieces.items()} == {i: t or "" for i, t in enumerate(texts)}


def test_empty_table(no_docs):
    empty = packing.plan(no_docs)
    assert empty.count() == 0
    assert packing.sequences(no_docs, empty).count() == 0


def test_reruns_agree(edge, planned):
    assert Counter(map(tuple, packing.plan(edge.repartition(2), permitted=PERMITTED, shard=32).collect())) == Counter(map(tuple, planned.collect()))


@given(st.lists(st.integers(1, 256), max_size=60))
def test_plan_is_valid_and_no_worse_than_one_length(lengths):
    lengths.sort(reverse=True)
    bins, caps = packing.pack(lengths, PERMITTED)
    used = Counter()
    for size, b in zip(lengths, bins):
        used[b] += size
    assert all(used[b] <= c for b, c in enumerate(caps)) and len(used) == len(caps)
    one, _ = packing._best_fit(lengths, (256,), packing.cost)
    assert sum(map(packing.cost, caps)) <= len(set(one)) * packing.cost(256)
