import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tidemark.operators import knowledge as kb


def chunks(spark, *texts, tokens=5, step=4):
    docs = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "path string, text string")
    return kb.chunk_documents(docs, "path", "text", F.lit("v1"), tokens, step)


def cut(words, tokens=5, step=4):
    """Windows as a loop: stop once a window reaches the end."""
    out, start = [], 0
    while True:
        out.append(words[start : start + tokens])
        if start + tokens >= len(words):
            return out
        start += step


@pytest.mark.parametrize("n", [1, 4, 5, 6, 9, 10, 13, 100])
def test_windows_cover_the_whole_text(spark, n):
    words = [f"w{i}" for i in range(n)]
    got = sorted((r.chunk_no, r.content) for r in chunks(spark, "\n ".join(words)).collect())
    assert got == [(i, " ".join(w)) for i, w in enumerate(cut(words))]


def test_sections_keep_their_heading(spark, rows):
    text = "intro words\n# One\nbody one\n## Two deep\nx\n#not a heading\n# \ny"
    got = rows(chunks(spark, text, tokens=50, step=40), "section_no", "section", "content")
    assert got == [
        (0, None, "intro words"),
        (1, "One", "# One body one"),
        (2, "Two deep", "## Two deep x #not a heading"),
        (3, None, "# y"),
    ]


def test_blank_texts_give_no_chunk(spark):
    assert chunks(spark, "", " \n\t", None).count() == 0


def test_chunk_id_is_path_version_content(spark):
    r = chunks(spark, "a  b\nc").first()
    assert r.chunk_id == hashlib.sha256(b"d0|v1|a b c").hexdigest()


def test_upsert_and_deprecate(spark, rows):
    old = chunks(spark, "a b c", "same text")
    new = chunks(spark, "a b changed")
    index = kb.upsert_chunks(old.limit(0), old)
    assert kb.upsert_chunks(index, old).count() == 2
    both = kb.upsert_chunks(index, new)
    assert rows(both, "content") == [("a b c",), ("a b changed",), ("same text",)]
    assert rows(kb.deprecate_chunks(both, new), "content", "deprecated") == [("a b c", True), ("a b changed", False), ("same text", False)]
    twice = kb.deprecate_chunks(kb.deprecate_chunks(both, new), new)
    assert rows(twice, "content", "deprecated")[0] == ("a b c", True)


def vectors(spark):
    table = [(1, [1.0, 0.0], 0), (2, [1.0, 1.0], 0), (3, [0.0, 1.0], 1), (4, [-1.0, 0.0], 1), (5, [2.0, 0.0], 1), (6, [0.0, 0.0], 0), (7, [3.0, 3.0], 0)]
    return spark.createDataFrame(table, "vec_id bigint, embedding array<float>, label int")


def test_topk(spark):
    got = [(r.vec_id, r.score) for r in kb.vector_topk(vectors(spark), [1.0, 0.0], 4).collect()]
    assert got == [(1, 1.0), (5, 1.0), (2, round(math.sqrt(0.5), 6)), (7, round(math.sqrt(0.5), 6))]
    got = [r.vec_id for r in kb.vector_topk(vectors(spark), [1.0, 0.0], 2, F.col("label") == 1).collect()]
    assert got == [5, 3]


def test_zero_vectors_score_null_and_sort_last(spark):
    got = [(r.vec_id, r.score) for r in kb.vector_topk(vectors(spark), [1.0, 0.0], 7).collect()]
    assert got[-1] == (6, None) and len(got) == 7


def test_topk_by_payload(spark, rows):
    v = vectors(spark)
    got = kb.topk_by_payload(v, kb.first_of_payload(v, "label"), "label", 2)
    assert rows(got, "label", "query_id", "rank", "vec_id") == [(0, 1, 1, 2), (0, 1, 2, 7), (1, 3, 1, 4), (1, 3, 2, 5)]


def test_retrieval_hits(spark, rows):
    kinds = "query_id bigint, expected int, query array<float>, query_norm double"
    questions = spark.createDataFrame([(1, 0, [1.0, 0.0], 1.0), (4, 0, [-1.0, 0.0], 1.0)], kinds)
    got = rows(kb.retrieval_hits(vectors(spark), questions, "label", 2), "query_id", "expected", "hit", "first_rank")
    assert got == [(1, 0, 1, 2), (4, 0, 1, 2)]
    assert kb.retrieval_hits(vectors(spark), questions.limit(0), "label").count() == 0


def test_many_questions_come_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(kb, "QUESTIONS", 3)
    kinds = "query_id bigint, expected int, query array<float>, query_norm double"
    asked = spark.createDataFrame([(100 + i, 0, [1.0, float(i)], math.sqrt(1 + i * i)) for i in range(10)], kinds)
    got = kb.retrieval_hits(vectors(spark), asked, "label", 2).collect()
    assert sorted(r.query_id for r in got) == list(range(100, 110))
