import random

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import ngrams, toxicity


def test_hashed_ngrams_are_those_of_each_text_alone():
    rnd = random.Random(0)
    texts = ["".join(rnd.choice("abé ß") for _ in range(rnd.randint(0, 30))) for _ in range(50)]
    points, ends = ngrams.code_points(texts)
    got = set(zip(*ngrams.present(points, ends, (2, 3), 16)))
    want = set()
    for i, t in enumerate(texts):
        for n in (2, 3):
            for k in range(len(t) - n + 1):
                p, _ = ngrams.code_points([t[k : k + n]])
                want.add((i, int(ngrams.hashed(p, n, 16)[0])))
    assert got == want


def test_chunks_lose_no_ngram(monkeypatch):
    points, ends = ngrams.code_points(["abcdefghij" * 20, "xyz" * 30])
    whole = list(zip(*ngrams.present(points, ends, (3,), 16)))
    monkeypatch.setattr(ngrams, "CHUNK", 7)
    assert list(zip(*ngrams.present(points, ends, (3,), 16))) == whole


def test_logistic_learns_a_separable_rule():
    rnd = np.random.default_rng(0)
    row, column = np.repeat(np.arange(500), 5), rnd.integers(0, 20, 2500)
    y = np.bincount(row, column == 3, 500) > 0
    w, b = ngrams.logistic(row, column, np.ones(2500), y.astype(float), 20, 1e-4)
    assert ((np.bincount(row, w[column], 500) + b > 0) == y).mean() > 0.99


@pytest.fixture(scope="module")
def texts(spark):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7))) for _ in range(400)]
    rows = []
    for i in range(600):
        said = [rnd.choice(words) for _ in range(rnd.randint(5, 80))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                said.insert(rnd.randrange(len(said)), "zorg" + rnd.choice(["", "ling", "mo", "ta"]))
        rows.append((i, " ".join(said), int(toxic), "s", 0.1))
    return spark.createDataFrame(rows, "doc_id long, text string, label int, score string, buckets double").repartition(4)


def test_held_out_accuracy(texts):
    model = toxicity.fit(texts, texts.where("doc_id % 3 <> 0").select("doc_id", "label"))
    rows = toxicity.score(texts.where("doc_id % 3 = 0").select("doc_id", "label", "text"), model).collect()
    assert sum((r.score >= 0.5) == (r.label == 1) for r in rows) / len(rows) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_texts_and_labels(spark, texts):
    odd = spark.createDataFrame([(901, None, 1), (902, "", 0), (903, "zorgmo " * 5000, None), (None, "abc", 7), (904, "a", 0), (904, "a", 0)], "doc_id long, text string, label int")
    every = texts.select("doc_id", "text", "label").unionByName(odd)
    model = toxicity.fit(every.drop("label"), every.drop("text"))
    got = {r.doc_id: r.score for r in toxicity.score(odd.select("doc_id", "text"), model).collect()}
    assert got[901] == got[902] < 0.5 < got[903] and len(got) == 5


def test_ratios_are_those_of_plain_counts(monkeypatch):
    rnd = random.Random(8)
    texts = ["".join(rnd.choice("abcd ") for _ in range(rnd.randint(5, 60))) for _ in range(300)]
    label = [int("abc" in t) for t in texts]
    grams = [{t[k : k + n] for n in toxicity.ORDERS for k in range(len(t) - n + 1)} for t in texts]
    n0, n1 = label.count(0), label.count(1)
    want = {}
    for g in set().union(*grams):
        toxic, other = (sum(g in gs for gs, y in zip(grams, label) if y == k) for k in (1, 0))
        ratio = np.log((toxic + 0.5) / (n1 + 1)) - np.log((other + 0.5) / (n0 + 1))
        rate = (toxic + other + 0.5) / (n0 + n1 + 1)
        z = abs(toxic / n1 - other / n0) / np.sqrt(rate * (1 - rate) * (1 / n0 + 1 / n1) + 1e-12)
        if toxic + other > 2 and z > toxicity.SURE:
            p, _ = ngrams.code_points([g])
            want[int(ngrams.hashed(p, len(g), toxicity.BITS)[0])] = (ratio, z)
    batch = pa.RecordBatch.from_pydict({"text": texts, "label": label})
    got = {}
    for part in toxicity._counts([batch]):
        told = toxicity._telling((n0, n1))(pa.Table.from_batches([part])).to_pydict()
        got.update(zip(told["bucket"], zip(told["ratio"], told["z"])))
    assert len(want) > 3 and set(got) == set(want)  # the few n-grams of five letters share no bucket
    assert all(np.allclose(got[b], want[b]) for b in want)


def test_repeated_rows_do_not_swell_the_sample(spark, texts):
    labels = texts.select("doc_id", "label")
    once = toxicity.fit(texts, labels)
    again = toxicity.fit(texts.unionByName(spark.range(40).crossJoin(texts.where("doc_id = 10")).drop("id")), labels)
    assert np.allclose(once[0], again[0]) and np.isclose(once[1], again[1])


def test_one_class_or_none(texts):
    rows = texts.select("doc_id", "text", "label")
    assert toxicity.fit(rows, rows.limit(0))[1] == 0.0
    assert toxicity.fit(rows.limit(0), rows)[1] < 0
    weights, bias = toxicity.fit(rows, rows.where("label = 0"))
    assert not weights.any() and bias < 0
    assert toxicity.score(rows.limit(0), (weights, bias)).count() == 0
