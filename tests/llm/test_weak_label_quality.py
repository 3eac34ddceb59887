import math
import random

import numpy as np
import pytest

from tidemark.llm import quality


def test_estimate_finds_classes_and_rates():
    rnd = np.random.default_rng(0)
    truth = rnd.random(20000) < 0.8
    right = np.array([[0.85, 0.7, 0.9, 0.6, 0.8], [0.98, 0.95, 0.99, 0.9, 0.97]])
    good = rnd.random((len(truth), 5)) < np.where(truth[:, None], right[1], 1 - right[0])
    votes = np.where(rnd.random(good.shape) < 0.2, quality.ABSTAIN, np.where(good, quality.GOOD, quality.BAD))
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior, share, rates = quality.estimate(patterns, counts.astype(float))
    assert abs(share - 0.8) < 0.02
    assert np.abs(rates[1] - right[1]).max() < 0.03 and np.abs(rates[0] - (1 - right[0])).max() < 0.06
    assert ((posterior[inverse.ravel()] > 0.5) == truth).mean() > 0.97


def test_estimate_equals_plain_rounds_over_rows():
    rnd = random.Random(6)
    rows = [[rnd.choice([quality.GOOD, quality.GOOD, quality.BAD, quality.ABSTAIN]) for _ in range(4)] for _ in range(400)]
    clip = lambda x, low: min(max(x, low), 1 - low)
    logistic = lambda x: 1 / (1 + math.exp(-x))
    usual = []
    for j in range(4):
        cast = [r[j] for r in rows if r[j] != quality.ABSTAIN]
        usual.append(clip(cast.count(quality.GOOD) / len(cast), 1e-4))
    post = [logistic(sum((-math.log(u) if v == quality.GOOD else math.log(1 - u)) for v, u in zip(r, usual) if v != quality.ABSTAIN)) for r in rows]
    for _ in range(500):
        share = clip(sum(post) / len(rows), 1e-3)
        rate = [[0.0] * 4, [0.0] * 4]
        for k in (0, 1):
            for j in range(4):
                own = [(p if k else 1 - p) / len(rows) for p in post]
                good = sum(w for w, r in zip(own, rows) if r[j] == quality.GOOD)
                cast = sum(w for w, r in zip(own, rows) if r[j] != quality.ABSTAIN)
                rate[k][j] = (good + 1e-4) / (cast + 2e-4)
        new = []
        for r in rows:
            odds = math.log(share / (1 - share))
            for j, v in enumerate(r):
                if v != quality.ABSTAIN:
                    odds += math.log(rate[1][j] / rate[0][j]) if v == quality.GOOD else math.log((1 - rate[1][j]) / (1 - rate[0][j]))
            new.append(logistic(odds))
        moved, post = max(abs(a - b) for a, b in zip(post, new)), new
        if moved < 1e-9:
            break
    patterns, inverse, counts = np.unique(np.array(rows), axis=0, return_inverse=True, return_counts=True)
    got, got_share, got_rates = quality.estimate(patterns, counts.astype(float))
    assert np.allclose(got[inverse.ravel()], post, atol=1e-6) and np.isclose(got_share, share, atol=1e-6)
    assert np.allclose(got_rates, rate, atol=1e-6)


def test_repeated_rows_do_not_swell_the_sample(spark, corpus):
    rows = corpus.select("doc_id", "text")
    known = quality.weak_labels(rows)
    many = rows.unionByName(spark.range(400).crossJoin(rows.where("doc_id = 7")).drop("id"))
    read = many.where("doc_id = 7").dropDuplicates(["doc_id", "text"]).count()
    assert read == 1
    once, again = quality.fit(rows, known, sample=10_000), quality.fit(many, known, sample=10_000)
    assert np.allclose(once[0], again[0]) and np.isclose(once[1], again[1])


def test_votes_see_each_defect():
    kinds, at = quality._kinds(), {n: i for i, n in enumerate(quality.LABELLERS)}
    prose = " ".join(f"Word{chr(97 + i)} walks the {chr(97 + i)}ong road, it seems." for i in range(20)).replace("W", "w")
    texts = [prose, prose.upper(), prose.replace(" ", "%%% "), prose.replace(" ", " | "), prose.replace(" ", "!! "), "spam " * 50, "", "a\na\na\na\na", "!!!"]
    cast = quality.votes(texts, kinds)
    vote = lambda i, name: cast[i, at[name]]
    assert (cast[0] != quality.BAD).all()
    assert vote(1, "upper") == vote(1, "lower") == quality.BAD
    assert vote(2, "symbols") == vote(2, "clean") == vote(2, "marks") == quality.BAD
    assert vote(3, "bars") == vote(3, "marks") == quality.BAD
    assert vote(4, "shouts") == vote(4, "clean") == quality.BAD
    assert vote(5, "adjacent") == vote(5, "variety") == quality.BAD
    assert vote(7, "repeated") == quality.BAD
    assert quality.votes([], kinds).shape == (0, len(quality.LABELLERS))


def test_votes_do_not_depend_on_neighbours():
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("ab C!|.%\n") for _ in range(rnd.randint(0, 80))) for _ in range(100)]
    kinds = quality._kinds()
    alone = np.concatenate([quality.votes([t], kinds) for t in texts])
    assert (quality.votes(texts, kinds) == alone).all()


@pytest.fixture(scope="module")
def corpus(spark):
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7))) for _ in range(500)]
    rows = []
    for i in range(400):
        text = " ".join(rnd.choice(words) + (". " if rnd.random() < 0.1 else "") for _ in range(rnd.randint(40, 120)))
        bad = i % 8
        text = [text.upper().replace(" ", "!! "), text.replace(" ", "%%% ")][bad] if bad < 2 else text
        rows.append((i, text, bad >= 2, "x", 0.5))
    rows += [(900, None, False, "x", 0.5), (901, "", False, "x", 0.5), (902, "q" * 40_000, False, "x", 0.5), (None, rows[5][1], True, "x", 0.5), rows[3], rows[3]]
    return spark.createDataFrame(rows, "doc_id long, text string, good boolean, pattern string, score double").repartition(3)


def test_scores_follow_the_truth_that_no_labeller_was_told(corpus):
    got = {r.doc_id: r for r in quality.classify(corpus).collect()}
    for r in corpus.where("doc_id < 400 or doc_id is null").collect():
        assert got[r.doc_id].predicted == int(r.good)
        assert 0 <= got[r.doc_id].score <= 1
    assert quality.classify(corpus).count() == corpus.count()
    assert got[900].score == got[901].score


def test_empty_table(corpus):
    assert quality.classify(corpus.limit(0)).count() == 0
