import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language

PIECES = ["▁", "▁a", "▁ab", "a", "b", "ab", "ba", "c", "▁c"]


def brute(word, p):
    """Sum over all segmentations, by recursion."""
    word = language.START + word

    def rest(at):
        if at == len(word):
            return 1.0
        total = rest(at + 1) * language.UNSEEN
        for i, piece in enumerate(PIECES):
            if word.startswith(piece, at):
                total += p[i] * rest(at + len(piece))
        return total

    return rest(0)


def lattice(words):
    return language.Lattice(words, language.matcher(PIECES), np.array([len(p) for p in PIECES]))


def test_forward_sums_all_segmentations():
    rnd = random.Random(0)
    words = ["".join(rnd.choice("abcx") for _ in range(rnd.randint(1, 8))) for _ in range(200)]
    table = np.vstack([np.random.default_rng(0).dirichlet(np.ones(len(PIECES)), 3).T, np.full((1, 3), language.UNSEEN)])
    got = language.word_scores(words, language.matcher(PIECES), np.array([len(p) for p in PIECES]), table)
    want = np.log([[brute(w, table[:, k]) for k in range(3)] for w in words])
    assert np.allclose(got, want)


def test_backward_agrees_with_forward():
    words = ["abba", "cab", "x", "abab"]
    lat = lattice(words)
    p = np.concatenate([np.full(len(PIECES), 0.1), [language.UNSEEN]])[lat.piece]
    ahead, behind = lat.forward(p), lat.backward(p)
    uses = ahead[lat.before] * p * behind[lat.end] / ahead[lat.last][lat.word[lat.end]]
    lengths = np.array([len(x) for x in PIECES] + [1])
    spans = np.bincount(lat.word[lat.end], weights=uses * lengths[lat.piece])
    assert np.allclose(spans, [len(w) + 1 for w in words])  # each letter is used once in expectation


@pytest.fixture(scope="module")
def corpus(spark):
    rnd = random.Random(1)
    sounds = {"aa": ["ka", "ko", "na", "shi", "ru"], "bb": ["the", "ing", "er", "st", "on"], "cc": ["eau", "oi", "ment", "le", "qu"]}
    rows = []
    for i in range(300):
        lang = list(sounds)[i % 3]
        rows.append((i, " ".join("".join(rnd.choice(sounds[lang]) for _ in range(rnd.randint(1, 3))) for _ in range(rnd.randint(1, 60))), lang, "s"))
    rows += [(900, None, "aa", "s"), (901, "", "aa", "s"), (902, "123 !? ٣", None, "s"), (903, "x" * 50_000, "aa", "s"), (None, "kana shiru", None, "s"), rows[0], rows[0]]
    return spark.createDataFrame([(*r, 1, "n", 0.5) for r in rows], "doc_id long, text string, lang string, source string, n int, word string, share double").repartition(4)


def test_held_out_accuracy_and_undetermined_texts(corpus):
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = language.learn(corpus, ~held)
    told = language.identify(corpus.select("doc_id", "lang", "text"), model).collect()
    assert len(told) == corpus.count()
    rows = [r for r in told if r.doc_id is not None and r.doc_id < 300]
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in told)
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in told}
    assert all(by_id[i] == ("und", 0.0) for i in (900, 901, 902))
    assert by_id[903][0] in ("aa", "bb", "cc") and by_id[None][0] == "aa"


def brute_log(word, p):
    """Log of the sum over all segmentations, place by place."""
    word = language.START + word
    best = [-np.inf] * len(word) + [0.0]
    for at in range(len(word) - 1, -1, -1):
        ways = [best[at + 1] + np.log(language.UNSEEN)]
        ways += [np.log(p[i]) + best[at + len(piece)] for i, piece in enumerate(PIECES) if word.startswith(piece, at)]
        best[at] = np.logaddexp.reduce(ways)
    return best[0]


def test_long_runs_are_whole():
    rnd = random.Random(7)
    words = ["".join(rnd.choice("abcx") for _ in range(n)) for n in (3, 24, 25, 60, 500, 10_000, 1)]
    table = np.vstack([np.random.default_rng(1).dirichlet(np.ones(len(PIECES)), 3).T, np.full((1, 3), language.UNSEEN)])
    automaton, lengths = language.matcher(PIECES), np.array([len(p) for p in PIECES])
    got = language.word_scores(words, automaton, lengths, table)
    assert np.allclose(got, [[brute_log(w, table[:, k]) for k in range(3)] for w in words])
    one = np.vstack([language.word_scores([w], automaton, lengths, table) for w in words])
    assert np.allclose(got, one)
    lat = lattice(["abbacab" * 30])
    p = np.log(np.concatenate([np.full(len(PIECES), 0.1), [language.UNSEEN]])[lat.piece])
    ahead, behind = lat.forward_log(p), lat.backward_log(p)
    uses = np.exp(ahead[lat.before] + p + behind[lat.end] - ahead[lat.last][lat.word[lat.end]])
    assert np.isclose(uses @ np.array([len(x) for x in PIECES] + [1])[lat.piece], 7 * 30 + 1)


def test_every_language_is_learned(spark):
    rnd = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyz"
    own = {f"l{i}": ["".join(rnd.sample(letters, 3)) for _ in range(4)] for i in range(300)}
    rows = [(i * 10 + j, " ".join("".join(rnd.choice(own[lang]) for _ in range(2)) for _ in range(40)), lang) for i, lang in enumerate(own) for j in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = language.learn(docs, F.col("doc_id") % 10 != 2, rounds=2)
    assert len(model.names) == 300
    told = [r for r in language.identify(docs, model).collect() if r.doc_id % 10 == 2]
    assert sum(r.lang == r.lang_pred for r in told) / len(told) > 0.95


def test_texts_of_no_learned_language_do_not_fit(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.learn(docs, F.lit(True))
    rnd = random.Random(3)
    noise = [" ".join("".join(rnd.choice("bcdfghjklmnpqrstvwxz") for _ in range(rnd.randint(2, 9))) for _ in range(40)) for _ in range(20)]
    noise += ["Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему.", "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。"]
    asked = spark.createDataFrame([(i, t) for i, t in enumerate(noise)], "doc_id long, text string")
    assert all(r.fit < -6 for r in language.identify(asked, model).collect())
    clean = language.identify(docs.select("doc_id", "lang", "text"), model).where("lang_pred <> 'und'").collect()
    assert all(r.fit >= -6 for r in clean)


def test_repeated_rows_count_once_in_the_fit(corpus, spark):
    once = language.learn(corpus, F.lit(True), rounds=1)
    many = corpus.unionByName(spark.range(50).crossJoin(corpus.where("doc_id = 4")).drop("id"))
    again = language.learn(many, F.lit(True), rounds=1)
    assert np.allclose(once.table, again.table)


def test_nothing_to_learn_from(corpus):
    model = language.learn(corpus, F.lit(False))
    assert Counter(r.lang_pred for r in language.identify(corpus.select("doc_id", "text"), model).collect()) == {"und": corpus.count()}


def test_empty_table(corpus):
    none = corpus.limit(0)
    model = language.learn(none, F.lit(True))
    assert language.identify(none.select("doc_id", "text"), model).count() == 0


def test_words_are_scored_the_same_when_the_cache_starts_anew(corpus, monkeypatch):
    model = language.learn(corpus, F.lit(True), rounds=2)
    texts = corpus.select("doc_id", "text")
    key = lambda rows: sorted((str(r.doc_id), r.lang_pred, round(r.score, 9)) for r in rows)
    want = key(language.identify(texts, model).collect())
    monkeypatch.setattr(language, "HELD_WORDS", 10)
    assert key(language.identify(texts, model).collect()) == want


def test_short_words_need_no_list_of_matches(monkeypatch):
    table = np.vstack([np.random.default_rng(4).dirichlet(np.ones(len(PIECES)), 3).T, np.full((1, 3), language.UNSEEN)])
    words = ["abba", "c", "é", "𝒳ab", "cabbabac" * 3, "xa"]
    monkeypatch.setattr(language, "Lattice", None)  # made and sorted for every word, it took most of the time
    got = language.word_scores(words, language.matcher(PIECES), np.array([len(p) for p in PIECES]), table)
    assert np.allclose(got, [[brute_log(w, table[:, k]) for k in range(3)] for w in words])


def test_letters_used_seldom_are_followed_too(monkeypatch):
    monkeypatch.setattr(language, "USUAL", 2)
    trie, text = language.matcher(PIECES), language.START + "abcab" + language.START + "xcba"
    found = sorted(zip(*(x.tolist() for x in trie.matches(trie.codes(text)))))
    assert found == sorted((at, at + len(p) - 1, i) for at in range(len(text)) for i, p in enumerate(PIECES) if text.startswith(p, at))
