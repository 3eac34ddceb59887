"""Phrase and proximity matches against a scan of all windows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontamination as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain(docs, items, width):
    wanted = {}
    for item, text in items:
        w = words(text)
        m = min(len(w), width)
        for s in range(len(w) - m + 1 if w else 0):
            wanted.setdefault(tuple(w[s : s + m]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, named = words(text), set(), set()
        for m in {len(x) for x in wanted}:
            for s in range(len(w) - m + 1):
                found = wanted.get(tuple(w[s : s + m]))
                if found:
                    hit |= set(range(s, s + m))
                    named |= found
        out.append((doc, len(w), len(hit), sorted(str(i) for i in named if i is not None)))
    return sorted(out, key=str)


def cases(seed=0):
    rnd = random.Random(seed)
    vocab = ["the", "a", "of", "é", "Ünï", "x9"] + [f"w{i}" for i in range(15)]
    text = lambda n: rnd.choice([" ", ", ", "-", "\n"]).join(rnd.choice(vocab) for _ in range(n))
    items = [(i, text(rnd.randint(1, 25))) for i in range(12)]
    items += [(100, None), (101, ""), (102, "... !!"), (103, "THE"), (104, items[0][1]), (104, items[0][1]), (None, items[1][1].upper()), (105, "a " * 30), (106, "E e E")]
    docs = [(i, text(rnd.randint(0, 80))) for i in range(40)]
    docs += [(200 + i, f"{text(9)} {t} {text(9)}".swapcase()) for i, (_, t) in enumerate(items) if t]
    docs += [(300, None), (301, ""), (302, " \t"), (303, "a " * 500), (None, items[2][1]), (304, items[3][1]), (304, items[3][1]), (305, "e e e E E E"), (306, "É Éa THEİ")]
    return docs, items


def tables(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, {"m": 1}, 2) for i, t in docs], "doc_id long, text string, doc int, pos map<string,int>, term int")
    b = spark.createDataFrame([(i, t, 3, 4) for i, t in items], "item_id long, text string, pattern int, words int")
    return d.repartition(5), b.repartition(3)


def told(df):
    return sorted([(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in df.collect()], key=str)


@pytest.mark.parametrize("width, seed", [(10, 0), (3, 1), (1, 2)])
def test_equals_all_windows(spark, width, seed):
    docs, items = cases(seed)
    assert told(D.contamination(*tables(spark, docs, items), width)) == plain(docs, items, width)


def test_empty_tables_leave_every_document_clean(spark):
    docs, items = cases()
    got = told(D.contamination(*tables(spark, docs, []), 10))
    assert got == plain(docs, [], 10)
    assert told(D.contamination(*tables(spark, [], items), 10)) == []


def test_the_index_gives_every_token_of_the_known_terms(spark):
    docs, _ = cases(3)
    table, _ = tables(spark, docs, [])
    index = D.build_index(table)  # every word has a list
    assert index.where("term > 0").count() == sum(len(words(t)) for _, t in docs)
    held = D.documents_of(index).collect()
    assert sorted(((r.doc_id, r.n_words) for r in held), key=str) == sorted(((d, len(words(t))) for d, t in docs), key=str)
    for part in index.select("term").rdd.glom().collect():
        assert [r.term for r in part] == sorted(r.term for r in part)


@pytest.mark.parametrize("distance", [0, 2, 6])
def test_proximity(spark, distance):
    docs, items = cases(4)
    docs, items = docs[:45], [(i, t) for i, t in items if t and 1 <= len(words(t)) <= 4] + [(7, "w1 w2"), (8, "w3 w4 w5"), (9, "w6 nowhere")]
    table, asked = tables(spark, docs, items)
    patterns, _ = D.texts_of(asked)
    terms = D.vocabulary(patterns.select(F.explode("words").alias("word")))
    index = D.build_index(table, terms)
    texts = {r.pattern: r.words for r in patterns.collect()}
    at = {}
    for i, (_, t) in enumerate(docs):
        for p, w in enumerate(words(t)):
            at.setdefault(w, []).append(p)
    size = {r.term: r.postings for r in D.frequencies(index).collect()}
    number = {r.word: r.term for r in terms.collect()}
    want = set()
    for pattern, held in texts.items():
        rare = min(set(held), key=lambda w: (size.get(number[w], 0), number[w]))
        for doc, t in docs:
            w = words(t)
            for p, x in enumerate(w):
                near = set(w[max(0, p - distance) : p + distance + 1])
                if x == rare and set(held) <= near:
                    want.add((doc, pattern, p + 1))
    ids = D.documents_of(index).select("doc", "doc_id")
    got = D.near_matches(index, patterns, terms, distance).join(ids, "doc")
    rows = [(r.doc_id, r.pattern, r.pos) for r in got.collect()]
    assert len(rows) >= len(want) and set(rows) == want


def test_no_python_on_the_main_path(spark):
    docs, items = cases()
    plan = D.contamination(*tables(spark, docs, items))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
