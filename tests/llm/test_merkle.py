"""The manifest against a plain tree over lists."""

import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle
from tidemark.llm.common import crc_mod

LOWER = {i: i + 32 for i in range(65, 91)}
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, grp int, pos int, digest map<string,int>, leaf string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row):
    return h(*[enc(v) for v in row])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def path(tree, at):
    steps = []
    for nodes in tree[:-1]:
        start = at - at % 8
        steps.append((nodes[start:at], nodes[at + 1 : start + 8]))
        at //= 8
    return steps


def plain(rows, tampered):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    langs = sorted(by, key=lambda v: (v is not None, (v or "").encode()))
    trees = {lang: levels([x[2] for x in sorted(by[lang], key=lambda x: x[:3])]) for lang in langs}
    top = levels([trees[lang][-1][0] for lang in langs])
    out = []
    for number, lang in enumerate(langs):
        for at, (*_, own, r) in enumerate(sorted(by[lang], key=lambda x: x[:3])):
            steps = path(trees[lang], at) + path(top, number)
            given = leaf((*r[:4], r[4] if r[4] is None else r[4].translate(LOWER))) if tampered(r) else own
            folded = given
            for left, right in steps:
                folded = h(*left, folded, *right)
            proof = h(*[d for left, right in steps for d in left + right])
            out.append((r[0], own, trees[lang][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(out, key=str)


def rows_of(n, seed=0):
    rnd = random.Random(seed)
    langs = ["en"] * 6 + ["de", "fr", "é", None, "", "zz"] + [f"l{i}" for i in range(20)]
    rows = [(i, rnd.choice(["a", None, "ß"]), rnd.choice(langs), rnd.choice([None, 3, -5]), rnd.choice([None, "", "Text ÀB", "lower", "UP " * 50])) for i in range(n)]
    rows += [(None, "a", "en", 1, "X"), (None, "b", "en", 1, "Y"), (3, "a", "en", 9, "tie A"), (3, "a", "en", 9, "tie B")] + [rows[0]] * 3
    rows += [(5000, "s", "alone", 1, "Ab" * 200_000)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, {"k": 1}, "z") for r in rows], SCHEMA).repartition(4)


def told(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def third(r):
    from zlib import crc32

    return r[0] is not None and crc32(str(r[0]).encode()) % 3 == 0


@pytest.mark.parametrize("n, round_", [(700, 4), (700, 1), (60, 2)])
def test_equals_a_plain_tree(spark, n, round_, monkeypatch):
    # Smaller blocks make the same tree in more rounds.
    monkeypatch.setattr(merkle, "ROUND", round_)
    monkeypatch.setattr(merkle, "BLOCK", 8**round_)
    rows = rows_of(n)
    built = merkle.manifest(frame(spark, rows), crc_mod(F.col("doc_id"), 3) == 0)
    assert told(built.verify()) == plain(rows, third)


def test_a_version_has_only_its_own_path(spark):
    rows = [(i, "a", "en", 1, f"Doc {i}") for i in range(700)] + [(1000, "a", "fr", 1, "Un")]
    built = merkle.manifest(frame(spark, rows), F.col("doc_id") == 123)
    nodes = built.versions().orderBy("level").collect()
    tree = levels([leaf(r) for r in rows[:700]])
    changed = list(rows[123])
    changed[4] = changed[4].translate(LOWER)
    new = levels([leaf(r) for r in rows[:123]] + [leaf(changed)] + [leaf(r) for r in rows[124:700]])
    assert [n.digest for n in nodes[:4]] == [new[k][123 // 8**k] for k in range(1, 5)]
    assert nodes[4].digest == h(new[-1][0], leaf(rows[700]))
    assert len(nodes) == 5 and {n.doc_id for n in nodes} == {123}
    assert sum(a != b for one, two in zip(tree, new) for a, b in zip(one, two)) == 5  # all else is shared


def test_lone_leaves_and_an_empty_table(spark):
    one = [(7, "a", None, 1, "Only")]
    assert told(merkle.manifest(frame(spark, one), F.lit(True)).verify()) == plain(one, lambda r: True)
    none = merkle.manifest(frame(spark, []))
    assert none.root is None and none.verify().count() == 0 and none.versions().count() == 0
