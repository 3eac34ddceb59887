import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, key long, id long, k long, size string, p string, f0 string, digest string, leaf string, bucket string"


def edge_rows(seed=0, n=120):
    """Nulls, empty and long texts, ties, repeated rows, near copies and a hot source."""
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdeéßñ") for _ in range(rnd.randint(2, 7))) for _ in range(200)]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.choice([3, 8, 30, 60, 90]))) for _ in range(n // 2)]
    rows = [(i, t, rnd.choice(["en", "fr", None]), rnd.choice(["s0"] * 4 + ["s1", "s2", "s3", None])) for i, t in enumerate(texts)]
    for i in range(n // 2, n):
        words_of = rnd.choice(texts).split()
        for _ in range(rnd.choice([0, 0, 1, 3])):
            words_of[rnd.randrange(len(words_of))] = rnd.choice(words)
        rows.append((i, " ".join(words_of), "en", "s0"))
    rows += [(900, None, None, None), (901, "", "en", "s1"), (902, " \t\n", "en", "s1"), (903, "One\x0bTWO", "en", "s9")]
    rows += [(904, " ".join(rnd.choice(words) for _ in range(6000)), "de", "s2")]
    rows += [(905, "123 456 !!", None, "s3"), rows[5], rows[5], (None, "no id here at all", "en", "s0"), (None, texts[0], None, "s1")]
    return rows


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with further columns whose names the operators use inside."""

    def make(rows):
        full = [(d, t, lang, s, len(t or ""), 1, 2, 3, "x", "y", "z", "d", "l", "b") for d, t, lang, s in rows]
        return spark.createDataFrame(full, COLUMNS).repartition(5)

    return make


@pytest.fixture(scope="session")
def edge(make_docs):
    return make_docs(edge_rows()).cache()


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])


@pytest.fixture(scope="session")
def edge_list():
    return edge_rows()
