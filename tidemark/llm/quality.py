"""Quality classifier from weak labels.

Heuristic labellers look at a text's shape and vote good, bad or abstain. Their votes over all
documents are counted by pattern; expectation-maximisation on these counts estimates each labeller's
accuracy and abstentions in both classes and gives each pattern a posterior, without any gold label.
A linear scorer over hashed character n-grams and over the votes, one by one, is trained to the
posteriors and scores every text.

There are at most 3 ** labellers patterns, so their table is small whatever the number of documents.
"""

from __future__ import annotations

from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import slices, uniform
from tidemark.llm.ngrams import code_points, logistic, occurrences, sigmoid

ORDERS = (1, 2, 3)
BITS = 14
SAMPLE = 3000  # documents that the scorer is trained on, about
SCALE = 30.0
PENALTY = 1e-5
GOOD, BAD, ABSTAIN = 1, -1, 0
WIDTH = (1 << BITS) + 3 * 12  # a bucket for each hash, and one for each labeller and vote


#: Several look at each defect, so that their agreement tells what they are worth.
LABELLERS = ("symbols", "upper", "shouts", "bars", "clean", "lower", "marks", "length", "ends", "repeated", "variety", "adjacent")
LETTER, UPPER, DIGIT, SPACE, PLAIN = 1, 2, 4, 8, 16


def _kinds() -> np.ndarray:
    """Kinds of the characters below 0x3000 as bits; all above count as letters."""
    table = np.zeros(0x3001, np.uint8)
    for c in range(0x3000):
        x = chr(c)
        table[c] = LETTER * x.isalpha() | UPPER * x.isupper() | DIGIT * x.isnumeric() | SPACE * x.isspace() | PLAIN * (x in ".,;:!?'\"()-|")
    table[0x3000] = LETTER
    return table


def votes(texts: list[str], kinds: np.ndarray) -> np.ndarray:
    """Votes (texts, labellers): good, bad, or abstain where a text lacks what a labeller measures."""
    points, ends = code_points(texts, lower=False)
    sizes = np.diff(ends, prepend=0)
    of = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    kind = kinds[np.minimum(points, 0x3000)]
    total = lambda mask: np.bincount(of[mask], minlength=len(texts)).astype(float)
    space = kind & SPACE > 0
    opens = np.concatenate([[False], space[:-1]])  # after a space, or at a text's start
    closes = np.concatenate([space[1:], [False]])
    opens[(ends - sizes)[sizes > 0]] = True
    closes[(ends - 1)[sizes > 0]] = True
    again = np.concatenate([[False], points[1:] == points[:-1]]) & ~opens
    starts = opens & ~space
    words = total(starts)
    odd = ~space & (kind & (LETTER | DIGIT) == 0) & ~((kind & PLAIN > 0) & closes & ~opens)  # but one closing mark
    inside = kind & UPPER & ~opens * np.uint8(255) > 0
    word = np.cumsum(starts, dtype=np.int32) - 1
    n_words = int(starts.sum())
    dirty = np.bincount(word[odd], minlength=n_words) > 0
    cased = dirty | (np.bincount(word[inside], minlength=n_words) > 0)
    word_of = of[starts]
    per_text = lambda flags: np.bincount(word_of[flags], minlength=len(texts)).astype(float)
    letters = total(kind & LETTER > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        symbols = total(kind == 0) / sizes
        upper = total(kind & UPPER > 0) / letters
        shouts = total(((points == ord("!")) | (points == ord("?"))) & again) / words
        bars = total(opens & closes & np.isin(points, [ord(c) for c in "|*>•"])) / words
        length = letters / words
        clean, lower = 1 - per_text(dirty) / words, 1 - per_text(cased) / words
        marks = total(~space & (kind & (LETTER | DIGIT) == 0)) / words
        stops = total(closes & ~space & np.isin(points, [ord(c) for c in ".?!"])) / words
    lines = [[x for x in t.split("\n") if x.strip()] for t in texts]
    n_lines = np.array([len(x) for x in lines])
    repeated = 1 - np.array([len(set(x)) for x in lines]) / np.maximum(n_lines, 1)
    tokens = [t.lower().split() for t in texts]
    variety = np.array([len(set(x)) for x in tokens]) / np.sqrt(np.maximum(words, 1))
    adjacent = np.array([sum(map(eq, x, x[1:])) for x in tokens]) / np.maximum(words, 1)
    many = words >= 20
    good_bad = [
        (symbols < 0.01, symbols > 0.05),
        (upper < 0.12, upper > 0.5),
        (many & (shouts == 0), shouts > 0.1),
        (many & (bars == 0), bars > 0.2),
        (clean > 0.97, clean < 0.8),
        (lower > 0.95, lower < 0.8),
        (marks < 0.3, marks > 0.4),
        ((length >= 3) & (length <= 9), (length < 1.5) | (length > 15)),
        (many & (stops >= 0.02) & (stops <= 0.5), many & (stops < 0.005)),
        ((n_lines >= 3) & (repeated == 0), repeated > 0.3),
        (many & (variety > 4), many & (variety < 3)),
        (many & (adjacent < 0.02), many & (adjacent > 0.15)),
    ]
    return np.stack([np.where(bad, BAD, np.where(good, GOOD, ABSTAIN)) for good, bad in good_bad], axis=1)


def pattern_names(cast: np.ndarray) -> list[str]:
    """Votes as text: +, - and 0, a character for each labeller."""
    return ["".join("-0+"[v + 1] for v in row) for row in cast.tolist()]


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 500) -> tuple[np.ndarray, float, np.ndarray]:
    """(posterior of good for each pattern, share of good, share of good votes[class, labeller]).

    Labellers are taken as independent given the class, and abstentions as telling nothing. The start
    is a balance of votes in which a vote weighs what it surprises: minus the log of how often its
    labeller casts it.
    """
    cast, weight = patterns != ABSTAIN, counts / max(counts.sum(), 1)
    good = patterns == GOOD
    usual = (weight[:, None] * good).sum(0) / np.maximum((weight[:, None] * cast).sum(0), 1e-12)
    usual = np.clip(usual, 1e-4, 1 - 1e-4)
    posterior = sigmoid(np.where(cast, np.where(good, -np.log(usual), np.log(1 - usual)), 0).sum(1))
    rates, share = np.empty((2, patterns.shape[1])), 0.5
    for _ in range(rounds):
        share = float(np.clip((weight * posterior).sum(), 1e-3, 1 - 1e-3))
        for k, own in enumerate((1 - posterior, posterior)):
            mass = (weight * own)[:, None]
            rates[k] = ((mass * good).sum(0) + 1e-4) / ((mass * cast).sum(0) + 2e-4)
        odds = np.where(good, np.log(rates[1] / rates[0]), np.log((1 - rates[1]) / (1 - rates[0])))
        before, posterior = posterior, sigmoid(np.where(cast, odds, 0).sum(1) + np.log(share / (1 - share)))
        if np.abs(before - posterior).max(initial=0) < 1e-9:
            break
    return posterior, share, rates


def vote_buckets(cast: np.ndarray) -> np.ndarray:
    return (1 << BITS) + 3 * np.arange(cast.shape[1]) + cast + 1


def _count_patterns(batches):
    kinds, counts = _kinds(), Counter()
    for whole in batches:
        for batch in slices(whole, 128):
            counts.update(pattern_names(votes([t or "" for t in batch.column("text").to_pylist()], kinds)))
    yield pa.RecordBatch.from_pydict({"pattern": pa.array(counts, pa.string()), "n": pa.array(counts.values(), pa.int64())})


def weak_labels(documents: DataFrame) -> dict[str, float]:
    """Posterior of good quality for each pattern of votes that the texts of `documents` get; counts cover every row."""
    counts = documents.select("text").mapInArrow(_count_patterns, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n"))
    counts = counts.toPandas().sort_values("pattern")
    table = np.array([["-0+".index(v) - 1 for v in p] for p in counts["pattern"]], np.int64).reshape(len(counts), len(LABELLERS))
    posterior, _, _ = estimate(table, counts["n"].to_numpy(np.float64))
    return dict(zip(counts["pattern"], posterior.tolist()))


def _train_rows(known: dict[str, float]):
    """N-gram rates of each text, with the posterior of its votes."""

    def run(batches):
        kinds = _kinds()
        for whole in batches:
            for batch in slices(whole, 128):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                cast = votes(texts, kinds)
                posterior = [known[p] for p in pattern_names(cast)]
                points, ends = code_points(texts)
                sizes = np.diff(ends, prepend=0)
                keys = [t.astype(np.int64) << BITS | b for t, b in occurrences(points, ends, ORDERS, BITS)]
                key, n = np.unique(np.concatenate([np.empty(0, np.int64), *keys]), return_counts=True)
                rate = (n / sizes[key >> BITS]).astype(np.float32)
                cuts = np.searchsorted(key >> BITS, np.arange(len(texts) + 1))
                bucket, own = (key & ((1 << BITS) - 1)).astype(np.int32), vote_buckets(cast).astype(np.int32)
                one = np.full(cast.shape[1], 1 / SCALE, np.float32)
                buckets = [bucket[a:b].tobytes() + v.tobytes() for a, b, v in zip(cuts, cuts[1:], own)]
                rates = [rate[a:b].tobytes() + one.tobytes() for a, b in zip(cuts, cuts[1:])]
                columns = [batch.column("doc_id"), pa.array(posterior), pa.array(buckets, pa.binary()), pa.array(rates, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "posterior", "buckets", "rates"])

    return run


def fit(documents: DataFrame, known: dict[str, float], sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """(weight of each bucket, bias) of a scorer trained to the posteriors of about `sample` documents.

    They are chosen by a hash of id and text, and rows that repeat both are one, so however often a row
    occurs, the sample keeps its bound; only its n-gram rates come to the driver. An empty table gives
    weights and bias 0.
    """
    n = documents.count()
    chosen = documents.where(uniform(F.lit(11), "doc_id", "text") < F.lit(min(1.0, sample / max(n, 1))))
    chosen = chosen.dropDuplicates(["doc_id", "text"])
    rows = chosen.mapInArrow(_train_rows(known), "doc_id long, posterior double, buckets binary, rates binary").toPandas()
    rows = rows.sort_values(["doc_id", "posterior", "buckets"])
    if rows.empty:
        return np.zeros(WIDTH), 0.0
    held = [np.frombuffer(b, np.int32) for b in rows["buckets"]]
    value = SCALE * np.concatenate([np.frombuffer(r, np.float32) for r in rows["rates"]]).astype(np.float64)
    row = np.repeat(np.arange(len(held)), [len(h) for h in held])
    return logistic(row, np.concatenate(held), value, rows["posterior"].to_numpy(), WIDTH, PENALTY, rounds=120)


def _score(shared, others):
    def run(batches):
        weights, bias, known = shared.value
        kinds = _kinds()
        for whole in batches:
            for batch in slices(whole, 64):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                cast = votes(texts, kinds)
                names = pattern_names(cast)
                points, ends = code_points(texts)
                total = np.zeros(batch.num_rows)
                for text, bucket in occurrences(points, ends, ORDERS, BITS):
                    total += np.bincount(text, weights[bucket], batch.num_rows)
                total = SCALE * total / np.maximum(np.diff(ends, prepend=0), 1)
                total += weights[vote_buckets(cast)].sum(1) + bias
                found = [pa.array(names, pa.string()), pa.array([known[x] for x in names], pa.float64()), pa.array(sigmoid(total))]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], *found], [*others, "pattern", "posterior", "score"])

    return run


def classify(documents: DataFrame, text: str = "text", doc_id: str = "doc_id", sample: int = SAMPLE) -> DataFrame:
    """doc_id, pattern, posterior, score, predicted (1 if score >= 0.5) for every row of `documents`.

    Null counts as empty and gets the score of the bias; a text's n-gram rates do not depend on its
    length. Rows without an id are scored like others; repeated rows count as often as they occur.
    Other columns are not read. An empty table gives an empty result.
    """
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    known = weak_labels(rows)
    weights, bias = fit(rows, known, sample)
    shared = documents.sparkSession.sparkContext.broadcast((weights, bias, known))
    scored = rows.mapInArrow(_score(shared, ["doc_id"]), "doc_id long, pattern string, posterior double, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
