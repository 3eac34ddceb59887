"""Language identification by unigram pieces, summed over all segmentations.

The pieces come from a fixed public vocabulary. Each language has a probability for every piece,
learned by expectation-maximisation on a bounded sample of labelled texts. The probability of a word
in a language is the sum over all its segmentations into pieces, by the forward algorithm; a text's
score is the product over its words, normalised over the languages.

Words are lower-cased runs of letters, of any length, with the mark of a word start before them. Any
single letter may also come from a small constant, so that no word is impossible. The passes over runs
above 24 letters add logarithms, as products would leave the range of doubles. Words repeat, so a
task keeps the scores of a bounded number of words. Every language value of the labelled rows is
learned, each by itself, and scored in groups of a few.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import settle, slices, uniform

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
START = "▁"
LETTERS = re.compile(r"[^\W\d_]+")
RUN = 24  # letters up to which products stay well within doubles
UNSEEN = 1e-8  # probability of a letter outside the vocabulary, and least probability of a piece
HELD_WORDS = 150_000  # words whose scores a task keeps, in four languages; fewer in more
HELD_LETTERS = 2_400_000  # and the letters of these words, about
CELLS = 80_000  # words times languages of a pass
USUAL = 64  # letters of a node's row, from the most used; the steps by others are looked up
SAMPLE = 1500  # labelled documents of a language that the fit reads, about
ROUNDS = 4
LOOSE = 0.35  # spreads of a word by which texts may differ in kind
WORST = 5.0  # spreads that a word counts below the mean, at most
LETTERS_A_WORD = 5
UNKNOWN = "und"


def vocabulary(path: str = VOCABULARY) -> list[str]:
    """Pieces of lower-case letters, with or without the start mark, in the order of the vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        body = piece[1:] if piece.startswith(START) else piece
        if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i)) and LETTERS.fullmatch(body or "a") and piece == piece.lower():
            found.append(piece)
    return found


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


class Trie:
    """Beginnings of pieces as numbered nodes, stepped through for many places at once: 0 begins no piece, 1 is the empty one."""

    def __init__(self, pieces: list[str]):
        nodes, ends = {}, []
        for piece in pieces:
            at = 1
            for letter in piece:
                at = nodes.setdefault((at, letter), len(nodes) + 2)
            ends.append(at)
        self.piece = np.full(len(nodes) + 2, -1)  # -1: a beginning that is no piece
        self.piece[ends] = np.arange(len(pieces))
        often = Counter(chain.from_iterable(pieces)).most_common()
        self.code = np.zeros(0x110000, np.int32)  # letters by falling use, from 1; 0: in no piece
        self.code[[ord(letter) for letter, _ in often]] = np.arange(1, len(often) + 1)
        self.width = len(often) + 1
        above, code = np.array([at for at, _ in nodes], np.int64), self.code[[ord(letter) for _, letter in nodes]]
        below, usual = np.arange(2, len(nodes) + 2), code < USUAL
        # One row a node for the letters used most, a sorted list for the many others.
        self.steps = np.zeros((len(nodes) + 2, USUAL + 1), np.int32)
        self.steps[above[usual], code[usual]] = below[usual]
        keys = above[~usual] * self.width + code[~usual]
        order = np.argsort(keys)
        self.keys, self.below = np.append(keys[order], -1), np.append(below[~usual][order], 0)

    def codes(self, text: str) -> np.ndarray:
        return self.code[np.frombuffer(text.encode("utf-32-le"), np.uint32)]

    def step(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Node after one more letter, for each node and letter."""
        found = self.steps[node, np.minimum(code, USUAL)]
        rare = np.flatnonzero(code >= USUAL)
        if len(rare):
            key = node[rare] * np.int64(self.width) + code[rare]
            at = np.searchsorted(self.keys[:-1], key)
            found[rare] = np.where(self.keys[at] == key, self.below[at], 0)
        return found

    def matches(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First place, last place and piece of every match."""
        begin, node, found = np.arange(len(codes)), np.ones(len(codes), np.int64), []
        codes, ahead = np.append(codes, 0), 0
        while len(begin):
            node = self.step(node, codes[np.minimum(begin + ahead, len(codes) - 1)])
            begin, node = begin[node > 0], node[node > 0]
            whole = self.piece[node] >= 0
            found.append((begin[whole], begin[whole] + ahead, self.piece[node[whole]]))
            ahead += 1
        return tuple(np.concatenate(column) for column in zip(*found))


def matcher(pieces: list[str]) -> Trie:
    return Trie(pieces)


class Lattice:
    """All pieces within a list of words, ordered for passes over the places in a word."""

    def __init__(self, words: list[str], trie: Trie, lengths: np.ndarray):
        joined = "".join(START + w for w in words)
        n = self.n = len(joined)
        sizes = np.array([len(w) + 1 for w in words])
        self.last = np.cumsum(sizes) - 1  # each word's last letter
        first = self.last - sizes + 1
        inside = np.arange(n) - np.repeat(first, sizes)  # place in the word
        self.word = np.repeat(np.arange(len(words)), sizes)
        # A piece that holds nothing but the start mark matches too; pieces never cross words.
        begin, end, piece = trie.matches(trie.codes(joined))
        # Any one letter, from a constant: piece number -1.
        end, piece, begin = (np.concatenate([x, y]) for x, y in ((end, np.arange(n)), (piece, np.full(n, -1)), (begin, np.arange(n))))
        order = np.lexsort((end, inside[end]))
        self.end, self.piece = end[order], piece[order]
        before = begin[order]
        self.before = np.where(inside[before] == 0, n, before - 1)  # n: the state before a word
        self.cuts = np.concatenate([[0], np.flatnonzero(np.diff(inside[self.end])) + 1, [len(order)]])

    def forward(self, p: np.ndarray) -> np.ndarray:
        """State after each letter; `p` has a row for each match."""
        state = np.zeros((self.n + 1, *p.shape[1:]))
        state[self.n] = 1
        for lo, hi in zip(self.cuts, self.cuts[1:]):
            end = self.end[lo:hi]
            heads = np.concatenate([[0], np.flatnonzero(np.diff(end)) + 1])
            state[end[heads]] = np.add.reduceat(state[self.before[lo:hi]] * p[lo:hi], heads)
        return state

    def forward_log(self, p: np.ndarray) -> np.ndarray:
        """`forward` with logarithms in and out."""
        state = np.full((self.n + 1, *p.shape[1:]), -np.inf)
        state[self.n] = 0
        for lo, hi in zip(self.cuts, self.cuts[1:]):
            end = self.end[lo:hi]
            heads = np.concatenate([[0], np.flatnonzero(np.diff(end)) + 1])
            state[end[heads]] = np.logaddexp.reduceat(state[self.before[lo:hi]] + p[lo:hi], heads)
        return state

    def backward_log(self, p: np.ndarray) -> np.ndarray:
        """`backward` with logarithms in and out."""
        state = np.full(self.n + 1, -np.inf)
        state[self.last] = 0
        for lo, hi in zip(self.cuts[-2::-1], self.cuts[:0:-1]):
            np.logaddexp.at(state, self.before[lo:hi], state[self.end[lo:hi]] + p[lo:hi])
        return state

    def backward(self, p: np.ndarray) -> np.ndarray:
        """Probability of what follows each letter in its word, for one-dimensional `p`."""
        state = np.zeros(self.n + 1)
        state[self.last] = 1
        for lo, hi in zip(self.cuts[-2::-1], self.cuts[:0:-1]):
            np.add.at(state, self.before[lo:hi], state[self.end[lo:hi]] * p[lo:hi])
        return state


def forward_words(words: list[str], trie: Trie, table: np.ndarray) -> np.ndarray:
    """Probability of each word in each language, for words whose products stay within doubles.

    The pieces that begin at a place are followed letter by letter for all words at once, each found
    piece adds to the state after its last letter; no list of matches is made or sorted.
    """
    sizes = np.array([len(w) + 1 for w in words])
    order = np.argsort(-sizes, kind="stable")  # the words that reach a place come first
    sizes = sizes[order]
    places, word = sizes[0], np.repeat(np.arange(len(words)), sizes)
    codes = np.zeros((places, len(words)), np.int32)  # 0 behind a word's end
    codes[np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes), word] = trie.codes("".join([START + words[i] for i in order]))
    state = np.zeros((places + 1, len(words), table.shape[1]))
    state[0] = 1
    for first in range(places):
        reach = np.searchsorted(-sizes, -first)  # words of more than `first` places
        at, node = np.arange(reach), np.ones(reach, np.int64)
        state[first + 1, :reach] += state[first, :reach] * table[-1]
        for last in range(first, places):
            node = trie.step(node, codes[last, at])
            on = np.flatnonzero(node)
            if not len(on):
                break
            at, node = at[on], node[on]
            piece = trie.piece[node]
            whole = np.flatnonzero(piece >= 0)
            mine = at[whole]
            state[last + 1, mine] += state[first, mine] * table[piece[whole]]
    out = np.empty(state.shape[1:])
    out[order] = state[sizes, np.arange(len(words))]
    return out


def word_scores(words: list[str], trie: Trie, lengths: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Log-probability of each word in each language; `table` is (pieces + 1, languages), the last row UNSEEN."""
    out, sizes = np.empty((len(words), table.shape[1])), np.array([len(w) for w in words], np.int64)
    # Runs of like length go together, so that short words do not wait for the steps of a long one.
    for some in (np.flatnonzero(sizes <= RUN), np.flatnonzero(sizes > RUN)):
        step = max(1, CELLS // max(table.shape[1], 1))
        upto = np.cumsum(np.maximum(sizes[some] // RUN, 1))
        cuts = np.searchsorted(upto, np.arange(0, upto[-1] if len(some) else 0, step))
        for lo, hi in zip(cuts, [*cuts[1:], len(some)]):
            if lo == hi:
                continue
            part = some[lo:hi]
            mine = [words[i] for i in part]
            if int(sizes[part].max()) <= RUN:
                out[part] = np.log(forward_words(mine, trie, table))
                continue
            lattice = Lattice(mine, trie, lengths)
            columns = max(1, 16_000_000 // (lattice.n + 1))
            for at in range(0, table.shape[1], columns):
                p = table[lattice.piece, at : at + columns]
                out[part, at : at + columns] = lattice.forward_log(np.log(p))[lattice.last]
    return out


def _count_words(batches):
    for whole in batches:
        for batch in slices(whole, 512):
            counts = Counter()
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                counts.update((lang, w) for w in words_of(text or ""))
            if counts:
                langs, words = zip(*counts)
                yield pa.RecordBatch.from_pydict({"lang": pa.array(langs), "word": pa.array(words), "n": pa.array(counts.values(), pa.int64())})


def _expect(pieces, names, shared):
    """Expected uses of each piece in each language, summed over a partition of (lang, word, n) rows."""

    def run(batches):
        trie, lengths = matcher(pieces), np.array([len(p) for p in pieces])
        table, number = shared.value, {name: i for i, name in enumerate(names)}
        total = np.zeros(table.shape)
        for whole in batches:
            for batch in slices(whole, 20_000):
                words, lang = batch.column("word").to_pylist(), np.array([number.get(x, -1) for x in batch.column("lang").to_pylist()])
                n, sizes = batch.column("n").to_numpy(), np.array([len(w) for w in words])
                short, long = np.flatnonzero((sizes <= RUN) & (lang >= 0)), np.flatnonzero((sizes > RUN) & (lang >= 0))
                for some in [short, *[long[i : i + 1] for i in range(len(long))]]:
                    if not len(some):
                        continue
                    lattice = Lattice([words[i] for i in some], trie, lengths)
                    at = lattice.word[lattice.end]
                    own = lang[some][at]
                    p = table[lattice.piece, own]
                    if some is short:
                        ahead, behind = lattice.forward(p), lattice.backward(p)
                        use = ahead[lattice.before] * p * behind[lattice.end] / ahead[lattice.last][at]
                    else:
                        p = np.log(p)
                        ahead, behind = lattice.forward_log(p), lattice.backward_log(p)
                        use = np.exp(ahead[lattice.before] + p + behind[lattice.end] - ahead[lattice.last][at])
                    np.add.at(total, (lattice.piece, own), use * n[some][at])
        at = np.nonzero(total[:-1])
        yield pa.RecordBatch.from_pydict({"piece": pa.array(at[0], pa.int32()), "lang": pa.array(at[1], pa.int32()), "used": pa.array(total[:-1][at])})

    return run


def _fitness(pieces, names, shared):
    """Sums over a partition of (lang, word, n) rows, by language: letters, and their words' log-probability a letter and its square."""

    def run(batches):
        trie, lengths = matcher(pieces), np.array([len(p) for p in pieces])
        table, number = shared.value, {name: i for i, name in enumerate(names)}
        for whole in batches:
            for batch in slices(whole, 20_000):
                words, n = np.array(batch.column("word").to_pylist(), object), batch.column("n").to_numpy()
                lang = np.array([number.get(x, -1) for x in batch.column("lang").to_pylist()])
                for k in np.unique(lang[lang >= 0]):
                    mine = np.flatnonzero(lang == k)
                    x = per_letter(words[mine], word_scores(list(words[mine]), trie, lengths, table[:, [k]])[:, 0])
                    w = n[mine] * letters_of(words[mine])
                    yield pa.RecordBatch.from_pydict({"lang": pa.array([k], pa.int32()), "letters": [int(w.sum())], "x": [float(w @ x)], "xx": [float(w @ (x * x))]})

    return run


def letters_of(words) -> np.ndarray:
    """Letters of each word, the start mark counted as one."""
    return np.array([len(w) for w in words], np.int64) + 1


def per_letter(words, scores: np.ndarray) -> np.ndarray:
    """Log-probability a letter."""
    return scores / letters_of(words)


class Model:
    """Languages, pieces, the table of probabilities, and each language's mean and spread of a word's log-probability a letter."""

    def __init__(self, names: list[str], pieces: list[str], table: np.ndarray, mean: np.ndarray | None = None, spread: np.ndarray | None = None):
        self.names, self.pieces, self.table = names, pieces, table
        self.mean = np.zeros(len(names)) if mean is None else mean
        self.spread = np.ones(len(names)) if spread is None else spread


LANGUAGES_A_PASS = 32


def fit(labelled: DataFrame, pieces: list[str], sample: int = SAMPLE, rounds: int = ROUNDS) -> Model:
    """Model from (doc_id, text, lang) rows with a non-null lang.

    Of each language about `sample` documents are read, chosen by a hash of their id and text; rows that
    repeat both are one row with their number, so repeated rows cannot swell the sample. Languages are
    learned independently, LANGUAGES_A_PASS at a time. What comes to the driver is one probability for
    each piece and language. Without rows no language is learned.
    """
    spark = labelled.sparkSession
    labelled = labelled.withColumn("h", F.sha2(F.coalesce("text", F.lit("")), 256))
    sizes = labelled.groupBy("lang").agg(F.count_distinct(F.struct("doc_id", "h")).alias("rows"))
    share = settle(sizes.select(F.col("lang").alias("_l"), F.least(F.lit(1.0), F.lit(float(sample)) / F.col("rows")).alias("share")), "language_shares")
    names = sorted(r["_l"] for r in share.select("_l").collect())
    if not names:
        return Model([], pieces, np.empty((len(pieces) + 1, 0)))
    chosen = labelled.join(share, F.col("lang") == F.col("_l")).where(uniform(F.lit(5), "doc_id", "h") < F.col("share"))
    chosen = chosen.dropDuplicates(["lang", "doc_id", "h"])
    words = chosen.select("text", "lang").mapInArrow(_count_words, "lang string, word string, n long")
    words = settle(words.groupBy("lang", "word").agg(F.sum("n").alias("n")), "language_words")
    tables, mean, spread = [], np.zeros(len(names)), np.ones(len(names))
    for first in range(0, len(names), LANGUAGES_A_PASS):
        some = names[first : first + LANGUAGES_A_PASS]
        held = words.where(F.col("lang").isin(some))
        table = np.full((len(pieces) + 1, len(some)), 1.0 / len(pieces))
        table[-1] = UNSEEN
        for _ in range(rounds):
            shared = spark.sparkContext.broadcast(table)
            used = held.mapInArrow(_expect(pieces, some, shared), "piece int, lang int, used double")
            rows = used.groupBy("piece", "lang").agg(F.sum("used").alias("used")).toPandas()
            counts = np.zeros(table.shape)
            counts[rows["piece"], rows["lang"]] = rows["used"]
            table = np.maximum((counts + 0.01) / (counts[:-1] + 0.01).sum(0), UNSEEN)
            table[-1] = UNSEEN
            shared.unpersist()
        shared = spark.sparkContext.broadcast(table)
        told = held.mapInArrow(_fitness(pieces, some, shared), "lang int, letters long, x double, xx double")
        for lang, n, x, xx in told.groupBy("lang").agg(F.sum("letters"), F.sum("x"), F.sum("xx")).collect():
            mean[first + lang], spread[first + lang] = x / n, max(xx / n - (x / n) ** 2, 1e-4) ** 0.5
        shared.unpersist()
        tables.append(table)
    return Model(names, pieces, np.concatenate(tables, 1), mean, spread)


def _identify(shared, others):
    def run(batches):
        model = Model(*shared.value)
        trie, lengths = matcher(model.pieces), np.array([len(p) for p in model.pieces])
        number, scores, sizes = {}, np.empty((0, len(model.names))), np.empty(0, np.int64)
        most = HELD_WORDS * 4 // max(len(model.names), 4)

        def known(counters):
            """Scores of all words so far, with those of the new ones; starts anew where the bounds are reached."""
            nonlocal number, scores, sizes
            new = list(dict.fromkeys(filterfalse(number.__contains__, chain.from_iterable(counters))))
            if len(number) + len(new) > most or sizes.sum() > HELD_LETTERS:
                number, scores, sizes = {}, scores[:0], sizes[:0]
                new = list(dict.fromkeys(chain.from_iterable(counters)))
            if new:
                number.update(zip(new, range(len(number), len(number) + len(new))))
                sizes = np.concatenate([sizes, letters_of(new)])
                parts = [word_scores(new[i : i + 20_000], trie, lengths, model.table) for i in range(0, len(new), 20_000)]
                scores = np.concatenate([scores, *parts])

        for whole in batches:
            for batch in slices(whole, 256):
                counters = [Counter(words_of(t)) if t else Counter() for t in batch.column("text").to_pylist()]
                known(counters)
                best, sure, fit = [], [], []
                for counter in counters:
                    if not counter or not model.names:
                        best.append(UNKNOWN)
                        sure.append(0.0)
                        fit.append(None)
                        continue
                    at = np.fromiter(map(number.__getitem__, counter), np.int64, len(counter))
                    n = np.fromiter(counter.values(), np.float64, len(counter))
                    s = n @ scores[at]
                    k = int(s.argmax())
                    best.append(model.names[k])
                    sure.append(float(1 / np.exp(s - s.max()).sum()))
                    z = (scores[at, k] / sizes[at] - model.mean[k]) / model.spread[k]
                    w = n * sizes[at]
                    fit.append(float(w @ np.maximum(z, -WORST) / w.sum() / (LOOSE + (w.sum() / LETTERS_A_WORD) ** -0.5)))
                columns = [pa.array(best), pa.array(sure), pa.array(fit, pa.float64())]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], *columns], [*others, "lang_pred", "score", "fit"])

    return run


def identify(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of `documents` but the text's, which must be called `text`, with lang_pred, score and fit.

    `score` is the posterior of the predicted language among the learned ones. `fit` says how well the
    text fits that language at all, by its words' log-probability a letter: the mean over its letters of
    the distance from the labelled texts' mean, in spreads, no word lower than WORST of them, so that a
    code or an address in a text does not decide; divided by LOOSE, for texts of a kind of their own,
    plus the deviation of a mean over so many letters. Random letters and languages not learned
    lie below -6.5, unless the text is shorter than some forty letters, which tell too little.
    A null text, a text without letters, and every text if no language was learned gives `und`, 0 and
    null. Whole texts are read; an empty table gives an empty result.
    """
    others = [c for c in documents.columns if c != text]
    kinds = dict(documents.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in others] + ["lang_pred string", "score double", "fit double"])
    shared = documents.sparkSession.sparkContext.broadcast((model.names, model.pieces, model.table, model.mean, model.spread))
    return documents.mapInArrow(_identify(shared, others), schema)


def learn(documents: DataFrame, where: Column, path: str = VOCABULARY, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", **options) -> Model:
    """The model of the rows of `documents` where the condition holds and lang is given."""
    labelled = documents.where(where & F.col(lang).isNotNull())
    labelled = labelled.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    return fit(labelled, vocabulary(path), **options)
