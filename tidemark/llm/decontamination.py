"""Benchmark decontamination by a distributed positional inverted index.

The index holds one row per token of the training documents: the number of its term, the document's
key and the position. Documents are dealt over shards as the scan deals them, so building it needs no
shuffle; within a shard the postings are sorted by term, which makes a term's postings there one run.
An `END` posting closes each document and carries its id, so documents without a known term stay.

Phrases are found from their rarest terms. Each window of a test text names its two terms with the
fewest postings. Their lists, adjusted by the terms' offsets, are intersected on (document, text,
shift): what stays are windows whose rarest terms stand at the right distance. Only for these the
other terms' postings are looked up, as cells (document, position, term), and cells that follow each
other for a whole window are a match. Proximity search starts from the rarest term as well and counts
the other terms within a distance.

Lists of frequent terms are never joined as a whole, no step compares documents, and no group is
larger than one text or one document's matches. All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import lower_ascii, settle

WIDTH = 10
#: What stands between words once A-Z are lower-cased: all of ASCII but digits, letters and the capital of the end mark.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
END = "E"
END_TERM = 0


def split_words(text: Column) -> Column:
    """An empty string, the words in lower case and `END`; null has no words."""
    return F.split(F.concat(F.lit(" "), lower_ascii(F.coalesce(text, F.lit(""))), F.lit(f" {END}")), BETWEEN)


def vocabulary(words: DataFrame) -> DataFrame:
    """(word, term): the distinct words of a table with a `word` column, numbered from 1, and `END` as term 0."""
    numbered = words.where(F.col("word") != END).select("word").distinct().withColumn("term", F.monotonically_increasing_id() + 1)
    end = words.sparkSession.range(1).select(F.lit(END).alias("word"), F.lit(END_TERM).cast("long").alias("term"))
    return settle(numbered.unionByName(end), "vocabulary")


def build_index(docs: DataFrame, terms: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """term, doc, pos, doc_id: the postings of all documents, in shards sorted by term.

    `terms` is a `vocabulary`; without one, every word of the documents gets a list. With one, words
    outside of it get none: no question can name them. `doc` tells rows apart, also equal ones and
    ones without an id; `doc_id` is given at the end mark only.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("doc"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = rows.select("doc", "doc_id", F.posexplode(split_words(F.col("text"))).alias("pos", "word")).where("pos > 0")
    if terms is None:
        terms = vocabulary(found)
    postings = found.join(terms, "word").select("term", "doc", "pos", F.when(F.col("term") == END_TERM, F.col("doc_id")).alias("doc_id"))
    return settle(postings.sortWithinPartitions("term"), "postings")


def documents_of(index: DataFrame) -> DataFrame:
    """doc, doc_id, n_words: one row per indexed document."""
    return index.where(F.col("term") == END_TERM).select("doc", "doc_id", (F.col("pos") - 1).cast("long").alias("n_words"))


def texts_of(items: DataFrame, item_id: str = "item_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Distinct word sequences (pattern, words) and the items that have them (item_id, pattern); texts without words drop out.

    Many items may have one text: it is searched once.
    """
    words = split_words(F.col(text))
    held = settle(items.select(F.col(item_id).alias("item_id"), F.slice(words, 2, F.size(words) - 2).alias("words")).where(F.size("words") > 0), "items")
    patterns = settle(held.select("words").distinct().withColumn("pattern", F.monotonically_increasing_id()), "patterns")
    return patterns, settle(held.join(patterns, "words").select("item_id", "pattern").distinct(), "item_patterns")


def pattern_words(patterns: DataFrame, terms: DataFrame) -> DataFrame:
    """pattern, n, at (from 0), term: the terms of each pattern."""
    spread = patterns.select("pattern", F.size("words").alias("n"), F.posexplode("words").alias("at", "word"))
    return settle(spread.join(terms, "word").select("pattern", "n", "at", "term"), "pattern_words")


def frequencies(index: DataFrame) -> DataFrame:
    """term, postings: the length of each list."""
    return index.groupBy("term").agg(F.count("*").alias("postings"))


def windows(words: DataFrame, index: DataFrame, width: int = WIDTH) -> DataFrame:
    """pattern, s, m, and term and offset of the rarest (t1, o1) and second rarest (t2, o2) word of each window.

    A window starts at s and has m words: `width`, or all words of a shorter pattern. A term without a
    list is the rarest of all.
    """
    weighed = words.join(frequencies(index), "term", "left").fillna(0, ["postings"])
    m = F.least(F.col("n"), F.lit(width))
    first, last = F.greatest(F.col("at") - m + 1, F.lit(0)), F.least(F.col("at"), F.col("n") - m)
    at_windows = weighed.select("pattern", m.alias("m"), "at", "term", "postings", F.explode(F.sequence(first, last)).alias("s"))
    ranked = at_windows.groupBy("pattern", "s", "m").agg(F.array_sort(F.collect_list(F.struct("postings", "at", "term"))).alias("r"))
    one, two = F.col("r")[0], F.coalesce(F.get("r", F.lit(1)), F.col("r")[0])
    return ranked.select("pattern", "s", "m", one["term"].alias("t1"), one["at"].alias("o1"), two["term"].alias("t2"), two["at"].alias("o2"))


def phrase_matches(index: DataFrame, patterns: DataFrame, terms: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc, pattern, start, end: maximal runs [start, end] of positions that only occurrences of the pattern's windows cover.

    Every occurrence of a window (`width` consecutive words, or the whole of a shorter pattern) lies in
    a run, and every position of a run lies in an occurrence.
    """
    words = pattern_words(patterns, terms)
    asked = settle(windows(words, index, width), "windows")
    shift = lambda offset: (F.col("pos") - F.col(offset)).alias("shift")
    rarest = index.select("term", "doc", "pos").join(asked.withColumnRenamed("t1", "term"), "term")
    rarest = rarest.select("doc", "pattern", shift("o1"), "o2", "s", "m")
    second = asked.select(F.col("t2").alias("term"), "pattern", "o2").distinct()
    second = index.select("term", "doc", "pos").join(second, "term").select("doc", "pattern", shift("o2"), "o2")
    near = rarest.join(second, ["doc", "pattern", "shift", "o2"], "left_semi")
    # Overlapping windows of one shift give each cell once: from where the window before ends.
    seen = F.expr("lag(s + m) over (partition by doc, pattern, shift order by s)")
    fresh = near.withColumn("from", F.greatest(F.col("s"), F.coalesce(seen, F.lit(0))))
    cells = fresh.select("doc", "pattern", "shift", "m", F.explode(F.expr("sequence(`from`, s + m - 1)")).alias("at"))
    cells = cells.join(words.select("pattern", "at", "term"), ["pattern", "at"])
    cells = settle(cells.select("doc", (F.col("shift") + F.col("at")).alias("pos"), "term", "pattern", "shift", "at", "m"), "cells")
    there = index.select("term", "doc", "pos").join(settle(cells.select("doc").distinct(), "cell_docs"), "doc", "left_semi")
    found = there.join(cells, ["doc", "pos", "term"])
    run = F.expr("at - row_number() over (partition by doc, pattern, shift order by at)")
    runs = found.withColumn("run", run).groupBy("doc", "pattern", "shift", "run").agg(
        F.min("pos").alias("start"), F.max("pos").alias("end"), F.first("m").alias("m")
    )
    return runs.where("end - start + 1 >= m").select("doc", "pattern", "start", "end")


def near_matches(index: DataFrame, patterns: DataFrame, terms: DataFrame, distance: int) -> DataFrame:
    """doc, pattern, pos: postings of a pattern's rarest term that have all its other terms within `distance` positions.

    Order and repeats of the words do not matter.
    """
    words = pattern_words(patterns, terms).select("pattern", "term").distinct().join(frequencies(index), "term", "left").fillna(0, ["postings"])
    ranked = words.groupBy("pattern").agg(F.min(F.struct("postings", "term"))["term"].alias("rare"), F.count("*").alias("n"))
    others = settle(words.join(ranked, "pattern").where("term <> rare").select("pattern", "term"), "other_terms")
    places = index.select("term", "doc", "pos")
    anchors = places.join(ranked.select("pattern", F.col("rare").alias("term"), "n"), "term").select("doc", "pattern", F.col("pos").alias("anchor"), "n")
    anchors = settle(anchors, "anchors")
    # Bands as wide as the distance: what is within it lies in the anchor's band or in one beside it.
    band = max(distance, 1)
    wanted = anchors.join(others, "pattern").withColumn("band", F.explode(F.expr(f"sequence(anchor div {band} - 1, anchor div {band} + 1)")))
    held = places.join(others.select("term").distinct(), "term", "left_semi").withColumn("band", F.expr(f"pos div {band}"))
    met = wanted.join(held, ["doc", "term", "band"]).where(F.abs(F.col("pos") - F.col("anchor")) <= distance)
    counted = met.groupBy("doc", "pattern", "anchor", "n").agg(F.count_distinct("term").alias("met"))
    lone = anchors.where("n = 1").select("doc", "pattern", "anchor")
    return counted.where("met = n - 1").select("doc", "pattern", "anchor").unionByName(lone).withColumnRenamed("anchor", "pos")


def contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_hit, items: one row per document, with the positions that item windows cover and the items' ids.

    `items` is the sorted array of the ids, as strings, of items with an occurring window. Null and
    texts without words are not hit; items without words or without an id name nothing, but an item
    without an id still hits. Equal items count once by id; equal documents are told apart. Further
    columns are not read, and an empty table on either side leaves every document clean.
    """
    patterns, members = texts_of(items)
    spread = patterns.select(F.explode("words").alias("word"))
    terms = vocabulary(spread)
    index = build_index(docs, terms)
    runs = settle(phrase_matches(index, patterns, terms, width), "phrase_matches")
    covered = runs.select("doc", F.explode(F.sequence("start", "end")).alias("pos")).distinct().groupBy("doc").agg(F.count("*").alias("n_hit"))
    # Documents with the same set of patterns have the same items: these are looked up once a set.
    sets = settle(runs.groupBy("doc").agg(F.sort_array(F.collect_set("pattern")).alias("patterns")), "pattern_sets")
    named = sets.select("patterns").distinct().withColumn("pattern", F.explode("patterns")).join(members.where(F.col("item_id").isNotNull()), "pattern")
    named = named.groupBy("patterns").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    hit = sets.join(named, "patterns", "left").join(covered, "doc").select("doc", "n_hit", "items")
    told = documents_of(index).join(hit, "doc", "left")
    none = F.array().cast("array<string>")
    return told.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", none).alias("items"))
