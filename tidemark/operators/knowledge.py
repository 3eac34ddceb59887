"""Document chunks with content keys, and exact cosine retrieval."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.merge import insert_ignore
from tidemark.session import settle

CHUNK_TOKENS = 800
CHUNK_STEP = 680  # 15 % overlap
BLANKS = "[ \\t\\n\\r]+"
SECTION_MARK = "\u0001"


def chunk_documents(
    docs: DataFrame, path: str, text: str, version: Column, tokens: int = CHUNK_TOKENS, step: int = CHUNK_STEP
) -> DataFrame:
    """Chunks of whole texts: rows (chunk_id, path, version, section_no, section, chunk_no, n_tokens, content).

    A text is cut at its heading lines, each section into windows of `tokens` words that start every
    `step` words. A window that adds no word to the one before is left out. Equal chunks of one
    document share a chunk_id.
    """
    marked = F.regexp_replace(F.col(text), "(^|\\n)(#{1,6} )", f"$1{SECTION_MARK}$2")
    trimmed = lambda c: F.btrim(c, F.lit(" \t\n\r"))
    parts = F.filter(F.split(marked, SECTION_MARK), lambda p: trimmed(p) != "")
    sections = docs.select(
        F.col(path).alias("path"), version.cast("string").alias("version"), F.posexplode(parts).alias("section_no", "body")
    )
    heading = F.nullif(F.regexp_extract("body", "^#{1,6} ([^\\n]*)", 1), F.lit(""))
    words = F.split(trimmed(F.col("body")), BLANKS)
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - (tokens - step) - 1, F.lit(0)), F.lit(step))
    return (
        sections.select("path", "version", "section_no", heading.alias("section"), words.alias("words"))
        .select("*", F.posexplode(starts).alias("chunk_no", "start"))
        .select(
            "path",
            "version",
            "section_no",
            "section",
            "chunk_no",
            F.slice("words", F.col("start") + 1, F.lit(tokens)).alias("window"),
        )
        .select(
            F.sha2(F.concat_ws("|", "path", "version", F.array_join("window", " ")), 256).alias("chunk_id"),
            "path",
            "version",
            "section_no",
            "section",
            "chunk_no",
            F.size("window").alias("n_tokens"),
            F.array_join("window", " ").alias("content"),
        )
    )


def upsert_chunks(index: DataFrame, chunks: DataFrame) -> DataFrame:
    """Adds chunks whose id is not indexed yet. Content already there is left alone."""
    return insert_ignore(index, chunks, ["chunk_id"])


def deprecate_chunks(index: DataFrame, chunks: DataFrame) -> DataFrame:
    """Index with `deprecated`: true for chunks of a re-chunked path that the new chunks lack.

    Points are marked, never removed; new chunks are not added here.
    """
    current = chunks.groupBy("chunk_id").agg(F.lit(True).alias("_current"))
    touched = chunks.groupBy("path").agg(F.lit(True).alias("_touched"))
    before = F.col("deprecated") if "deprecated" in index.columns else F.lit(False)
    stale = F.col("_touched").isNotNull() & F.col("_current").isNull()
    return (
        index.join(current, "chunk_id", "left")
        .join(touched, "path", "left")
        .select(*[c for c in index.columns if c != "deprecated"], (before | stale).alias("deprecated"))
    )


def dot(a: Column, b: Column) -> Column:
    """Inner product as double."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def cosine(vector: Column, query: Column, query_norm: Column) -> Column:
    """Cosine similarity; NULL where either vector is zero. The query's norm comes ready."""
    return F.round(F.try_divide(dot(vector, query), F.sqrt(dot(vector, vector)) * query_norm), 6)


def literal_query(vector: Sequence[float]) -> tuple[Column, Column]:
    """A query vector and its norm as constants."""
    values = [float(x) for x in vector]
    return F.array(*[F.lit(x) for x in values]), F.lit(math.sqrt(sum(x * x for x in values)))


def vector_topk(
    vectors: DataFrame, query: Sequence[float], k: int = 5, where: Column | None = None, id_col: str = "vec_id"
) -> DataFrame:
    """Exact top-k of one query over the filtered collection, ties to the smaller id."""
    kept = vectors if where is None else vectors.where(where)
    return (
        kept.withColumn("score", cosine(F.col("embedding"), *literal_query(query)))
        .orderBy(F.desc_nulls_last("score"), id_col)
        .limit(k)
    )


def topk_by_payload(vectors: DataFrame, queries: DataFrame, payload: str, k: int = 5, id_col: str = "vec_id") -> DataFrame:
    """Top-k inside each payload value, for one query per payload value.

    `queries` has columns (payload, query_id, query, query_norm), see `first_of_payload`. Every task keeps only its own k best rows per
    payload value before the shuffle (window group limit), so a value holding a third of the
    collection sends k rows per task, not its whole group.
    """
    order = Window.partitionBy(payload).orderBy(F.desc_nulls_last("score"), F.col(id_col))
    return (
        vectors.join(queries, payload)
        .where(F.col(id_col) != F.col("query_id"))
        .select(payload, "query_id", id_col, cosine(F.col("embedding"), F.col("query"), F.col("query_norm")).alias("score"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
    )


def first_of_payload(vectors: DataFrame, payload: str, id_col: str = "vec_id") -> DataFrame:
    """The vector of the smallest id of each payload value, as that value's query.

    Ids are found without reading vectors; both steps are settled, so that their joins with the
    collection know how few rows they bring and need not shuffle it.
    """
    first = settle(vectors.groupBy(payload).agg(F.min(id_col).alias(id_col)), "first-ids")
    query = F.col("embedding")
    chosen = vectors.join(first, [payload, id_col]).select(
        payload, F.col(id_col).alias("query_id"), query.alias("query"), F.sqrt(dot(query, query)).alias("query_norm")
    )
    return settle(chosen, "first-vectors")


QUESTIONS = 64  # questions that a row of the collection meets at a time


def retrieval_hits(vectors: DataFrame, questions: DataFrame, payload: str, k: int = 5, id_col: str = "vec_id") -> DataFrame:
    """Is the expected payload among the k nearest vectors of each canonical question?

    `questions` has columns (query_id, expected, query, query_norm), any number of rows. They meet the
    collection in blocks of `QUESTIONS`, each a row of arrays. The window group limit keeps k rows per
    question and task.
    """
    block = F.expr(f"(row_number() over (order by query_id) - 1) div {QUESTIONS}")
    asked = F.struct("query_id", "expected", "query", "query_norm")
    blocks = questions.withColumn("_block", block).groupBy("_block").agg(F.collect_list(asked).alias("_asked"))
    n_blocks = max(1, -(-questions.count() // QUESTIONS))
    met = vectors.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)).cast("array<bigint>")))
    pairs = met.join(blocks, "_block").select(id_col, payload, "embedding", F.inline("_asked"))
    order = Window.partitionBy("query_id").orderBy(F.desc_nulls_last("score"), F.col(id_col))
    return (
        pairs.where(F.col(id_col) != F.col("query_id"))
        .select(
            id_col, payload, "query_id", "expected",
            cosine(F.col("embedding"), F.col("query"), F.col("query_norm")).alias("score"),
        )
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .groupBy("query_id", "expected")
        .agg(
            F.max((F.col(payload) == F.col("expected")).cast("int")).alias("hit"),
            F.min(F.when(F.col(payload) == F.col("expected"), F.col("rank"))).alias("first_rank"),
        )
    )
