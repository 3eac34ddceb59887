"""Document chunks and vector retrieval queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import knowledge as kb
from tidemark.registry.core import query
from tidemark.registry.ctes import CTES
from tidemark.sources.adapter import Bronze

CTES["kb_docs"] = """
  SELECT source || '/' || CAST(doc_id AS VARCHAR) AS path, doc_id, text FROM documents"""


def chunks_sql(docs: str) -> str:
    """`docs` names (path, version, text)."""
    return f"""
  SELECT sha256(path || '|' || version || '|' || array_to_string(win, ' ')) AS chunk_id, path, version, section_no, section,
         chunk_no, len(win) AS n_tokens, array_to_string(win, ' ') AS content
  FROM (SELECT path, version, section_no, section, s // 680 AS chunk_no, words[s + 1 : s + 800] AS win
        FROM (SELECT path, version, section_no, section, words,
                     unnest(range(0, greatest(len(words) - 120, 1), 680)) AS s
              FROM (SELECT path, version, section_no, nullif(regexp_extract(body, '^#{{1,6}} ([^\\n]*)', 1), '') AS section,
                           list_filter(regexp_split_to_array(body, '[ \\t\\n\\r]+'), lambda w: w <> '') AS words
                    FROM (SELECT path, version, unnest(parts) AS body, generate_subscripts(parts, 1) - 1 AS section_no
                          FROM (SELECT path, version, list_filter(
                                  string_split(regexp_replace(text, '(^|\\n)(#{{1,6}} )', '\\1' || chr(1) || '\\2', 'g'), chr(1)),
                                  lambda p: regexp_replace(p, '[ \\t\\n\\r]+', '', 'g') <> '') AS parts
                                FROM {docs})))))"""


CTES["kb_v1"] = "\n  SELECT path, 'v1' AS version, text FROM kb_docs"
CTES["kb_v2"] = "\n  SELECT path, 'v1' AS version, text || ' reviewed' AS text FROM kb_docs WHERE doc_id % 4 = 0"
CTES["chunks_v1"] = chunks_sql("kb_v1")
CTES["chunks_v2"] = chunks_sql("kb_v2")
CTES["chunk_index"] = """
  SELECT chunk_id, path, min(section_no * 1000000 + chunk_no) AS place FROM chunks_v1 GROUP BY chunk_id, path"""


def documents(b: Bronze, changed: bool = False) -> DataFrame:
    docs = b.raw("documents").withColumn("path", F.concat("source", F.lit("/"), F.col("doc_id").cast("string")))
    if changed:
        return docs.where(F.col("doc_id") % 4 == 0).withColumn("text", F.concat("text", F.lit(" reviewed")))
    return docs


def chunked(b: Bronze, changed: bool = False) -> DataFrame:
    return kb.chunk_documents(documents(b, changed), "path", "text", F.lit("v1"))


@query(
    "chunk_id:s path:s version:s section_no:i section:s chunk_no:i n_tokens:i content:s", "SELECT * FROM chunks_v1"
)
def chunk_documents(b):
    return chunked(b)


def index_rows(chunks: DataFrame) -> DataFrame:
    place = (F.col("section_no").cast("bigint") * 1000000 + F.col("chunk_no")).alias("place")
    return chunks.select("chunk_id", "path", place)


@query(
    "chunk_id:s path:s",
    "SELECT chunk_id, path FROM chunk_index UNION SELECT chunk_id, path FROM chunks_v2",
)
def chunk_upsert(b):
    """The index holds all documents; a quarter of them comes again with changed ends."""
    old, new = index_rows(chunked(b)), index_rows(chunked(b, changed=True))
    index = kb.upsert_chunks(old.limit(0), old)
    return kb.upsert_chunks(index, new)


@query(
    "chunk_id:s path:s deprecated:i",
    """SELECT chunk_id, path, (path IN (SELECT path FROM chunks_v2) AND chunk_id NOT IN (SELECT chunk_id FROM chunks_v2)) AS deprecated
       FROM chunk_index""",
)
def chunk_deprecate(b):
    old = index_rows(chunked(b))
    index = kb.upsert_chunks(old.limit(0), old)
    return kb.deprecate_chunks(index, chunked(b, changed=True))


COSINE = "round(list_dot_product(v.e, q.e) / (sqrt(list_dot_product(v.e, v.e)) * sqrt(list_dot_product(q.e, q.e))), 6)"
CTES["kb_vectors"] = "\n  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings"
CTES["kb_queries"] = "\n  SELECT label, vec_id AS query_id, e FROM kb_vectors v WHERE vec_id = (SELECT min(vec_id) FROM kb_vectors w WHERE w.label = v.label)"


@query(
    "label:i query_id:i vec_id:i score:d rank:i",
    f"""SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC NULLS LAST, vec_id) AS rank
          FROM (SELECT q.label, q.query_id, v.vec_id, {COSINE} AS score
                FROM kb_queries q JOIN kb_vectors v ON v.label = q.label AND v.vec_id <> q.query_id)) WHERE rank <= 5""",
)
def vector_topk(b):
    """Five nearest vectors with the same label, for the first vector of every label."""
    vectors = b.raw("embeddings")
    return kb.topk_by_payload(vectors, kb.first_of_payload(vectors, "label"), "label")


def canonical_questions(vectors: DataFrame) -> DataFrame:
    """First vectors of the three smallest labels, the documented number of questions."""
    first = kb.first_of_payload(vectors, "label").orderBy("label").limit(3)
    return first.withColumnRenamed("label", "expected")


@query(
    "vec_id:i label:i score:d",
    f"""SELECT v.vec_id, v.label, round({COSINE}, 9) AS score
        FROM kb_vectors v, (SELECT * FROM kb_queries ORDER BY label LIMIT 1) q
        WHERE v.label <> q.label ORDER BY {COSINE} DESC NULLS LAST, v.vec_id LIMIT 5""",
)
def vector_topk_filtered(b):
    """Five nearest vectors of other labels to one question, over the filtered collection."""
    vectors = b.raw("embeddings")
    asked = canonical_questions(vectors).orderBy("expected").first()
    found = kb.vector_topk(vectors, asked["query"], where=F.col("label") != asked.expected)
    return found.withColumn("score", F.round("score", 9))


@query(
    "query_id:i expected:i hit:i first_rank:i",
    f"""SELECT query_id, expected, max(CASE WHEN label = expected THEN 1 ELSE 0 END) AS hit,
               min(CASE WHEN label = expected THEN rank END) AS first_rank
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC NULLS LAST, vec_id) AS rank
              FROM (SELECT q.query_id, q.label AS expected, v.vec_id, v.label, {COSINE} AS score
                    FROM (SELECT * FROM kb_queries ORDER BY label LIMIT 3) q JOIN kb_vectors v ON v.vec_id <> q.query_id))
        WHERE rank <= 5 GROUP BY query_id, expected""",
)
def retrieval_hit_rate(b):
    vectors = b.raw("embeddings")
    return kb.retrieval_hits(vectors, canonical_questions(vectors), "label")
