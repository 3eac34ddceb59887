"""Registered queries over whole tables, with production parameters, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (
    chat,
    decontamination,
    exact_dedup,
    language,
    merkle,
    mixing,
    packing,
    quality,
    simhash,
    substrings,
    topk,
    toxicity,
    whitening,
)
from tidemark.llm.common import crc_mod, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(build):
        QUERIES[build.__name__] = build
        if sql:
            ORACLES[build.__name__] = sql
        return build

    return register


@query()
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(read(spark, sf_dir, "documents"))


@query()
def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source", "source_size", "target", "copies", "taken")


@query(
    """
    WITH digests AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, text_sha256
    FROM digests WINDOW w AS (PARTITION BY text_sha256)
    """
)
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History is the half of the documents with an even checksum of their id, the rest comes in."""
    marked = exact_dedup.mark(read(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 2) == 0)
    return marked.drop("in_history")


@query()
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    model = language.learn(documents, ~held_out)
    return language.identify(documents.select("doc_id", held_out.alias("held_out"), "text"), model)  # and how well it fits


@query()
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.plan(read(spark, sf_dir, "documents")).drop("key")


@query(
    """
    WITH rows AS (SELECT DISTINCT vec_id, embedding FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
    parts AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM rows),
    bad AS (SELECT DISTINCT vec_id FROM parts WHERE x IS NULL OR NOT isfinite(x)),
    v AS (
        SELECT vec_id, i, CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) AS x
        FROM parts WHERE vec_id NOT IN (SELECT vec_id FROM bad)
    ),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
        FROM v AS q JOIN v AS c ON q.i = c.i AND q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
        GROUP BY q.vec_id, c.vec_id
    ),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """
)
def op10_max_score_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.settle(topk.usable(read(spark, sf_dir, "embeddings")), "integer_vectors")
    return topk.top_k(vectors, vectors.where("id % 20 = 0"))


@query(
    r"""
    WITH turns AS (
        SELECT conv_id, CASE WHEN role IS NULL OR trim(role) = '' THEN 'unknown' ELSE role END AS speaker,
               coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) - 1 AS place
        FROM conversations
    ),
    people AS (SELECT DISTINCT conv_id, speaker AS me FROM turns WHERE speaker <> 'system'),
    seen AS (
        SELECT t.conv_id, p.me, t.place, t.place // 64 AS part, t.speaker = p.me AS mine,
               '<|im_start|>' || CASE WHEN t.speaker = p.me THEN 'assistant' WHEN t.speaker = 'system' THEN 'system'
                                      ELSE 'user name=' || t.speaker END || chr(10) AS head,
               replace(t.text, '<|', '<' || chr(8203) || '|') || '<|im_end|>' || chr(10) AS body
        FROM turns AS t JOIN people AS p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
    ),
    sized AS (
        SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, me, part ORDER BY place) AS upto FROM seen
    ),
    parts AS (
        SELECT conv_id, me AS speaker, part, count(*) AS n_turns, sum(length(head) + length(body)) AS n_chars,
               sha256(string_agg(head || body, '' ORDER BY place)) AS text_sha256,
               coalesce(string_agg((upto - length(body)) || '-' || (upto - 1), ',' ORDER BY place) FILTER (WHERE mine), '') AS spans
        FROM sized GROUP BY conv_id, me, part
    )
    SELECT conv_id, speaker, part,
           CAST(sum(n_chars) OVER (PARTITION BY conv_id, speaker ORDER BY part) - n_chars AS BIGINT) AS "offset",
           n_turns, text_sha256, spans
    FROM parts
    """
)
def op9_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    turned = chat.rotate(read(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return turned.select("conv_id", "speaker", "part", "offset", "n_turns", F.sha2("text", 256).alias("text_sha256"), spans.alias("spans"))


@query(
    """
    WITH docs AS (SELECT row_number() OVER () AS k, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    parts AS (SELECT k, c, substr(h, 2 * c + 1, 2398) AS part FROM (SELECT k, h, unnest(range(0, len(h) // 2 - 199, 1000)) AS c FROM docs)),
    starts AS (
        SELECT k, c + i AS p, md5(substr(part, 2 * i + 1, 400)) AS s
        FROM (SELECT k, c, part, unnest(range(least(1000, len(part) // 2 - 199))) AS i FROM parts)
    ),
    repeated AS (SELECT s FROM starts GROUP BY s HAVING count(*) > 1),
    hits AS (SELECT k, p, p - lag(p) OVER (PARTITION BY k ORDER BY p) > 200 AS apart FROM starts WHERE s IN (FROM repeated)),
    numbered AS (SELECT k, p, count(*) FILTER (WHERE apart) OVER (PARTITION BY k ORDER BY p) AS run FROM hits),
    runs AS (SELECT k, min(p) AS a, max(p) + 200 AS b FROM numbered GROUP BY k, run),
    gaps AS (
        SELECT k, b AS a, coalesce(lead(a) OVER (PARTITION BY k ORDER BY a), 1000000000) AS b FROM runs
        UNION ALL SELECT k, 0, coalesce(min(a), 1000000000) FROM docs LEFT JOIN runs USING (k) GROUP BY k
    ),
    kept AS (SELECT k, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS h FROM gaps JOIN docs USING (k) GROUP BY k)
    SELECT doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(sum(b - a), 0) AS BIGINT) AS n_removed,
           count(a) AS n_spans, sha256(unhex(any_value(kept.h))) AS kept_sha256
    FROM docs AS d JOIN kept USING (k) LEFT JOIN runs USING (k) GROUP BY k, doc_id, d.h
    """
)
def op7_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(read(spark, sf_dir, "documents"))
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return cut.select(
        "doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query()
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    known = labels.where(~held_out & F.col("toxic").isNotNull()).select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.fit(documents, known)
    scored = toxicity.score(documents.select("doc_id", held_out.alias("held_out"), "text"), model)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query()
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"))


@query(
    r"""
    WITH item AS (
        SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark WHERE text IS NOT NULL
    ),
    doc AS (
        SELECT row_number() OVER () AS d, doc_id,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents
    ),
    wanted AS (
        SELECT DISTINCT item_id, least(len(w), 10) AS m, list_slice(w, s, s + least(len(w), 10) - 1) AS win
        FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM item WHERE len(w) > 0)
    ),
    given AS (
        SELECT d, m, s, list_slice(w, s, s + m - 1) AS win
        FROM (SELECT d, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM doc, (SELECT DISTINCT m FROM wanted))
    ),
    hits AS (SELECT d, s, g.m, item_id FROM given AS g JOIN wanted AS i ON g.m = i.m AND g.win = i.win),
    covered AS (SELECT d, count(DISTINCT p) AS n_hit FROM (SELECT d, unnest(range(s, s + m)) AS p FROM hits) GROUP BY d),
    named AS (
        SELECT d, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
        FROM (SELECT DISTINCT d, CAST(item_id AS VARCHAR) AS name FROM hits WHERE item_id IS NOT NULL) GROUP BY d
    )
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM doc LEFT JOIN covered USING (d) LEFT JOIN named USING (d)
    """
)
def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = decontamination.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return told.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query(
    """
    WITH RECURSIVE leaves AS (
        SELECT row_number() OVER () AS k, doc_id, lang,
               ids || coalesce(strlen(text) || ':' || text, '-') AS whole,
               ids || coalesce(strlen(lowered) || ':' || lowered, '-') AS tampered_whole,
               xor(list_reduce([4294967295] || list_transform(range(1, length(name) + 1), lambda i: ascii(name[i])),
                   lambda c, b: list_reduce([xor(c, b)] || range(8), lambda x, j: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 3 = 0 AS tampered
        FROM (
            SELECT *, CAST(doc_id AS VARCHAR) AS name, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered,
                   coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS ids
            FROM documents
        )
    ),
    hashed AS (
        SELECT k, doc_id, lang, sha256(whole) AS leaf, CASE WHEN tampered THEN sha256(tampered_whole) ELSE sha256(whole) END AS given FROM leaves
    ),
    placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM hashed),
    tree AS (
        SELECT lang, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM placed GROUP BY lang
        UNION ALL
        SELECT lang, level + 1, list_transform(range(0, len(nodes), 8), lambda i: sha256(array_to_string(nodes[i + 1:i + 8], '')))
        FROM tree WHERE len(nodes) > 1
    ),
    subroots AS (SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS lang_no FROM tree WHERE len(nodes) = 1),
    top AS (
        SELECT 0 AS level, list(subroot ORDER BY lang_no) AS nodes FROM subroots
        UNION ALL
        SELECT level + 1, list_transform(range(0, len(nodes), 8), lambda i: sha256(array_to_string(nodes[i + 1:i + 8], '')))
        FROM top WHERE len(nodes) > 1
    ),
    runs AS (
        SELECT k, level, nodes, pos // CAST(8 ** level AS BIGINT) AS i
        FROM placed AS p JOIN tree AS t ON p.lang IS NOT DISTINCT FROM t.lang WHERE len(nodes) > 1
        UNION ALL
        SELECT k, 1000 + level, nodes, lang_no // CAST(8 ** level AS BIGINT)
        FROM placed AS p JOIN subroots AS s ON p.lang IS NOT DISTINCT FROM s.lang, top WHERE len(nodes) > 1
    ),
    steps AS (
        SELECT k, level, array_to_string(nodes[i - i % 8 + 1:i], '') AS l, array_to_string(nodes[i + 2:i - i % 8 + 8], '') AS r FROM runs
    ),
    paths AS (SELECT k, list(l || '|' || r ORDER BY level) AS path, sha256(string_agg(l || r, '' ORDER BY level)) AS proof FROM steps GROUP BY k),
    told AS (
        SELECT doc_id, leaf, subroot, (SELECT nodes[1] FROM top WHERE len(nodes) = 1) AS root, coalesce(proof, sha256('')) AS proof_sha256,
               coalesce(list_reduce([given] || path, lambda d, s: sha256(split_part(s, '|', 1) || d || split_part(s, '|', 2))), given) AS folded_root
        FROM placed AS p JOIN subroots AS s ON p.lang IS NOT DISTINCT FROM s.lang LEFT JOIN paths USING (k)
    )
    SELECT *, folded_root = root AS verified FROM told
    """
)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(read(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 3) == 0).verify()


@query()
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))
