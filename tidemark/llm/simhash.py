"""SimHash near-dedup by pigeonhole blocks.

A fingerprint bit is 1 if it is set in over half of the hashes of a text's word shingles, repeats
included. A fingerprint is split into blocks; every choice of some blocks is a key, fingerprints join
on keys and their Hamming distance is verified. With `n` blocks and keys of `n - radius` blocks any
two fingerprints within `radius` bits share a key, for the bits that differ spoil at most `radius`
blocks.

Equal fingerprints are one row from the start, whatever number of documents has them. A bucket (the
fingerprints of a key) is met in sorted order with bounded memory and yields one link per member at
most, never all its pairs. A bucket above `bucket` members is left to another exact way: each of its
fingerprints lists all points within radius / 2 bits, and fingerprints that list a common point are
within `radius` of each other, so every point needs only the links to its least lister.
"""

from __future__ import annotations

import math
from fractions import Fraction
from hashlib import sha256
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import mix64, row_digest, settle, slices, whole_row
from tidemark.llm.components import components

BUCKET = 4096
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
WIDTH, KEYS, KEY_BITS = 128, 128, 16  # of the wide fingerprints
CHUNK = 1 << 16  # shingles whose bits are counted at once
SETS, SET_BYTES = 256, 8 << 20  # shingle sets of a tile, and their bytes, about


def shingle_hashes(text: bytes, words: int, seed: int = 42) -> list[int]:
    """XXH64 of each run of `words` words, lower-cased in A-Z and joined by blanks; of all if there are fewer."""
    parts = text.translate(LOWER).split()
    joined = b" ".join(parts)
    if len(parts) <= words:
        return [xxhash.xxh64_intdigest(joined, seed)] if parts else []
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = np.concatenate([[0], ends[:-words]]).tolist()
    hashed = xxhash.xxh64_intdigest
    return [hashed(joined[a:b], seed) for a, b in zip(starts, (ends[words - 1 :] - 1).tolist())]


def fingerprint(hashes: list[int], width: int = 64) -> list[int]:
    """Words of 64 bits, the first from the hashes, further ones from bijections of them; zero if there are none."""
    out = []
    for k in range(width // 64):
        counts = np.zeros(64, np.int64)
        for at in range(0, len(hashes), CHUNK):
            part = np.array(hashes[at : at + CHUNK], np.uint64)
            part = mix64(part + np.uint64(k)) if k else part
            bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            counts += bits.sum(0, dtype=np.int64)
        out.append(int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big", signed=True))
    return out


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles; empty for a null or wordless text."""
    return np.unique(np.array(shingle_hashes(text.encode() if text else b"", words), np.uint64))


def set_fingerprints(documents: DataFrame, words: int, width: int, text: str = "text") -> DataFrame:
    """`documents` with set_digest, the SHA-256 of the set of shingles, and the set's fingerprint f0, f1, ... instead of the text."""
    others = [c for c in documents.columns if c != text]
    names = [f"f{k}" for k in range(width // 64)]

    def run(batches):
        for whole in batches:
            for batch in slices(whole):
                found = []
                for t in batch.column(text).to_pylist():
                    s = shingle_set(t, words)
                    found.append((sha256(s.tobytes()).digest(), *fingerprint(s, width)))
                columns = [batch.column(c) for c in others] + [pa.array([f[0] for f in found], pa.binary())]
                columns += [pa.array([f[k + 1] for f in found], pa.int64()) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays(columns, [*others, "set_digest", *names])

    schema = ", ".join([f"`{c}` {t}" for c, t in documents.dtypes if c != text] + ["set_digest binary"] + [f"{n} long" for n in names])
    return documents.mapInArrow(run, schema)


def fingerprints(documents: DataFrame, words: int, width: int = 64, text: str = "text") -> DataFrame:
    """`documents` (few, small columns beside the text) with f0, f1, ... instead of the text."""
    others = [c for c in documents.columns if c != text]
    names = [f"f{k}" for k in range(width // 64)]

    def run(batches):
        for whole in batches:
            for batch in slices(whole):
                found = [
                    fingerprint(shingle_hashes(t.encode() if t else b"", words), width)
                    for t in batch.column(text).to_pylist()
                ]
                columns = [batch.column(c) for c in others] + [pa.array([f[k] for f in found], pa.int64()) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays(columns, [*others, *names])

    schema = ", ".join([f"`{c}` {t}" for c, t in documents.dtypes if c != text] + [f"{n} long" for n in names])
    return documents.mapInArrow(run, schema)


def block_masks(width: int, blocks: int, shared: int, keys: int | None = None, seed: int = 1) -> list[tuple[int, ...]]:
    """Masks (one signed word per 64 bits) for the choices of `shared` out of `blocks` blocks: all, or `keys` drawn ones."""
    edges = [round(width * i / blocks) for i in range(blocks + 1)]
    block = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    if keys is None:
        chosen = list(combinations(range(blocks), shared))
    else:
        draw = np.random.default_rng(seed)
        chosen = [draw.choice(blocks, shared, replace=False) for _ in range(keys)]
    masks = []
    for choice in chosen:
        whole = sum(block[i] for i in choice)
        parts = [(whole >> (64 * k)) & (2**64 - 1) for k in range(width // 64)]
        masks.append(tuple(p - 2**64 if p >= 2**63 else p for p in parts))
    return masks


def wide_masks(width: int = WIDTH, keys: int = KEYS, key_bits: int = KEY_BITS) -> tuple[list]:
    """The masks that `link_wide` takes: drawn choices of 4-bit blocks."""
    return (block_masks(width, width // 4, key_bits // 4, keys),)


def radius_for(similarity: float, width: int, slack: float = 3.0) -> int:
    """Bits that fingerprints of two shingle sets of this Jaccard similarity and like size differ in.

    The mean and `slack` standard deviations: at 0, half of the pairs just at the similarity are
    within the radius, at 3 all but about one in a thousand.
    """
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return math.floor(width * p + slack * math.sqrt(width * p * (1 - p)))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(1)


def forest(keys: np.ndarray, fps: np.ndarray, ids: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect, for each key of the sorted `keys`, what is connected within `radius`; one per row at most."""
    n = len(keys)
    label, lag, found = np.arange(n), 1, []
    while lag < n:
        same = np.flatnonzero(keys[lag:] == keys[:-lag])
        if not len(same):
            break
        near = same[distances(fps[same], fps[same + lag]) <= radius]
        if len(near):
            found.append(np.stack([near, near + lag]))
        lag += 1
    if not found:
        return []
    a, b = np.concatenate(found, axis=1)
    while True:
        low = np.minimum(label[a], label[b])
        if (label[a] == low).all() and (label[b] == low).all():
            break
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
    hung = np.flatnonzero(label != np.arange(n))
    return [(int(ids[i]), int(ids[label[i]])) for i in hung]


def _meet(width: int, radius: int, bucket: float):
    """A pass over rows (k, id, f0, ...) sorted by k: links (a, b), and (k, a, null) for members of large buckets."""
    names = [f"f{k}" for k in range(width // 64)]
    pending = 1 << 14 if math.isinf(bucket) else max(1 << 14, bucket + 2)

    def table(links, keys, dense):
        a = np.concatenate([np.array([x for x, _ in links], np.int64), dense])
        b = pa.array([y for _, y in links] + [None] * len(dense), pa.int64())
        k = pa.array([None] * len(links) + keys.tolist(), pa.int64())
        return pa.RecordBatch.from_arrays([k, pa.array(a), b], ["k", "a", "b"])

    def run(batches):
        held, large = [], None

        def meet(final):
            """Closes the buckets that are held whole; the last one stays open until another key comes."""
            nonlocal held, large
            k, f, i = (np.concatenate(c) for c in zip(*held))
            dense_k, dense_i = k[:0], i[:0]
            if large is not None:  # the rest of a bucket found too large before
                m = int(np.searchsorted(k, large, side="right"))
                dense_k, dense_i, k, f, i = k[:m], i[:m], k[m:], f[m:], i[m:]
                large = large if not len(k) else None
            cut = len(k) if final or not len(k) else int(np.searchsorted(k, k[-1]))
            stay = slice(cut, len(k))
            if len(k) - cut > bucket:
                large = int(k[-1])
                dense_k, dense_i = np.concatenate([dense_k, k[cut:]]), np.concatenate([dense_i, i[cut:]])
                stay = slice(0, 0)
            held = [(k[stay], f[stay], i[stay])]
            k, f, i = k[:cut], f[:cut], i[:cut]
            _, inverse, sizes = np.unique(k, return_inverse=True, return_counts=True)
            size = sizes[inverse] if len(k) else np.empty(0, np.int64)
            over = size > bucket
            dense_k, dense_i = np.concatenate([dense_k, k[over]]), np.concatenate([dense_i, i[over]])
            some = (size > 1) & ~over
            return table(forest(k[some], f[some], i[some], radius), dense_k, dense_i)

        for batch in batches:
            if batch.num_rows:
                f = np.stack([batch.column(n).to_numpy().view(np.uint64) for n in names], axis=1)
                held.append((batch.column("k").to_numpy(), f, batch.column("id").to_numpy()))
                if sum(len(h[0]) for h in held) >= pending:
                    yield meet(False)
        if held:
            yield meet(True)

    return run


def _listed(radius: int):
    """Every point within radius / 2 bits of a fingerprint, as (point, id)."""
    flips = [0]
    for k in range(1, radius // 2 + 1):
        flips += [sum(1 << b for b in c) for c in combinations(range(64), k)]
    flips = np.array(flips, np.uint64)

    def run(batches):
        for batch in batches:
            ids, f = batch.column("id").to_numpy(), batch.column("f0").to_numpy().view(np.uint64)
            for i, x in zip(ids.tolist(), f):
                yield pa.RecordBatch.from_arrays([pa.array((x ^ flips).view(np.int64)), pa.array(np.full(len(flips), i))], ["p", "id"])

    return run


def _keyed(rows: DataFrame, names: list[str], masks: list[tuple[int, ...]]) -> DataFrame:
    """One row (k, id, fingerprint) for each mask."""
    table = F.array(*[F.struct(F.lit(c).alias("c"), *[F.lit(m).cast("long").alias(f"m{n}") for n, m in enumerate(mask)]) for c, mask in enumerate(masks)])
    rows = rows.select("id", *names, F.explode(table).alias("t"))
    masked = [F.col(n).bitwiseAND(F.col(f"t.m{i}")) for i, n in enumerate(names)]
    return rows.select(F.xxhash64("t.c", *masked).alias("k"), "id", *names)


def _join_on_keys(keyed: DataFrame, radius: int, bucket: float, name: str) -> DataFrame:
    width = 64 * (len(keyed.columns) - 2)
    met = keyed.repartition("k").sortWithinPartitions("k", "id").mapInArrow(_meet(width, radius, bucket), "k long, a long, b long")
    return settle(met.distinct(), name)


def link_exact(fps: DataFrame, radius: int, blocks: int, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that connect all distinct 64-bit fingerprints (id, f0) which steps of `radius` bits or less connect."""
    keyed = _keyed(fps, ["f0"], block_masks(64, blocks, blocks - radius))
    met = _join_on_keys(keyed, radius, bucket, "simhash_met")
    dense = met.where("b is null").select(F.col("a").alias("id")).distinct().join(fps, "id")
    points = dense.mapInArrow(_listed(radius), "p long, id long")
    least = points.groupBy("p").agg(F.min("id").alias("m"), F.count("*").alias("n")).where("n > 1").drop("n")
    more = points.join(least, "p").where("id > m").select(F.col("id").alias("a"), F.col("m").alias("b"))
    return met.where("b is not null").select("a", "b").unionByName(more.distinct())


def _tile_pairs(dense: DataFrame, fps: DataFrame, names: list[str], bucket: int) -> DataFrame:
    """Rows (k, id, fingerprint) for every two of the tiles, of about half a `bucket`, that a bucket (k, id) is dealt to."""
    sizes = settle(dense.groupBy("k").agg(F.expr(f"ceil(2 * count(*) / {bucket})").alias("tiles")), "simhash_tiles")
    rows = dense.join(sizes, "k").withColumn("tile", F.expr("pmod(xxhash64(id), tiles)"))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0L, tiles - 1)"))).where("other <> tile").join(fps, "id")
    return rows.select(F.xxhash64("k", F.least("tile", "other"), F.greatest("tile", "other")).alias("k"), "id", *names)


def link_wide(fps: DataFrame, radius: int, masks: list[tuple[int, ...]], bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that connect all wide fingerprints (id, f0, f1, ...) within `radius` bits that share a key of `masks`.

    A bucket above `bucket` members is dealt to tiles by a hash; every two tiles meet as a bucket of
    their own, so all pairs of its members are compared, over many tasks.
    """
    names = fps.columns[1:]
    met = _join_on_keys(_keyed(fps, names, masks), radius, bucket, "simhash_met")
    links, dense = met.where("b is not null").select("a", "b"), met.where("b is null").select("k", F.col("a").alias("id"))
    if dense.isEmpty():
        return links
    more = _join_on_keys(_tile_pairs(dense, fps, names, bucket), radius, math.inf, "simhash_met_tiles")
    return links.unionByName(more.select("a", "b"))


def groups(marked: DataFrame, names: list[str], linked) -> DataFrame:
    """`marked` (doc_id and fingerprint columns) with component_id: the smallest doc_id that links reach.

    `linked` makes links from distinct fingerprints with an id. Equal fingerprints belong together.
    A null doc_id never names a component unless all of its rows lack one.
    """
    distinct = settle(
        marked.groupBy(*names).agg(F.min("doc_id").alias("first")).withColumn("id", F.col(names[0]) if len(names) == 1 else F.xxhash64(*names)),
        "simhash_distinct",
    )
    roots = components(linked(distinct.select("id", *names)))
    placed = distinct.join(roots, distinct["id"] == roots["node"], "left").select(*names, "first", F.coalesce("root", "id").alias("root"))
    placed = settle(placed, "simhash_roots")
    # Written, so that the join's sides are plain shuffles and a hot root can be split.
    least = settle(placed.groupBy("root").agg(F.min("first").alias("component_id")), "simhash_components")
    placed = placed.join(least, "root").select(*names, "component_id")
    return marked.join(placed, names)


def near_groups(documents: DataFrame, words: int = 4, radius: int = 4, blocks: int = 7, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id for every row of `documents`.

    Fingerprints within `radius` bits are linked, all of them. Null, empty and wordless texts have
    fingerprint zero and are linked like others; a text of fewer words than a shingle is one shingle.
    Texts are read whole. Null ids are kept; an empty table gives an empty result; other columns are
    not read.
    """
    marked = settle(
        fingerprints(documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), words),
        "simhash_fingerprints",
    )
    out = groups(marked, ["f0"], lambda fps: link_exact(fps, radius, blocks))
    return out.select("doc_id", F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id")


def _read_sets(words: int):
    """Rows (node, root, set, n_bytes) of texts; a set is its sorted 64-bit hashes."""

    def run(batches):
        for whole in batches:
            for batch in slices(whole, 64):
                sets = [shingle_set(t, words).astype("<u8").tobytes() for t in batch.column("text").to_pylist()]
                columns = [batch.column("node"), batch.column("root"), pa.array(sets, pa.binary()), pa.array(map(len, sets), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["node", "root", "set", "n_bytes"])

    return run


def _near_lead(over: int, under: int):
    """Adds to (node, root, lead, set, lead_set) whether the two sets' similarity is over / under at least."""

    def run(batches):
        for batch in batches:
            near, lead_set, lead = [], None, None
            for s, b in zip(batch.column("set"), batch.column("lead_set")):
                s, b = np.frombuffer(s.as_buffer(), "<u8"), b.as_buffer()
                if lead_set is None or not lead_set.equals(b):
                    lead_set, lead = b, np.frombuffer(b, "<u8")
                if min(len(s), len(lead)) * under < max(len(s), len(lead)) * over:
                    near.append(False)
                else:
                    both = len(np.intersect1d(s, lead, assume_unique=True))
                    near.append(both * under >= (len(s) + len(lead) - both) * over)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("node", "root", "lead")], pa.array(near, pa.bool_())], ["node", "root", "lead", "near"])

    return run


def similar(sets: list[np.ndarray], over: int, under: int, columns: int = 4096) -> np.ndarray:
    """Which of sets of distinct hashes have a Jaccard similarity of over / under at least, for all pairs."""
    m, sizes = len(sets), np.array([len(x) for x in sets], np.int64)
    whole = np.concatenate(sets)
    _, at, uses = np.unique(whole, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(m), sizes)[uses[at] > 1]
    at = (np.cumsum(uses > 1) - 1)[at[uses[at] > 1]]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    both, last = np.zeros((m, m), np.int64), int(at[-1]) + 1 if len(at) else 0
    for lo in range(0, last, columns):
        part = slice(*np.searchsorted(at, [lo, lo + columns]))
        x = np.zeros((m, min(columns, last - lo)), np.float32)
        x[row[part], at[part] - lo] = 1
        both += (x @ x.T).astype(np.int64)
    return both * under >= (sizes[:, None] + sizes - both) * over


def _meet_sets(over: int, under: int):
    """Links (a, b) that connect what is connected by similar pairs among the rows (node, set) of a group."""

    def run(table: pa.Table) -> pa.Table:
        sets = [np.frombuffer(s.as_buffer(), "<u8") for s in table["set"]]
        near = similar(sets, over, under) | np.eye(len(sets), dtype=bool)
        label = np.arange(len(sets))
        while True:
            low = np.where(near, label, len(sets)).min(1)
            if (low == label).all():
                break
            label = low
        nodes, hung = table["node"].to_numpy(), np.flatnonzero(label != np.arange(len(sets)))
        return pa.table({"a": pa.array(nodes[hung], pa.int64()), "b": pa.array(nodes[label[hung]], pa.int64())})

    return run


def link_similar(texts: DataFrame, words: int, similarity: float, per_tile: int = SETS) -> DataFrame:
    """Links (a, b) that connect, of `texts` (node, root, text), all nodes of a root that pairs of at least this similarity connect.

    The similarity is that of the sets of shingles, compared exactly. First every node meets the root's least one;
    the nodes unlike it then meet all nodes of the root, in tiles of about `per_tile` sets, every two of them
    a task's group. So the work is linear where all resemble one text, and all pairs only where they do not.
    """
    ratio = Fraction(str(similarity))
    over, under = ratio.numerator, ratio.denominator
    sets = settle(texts.mapInArrow(_read_sets(words), "node long, root long, set binary, n_bytes long"), "simhash_sets")
    least = settle(sets.groupBy("root").agg(F.min("node").alias("lead")), "simhash_leads")
    leads = settle(least.withColumnRenamed("root", "_r").join(sets, (F.col("_r") == F.col("root")) & (F.col("lead") == F.col("node"))).select("root", "lead", F.col("set").alias("lead_set")), "simhash_lead_sets")
    paired = sets.join(leads, "root").select("node", "root", "lead", "set", "lead_set")
    told = settle(paired.mapInArrow(_near_lead(over, under), "node long, root long, lead long, near boolean"), "simhash_near_lead")
    links = told.where("near and node <> lead").select(F.col("node").alias("a"), F.col("lead").alias("b"))
    rest = told.join(sets.select("node", "n_bytes"), "node").groupBy("root").agg(
        *[F.expr(f"greatest(ceil(count_if({w}) / {per_tile}), ceil(coalesce(sum(n_bytes) filter (where {w}), 0) / {SET_BYTES}))").alias(n) for n, w in (("far", "not near"), ("close", "near"))],
        F.count("*").alias("n"),
    )
    rest = settle(rest.where("far > 0 and n > 2").drop("n"), "simhash_far")
    dealt = told.drop("lead").join(rest, "root").withColumn("tile", F.expr("if(near, far + pmod(xxhash64(node), close), pmod(xxhash64(node), far))"))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0L, if(near, far, far + close) - 1)"))).where("other <> tile")
    dealt = dealt.select("node", F.xxhash64("root", F.least("tile", "other"), F.greatest("tile", "other")).alias("k"))
    met = dealt.join(sets.select("node", "set"), "node").groupBy("k").applyInArrow(_meet_sets(over, under), "a long, b long")
    return settle(links.unionByName(met).distinct(), "simhash_similar")


def near_dedup(
    documents: DataFrame,
    words: int = 5,
    similarity: float = 0.8,
    width: int = WIDTH,
    keys: int = KEYS,
    key_bits: int = KEY_BITS,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """The rows of `documents` that stay, one of each near-duplicate group: the one with the smallest id.

    A text is its set of word shingles; equal sets are one node, and sets of at least `similarity`
    (Jaccard) are linked. Candidates come from fingerprints of `width` bits within `radius_for` bits.
    No choice of blocks brings together all pairs so far apart, so `keys` drawn choices of 4-bit blocks,
    `key_bits` bits each, are joined on; the share of pairs found at each similarity is in the README.
    What candidates connect is then compared set by set, so no pair below the similarity is linked.
    Null and wordless texts are one node. Of rows that repeat an id in a group one stays; a row
    without an id stays only if all of its group lack one.
    """
    radius = radius_for(similarity, width)
    masks = wide_masks(width, keys, key_bits)
    names = [f"f{k}" for k in range(width // 64)]
    keyed = documents.select(whole_row(documents).alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    keyed = keyed.withColumn("key", row_digest(F.col("row")))
    slim = keyed.select("key", "doc_id", "text")
    marked = settle(set_fingerprints(slim, words, width), "simhash_wide")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("best")
    # Nodes are numbered, for sets are told apart by a digest that links need not carry.
    nodes = marked.groupBy("set_digest", *names).agg(best).drop("set_digest")
    nodes = settle(nodes.withColumn("id", F.xxhash64(*names)).withColumn("node", F.monotonically_increasing_id()), "simhash_nodes")
    roots = components(link_wide(nodes.select("id", *names).distinct(), radius, *masks)).withColumnRenamed("node", "_n")
    placed = nodes.join(roots, F.col("id") == F.col("_n"), "left").select("node", "best", F.coalesce("root", "id").alias("root"))
    placed = settle(placed, "simhash_candidates")
    # Written, so that the join's sides are plain shuffles and a hot root can be split.
    several = settle(placed.groupBy("root").agg(F.count("*").alias("n")).where("n > 1").select("root"), "simhash_several")
    live = placed.join(several, "root").select("node", "root", F.col("best.key").alias("key"))
    texts = slim.select("key", "text").join(live, "key").dropDuplicates(["node"]).select("node", "root", "text")
    groups_of = components(link_similar(texts, words, similarity)).select(F.col("node").alias("_n"), F.col("root").alias("group"))
    kept = nodes.join(groups_of, F.col("node") == F.col("_n"), "left").groupBy(F.coalesce("group", "node").alias("group")).agg(F.min("best").alias("best"))
    first = kept.select(F.col("best.key").alias("_key"))
    held = keyed.select("row", "key").join(first, F.col("key") == F.col("_key"), "left_semi")
    return held.dropDuplicates(["key"]).select("row.*")
