"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

The presence of an n-gram in a text is a feature, worth the log ratio of the n-gram's rates among toxic
and other texts; a logistic fit learns a weight for each. N-grams are hashed. Counts are summed per
hash block over the labelled sample; the fit uses the n-grams whose rates surely differ.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import settle, slices, uniform
from tidemark.llm.ngrams import code_points, logistic, present, sigmoid

ORDERS = (3, 4, 5)
BITS = 20
BLOCK = 1 << 12
SAMPLE = 4000  # labelled texts of a class that the fit reads, about
FEATURES = 1 << 14
SMOOTH = 0.5
SURE = 5.0  # standard deviations that an n-gram's rates must be apart
PENALTY = 1e-3


def _counts(batches):
    """Numbers of toxic and other texts with each n-gram, over a partition, in blocks of buckets."""
    total = np.zeros((2, 1 << BITS), np.int64)
    for whole in batches:
        for batch in slices(whole, 128):
            points, ends = code_points(batch.column("text").to_pylist())
            label = batch.column("label").to_numpy()
            text, bucket = present(points, ends, ORDERS, BITS)
            for k in (0, 1):
                total[k] += np.bincount(bucket[label[text] == k], minlength=1 << BITS)
    for at in range(0, 1 << BITS, BLOCK):
        part = total[:, at : at + BLOCK]
        if part.any():
            yield pa.RecordBatch.from_pydict({"block": [at], "counts": [part.tobytes()]}, pa.schema([("block", pa.int32()), ("counts", pa.binary())]))


def _telling(sizes: tuple[int, int]):
    """(bucket, ratio, z) of a block: log ratio of smoothed rates, and how sure their difference is."""

    def run(table: pa.Table) -> pa.Table:
        counts = sum(np.frombuffer(c, np.int64).reshape(2, -1) for c in table["counts"].to_pylist())
        other, toxic = counts
        n0, n1 = sizes
        ratio = np.log((toxic + SMOOTH) / (n1 + 2 * SMOOTH)) - np.log((other + SMOOTH) / (n0 + 2 * SMOOTH))
        rate = (toxic + other + SMOOTH) / (n0 + n1 + 2 * SMOOTH)
        z = np.abs(toxic / n1 - other / n0) / np.sqrt(rate * (1 - rate) * (1 / n0 + 1 / n1) + 1e-12)
        some = np.flatnonzero((toxic + other > 2) & (z > SURE))
        block = table["block"][0].as_py()
        return pa.table({"bucket": pa.array(some + block, pa.int32()), "ratio": ratio[some], "z": z[some]})

    return run


def _features(wanted: np.ndarray):
    def run(batches):
        for whole in batches:
            for batch in slices(whole, 128):
                points, ends = code_points(batch.column("text").to_pylist())
                text, bucket = present(points, ends, ORDERS, BITS, wanted)
                cuts = np.searchsorted(text, np.arange(batch.num_rows + 1))
                blobs = [bucket[a:b].astype(np.int32).tobytes() for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(blobs, pa.binary())], ["doc_id", "label", "buckets"])

    return run


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES) -> tuple[np.ndarray, float]:
    """(weight of each bucket, bias) from texts (doc_id, text) and labels (doc_id, label).

    Labels other than 0 and 1, and labels without a text, are left out. About `sample` texts of each
    class are read, chosen by a hash of the id: so few labels are broadcast to the scan, and no text
    is shuffled. What comes to the driver is bounded by `features` and by the sample's presence lists.
    With no or one class all weights are 0 and the bias gives the smoothed share of label 1.
    """
    weights = np.zeros(1 << BITS)
    labels = labels.where("doc_id is not null and label in (0, 1)").select("doc_id", F.col("label").cast("int").alias("label"))
    sizes = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
    if len(sizes) < 2:
        n1, n = sizes.get(1, 0), sum(sizes.values())
        return weights, float(np.log((n1 + 1) / (n - n1 + 1)))
    share = F.when(F.col("label") == 1, min(1.0, sample / sizes[1])).otherwise(min(1.0, sample / sizes[0]))
    # An id or a row that is repeated counts once, so the sample keeps its bound.
    few = labels.where(uniform(F.lit(8), "doc_id") < share).distinct()
    chosen = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(few), "doc_id")
    chosen = settle(chosen.dropDuplicates(["doc_id", "text", "label"]), "toxicity_sample")
    read = {r["label"]: r["count"] for r in chosen.groupBy("label").count().collect()}
    if len(read) < 2:
        return weights, float(np.log((sizes[1] + 1) / (sizes[0] + 1)))
    counts = chosen.mapInArrow(_counts, "block int, counts binary")
    told = counts.groupBy("block").applyInArrow(_telling((read[0], read[1])), "bucket int, ratio double, z double")
    told = told.orderBy(F.desc("z"), "bucket").limit(features).toPandas()
    if told.empty:
        return weights, float(np.log((sizes[1] + 1) / (sizes[0] + 1)))
    wanted = np.zeros(1 << BITS, bool)
    wanted[told["bucket"]] = True
    rows = chosen.mapInArrow(_features(wanted), "doc_id long, label int, buckets binary").toPandas()
    rows = rows.sort_values(["doc_id", "label"]).reset_index(drop=True)
    held = [np.frombuffer(b, np.int32) for b in rows["buckets"]]
    row = np.repeat(np.arange(len(held), dtype=np.int32), [len(h) for h in held])
    bucket = np.concatenate(held)
    ratio = np.zeros(1 << BITS)
    ratio[told["bucket"]] = told["ratio"]
    place = np.zeros(1 << BITS, np.int32)
    place[told["bucket"]] = np.arange(len(told))
    w, bias = logistic(row, place[bucket], ratio[bucket], rows["label"].to_numpy(np.float64), len(told), PENALTY)
    weights[told["bucket"]] = w * told["ratio"].to_numpy()
    # The sample takes other shares of the classes than all labelled rows have.
    bias += float(np.log(sizes[1] / read[1]) - np.log(sizes[0] / read[0]))
    return weights, bias


def _score(shared, others):
    def run(batches):
        buckets, values, bias = shared.value
        wanted = np.zeros(1 << BITS, bool)
        wanted[buckets] = True
        weights = np.zeros(1 << BITS, np.float64)
        weights[buckets] = values
        for whole in batches:
            for batch in slices(whole, 64):
                points, ends = code_points(batch.column("text").to_pylist())
                text, bucket = present(points, ends, ORDERS, BITS, wanted)
                total = np.bincount(text, weights[bucket], batch.num_rows) + bias
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], pa.array(sigmoid(total))], [*others, "score"])

    return run


def score(documents: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """All columns of `documents` but `text`, and score: the probability of label 1.

    A null or empty text has no feature and gets the score of the bias. Whole texts are read; an empty
    table gives an empty result.
    """
    weights, bias = model
    others = [c for c in documents.columns if c != "text"]
    kinds = dict(documents.dtypes)
    at = np.flatnonzero(weights)
    shared = documents.sparkSession.sparkContext.broadcast((at, weights[at], bias))
    return documents.mapInArrow(_score(shared, others), ", ".join([*[f"`{c}` {kinds[c]}" for c in others], "score double"]))
