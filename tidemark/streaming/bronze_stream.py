"""Bronze files as a stream, upserted into a Gold table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.operators.merge import merge_latest
from tidemark.session import scratch_scope, settle
from tidemark.sources.tables import upsert


def stream_upsert(
    spark: SparkSession,
    source: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[str],
    partition: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    max_files: int = 1000,
) -> None:
    """Processes every Bronze file not seen yet, then stops.

    A batch may be delivered twice after a failure and files may arrive in any order: the merge
    keeps the newest row per key by `order`, so both leave the table unchanged.
    """
    merge = partial(merge_latest, keys=list(keys), order=list(order))

    def apply(batch: DataFrame, _batch_id: int) -> None:
        with scratch_scope(spark):  # the batch is read three times: key lookup, partition names, merge
            upsert(settle(transform(batch), "stream-batch"), target, keys, partition, merge)

    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source)
    query = (
        files.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
