"""Session settings, the shared scratch folder and intermediate tables in it."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

# AQE sizes shuffle partitions from real bytes, splits skewed join sides and rebalanced write
# partitions, and swaps in a broadcast only after it has measured the side. The broadcast threshold
# stays at Spark's default: file sizes are compressed, so a larger one would ship far more memory.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    # Python call sites in error messages cost several JVM round trips per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library defaults; `conf` keys use `__` for `.`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.

    Only a local session may go without one; there the warehouse folder serves.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder for one run of `name` under the shared root."""
    app = spark.sparkContext.applicationId
    return f"{checkpoint_root(spark)}/tidemark/{app}/{name}-{uuid.uuid4().hex[:12]}"


#: Shuffle files go when the job that made them ends, not when the driver collects its garbage.
LEAN = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Sets `values` and puts the settings before them back at the end."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


_SCOPES: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession):
    """Deletes, at its end, the tables settled inside; for jobs whose results do not read them."""
    from tidemark.sources.files import Files

    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        _SCOPES[:] = [scope for scope in _SCOPES if scope is not made]  # an outer one may be equal
        for path in made:
            Files(spark, path).delete(path)


def settle(df: DataFrame, name: str, by: str | None = None, rounds: int = 1) -> DataFrame:
    """Writes `df` to the shared folder and returns the written table. Runs a job.

    For a frame that is read several times: the work behind it runs once, a lost executor costs a
    re-read instead of a recomputation, and later plans know its size. With `rounds`, the rows are
    written one share of the values of column `by` after another: `df` is computed for each, and has
    to give the same rows every time, but only a share of them is shuffled at once.
    """
    path = scratch_path(df.sparkSession, name)
    if _SCOPES:
        _SCOPES[-1].append(path)
    for i in range(rounds):
        part = df.where(F.pmod(F.xxhash64(by), F.lit(rounds)) == i) if rounds > 1 else df
        part.write.mode("append" if i else "error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Deletes this application's scratch tables; call it when no result reads them any more."""
    from tidemark.sources.files import Files

    root = f"{checkpoint_root(spark)}/tidemark/{spark.sparkContext.applicationId}"
    Files(spark, root).delete(root)
