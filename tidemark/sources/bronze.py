"""Bronze: incremental windows, date-partitioned Parquet, audit rows and checksums."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.schemas import bronze_schema

EPOCH = datetime(1970, 1, 1)
AUDIT_KEYS = ["run_id", "entity", "dt"]


def extract_window(
    source: DataFrame, after: datetime | date, until: datetime | date, watermark: str = "updated_at"
) -> DataFrame:
    """Rows changed in (after, until]. No sort: the order is not kept by a parallel write."""
    c = F.col(watermark)
    return source.where((c > F.lit(after)) & (c <= F.lit(until)))


def jdbc_predicates(after: datetime, until: datetime, slices: int, watermark: str = "updated_at") -> list[str]:
    """Cuts (after, until] into ranges, one per reading task, for `spark.read.jdbc(predicates=...)`."""
    step = (until - after) / slices
    cuts = [after + step * i for i in range(slices)] + [until]
    return [f"{watermark} > TIMESTAMP '{lo}' AND {watermark} <= TIMESTAMP '{hi}'" for lo, hi in zip(cuts, cuts[1:])]


def read_jdbc_window(
    spark: SparkSession, url: str, table: str, after: datetime, until: datetime, slices: int = 16, **properties: str
) -> DataFrame:
    """Parallel window scan of an OLTP table; every slice sends its own range to the database."""
    return spark.read.jdbc(url, table, predicates=jdbc_predicates(after, until, slices), properties=properties)


def watermark_lookup(audit: DataFrame, entities: list[str], before: date | None = None) -> DataFrame:
    """Last watermark per entity; the epoch for an entity never ingested.

    `before` ignores runs of that day and later, so that repeating a day reads its whole window.
    """
    if before is not None:
        audit = audit.where(F.col("dt") < F.lit(before))
    listed = audit.sparkSession.createDataFrame([(e,) for e in entities], "entity string")
    latest = audit.groupBy("entity").agg(F.max("watermark").alias("watermark"))
    return listed.join(latest, "entity", "left").select(
        "entity", F.coalesce(F.col("watermark").cast("timestamp"), F.lit(EPOCH)).alias("watermark")
    )


def audit_of(bronze: DataFrame, entity: str) -> DataFrame:
    """Audit rows (run_id, entity, dt, rows_read, watermark) of what a Bronze entity holds."""
    return bronze.groupBy("dt").agg(
        F.count(F.lit(1)).alias("rows_read"), F.max(F.col("updated_at").cast("timestamp")).alias("watermark")
    ).select(
        F.concat(F.lit("run-"), F.date_format("dt", "yyyyMMdd")).alias("run_id"),
        F.lit(entity).alias("entity"),
        "dt",
        "rows_read",
        "watermark",
    )


def audit_rollup(audit: DataFrame) -> DataFrame:
    return audit.groupBy("entity").agg(F.max("dt").alias("last_dt"), F.sum("rows_read").alias("rows_read"))


def audit_latest(audit: DataFrame, n: int = 5) -> DataFrame:
    return audit.orderBy(F.desc("dt"), "entity").limit(n)


def as_declared(df: DataFrame, entity: str) -> DataFrame:
    """The entity's declared columns in their declared types, plus `dt`."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in bronze_schema(entity).fields])


def write_partitions(df: DataFrame, path: str, partition: str = "dt") -> None:
    """Replaces exactly the partitions present in `df`; a second run changes nothing.

    A partition `df` has no row for is left as it is.

    The rebalance gathers each partition's rows into few files, and AQE splits a partition that is
    too large for one task.
    """
    (
        df.hint("rebalance", F.col(partition))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def scan(spark: SparkSession, path: str, entity: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """Hive-partitioned scan with a declared schema; `first` and `last` prune `dt` folders."""
    df = spark.read.schema(bronze_schema(entity)).parquet(path)
    if first is not None:
        df = df.where(F.col("dt") >= F.lit(first))
    if last is not None:
        df = df.where(F.col("dt") <= F.lit(last))
    return df


def with_path_date(df: DataFrame) -> DataFrame:
    """Adds `ingested_dt` read from the `dt=` folder in each row's file path."""
    found = F.regexp_extract(F.col("_metadata.file_path"), "dt=([0-9]{4}-[0-9]{2}-[0-9]{2})", 1)
    return df.withColumn("ingested_dt", F.to_date(F.nullif(found, F.lit(""))))


def file_stats(df: DataFrame, *by: str) -> DataFrame:
    """Rows, files and one sample path, in all or per `by`."""
    source = df.select(*by, F.col("_metadata.file_path").alias("path"))
    per_file = source.groupBy(*by, "path").agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy(*by).agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("files"), F.min("path").alias("sample_path")
    )


def file_checksums(spark: SparkSession, path: str) -> DataFrame:
    """First 32 hex digits of each file's SHA-256. A file must fit a task; see `content_checksum`."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return files.load(path).select("path", "length", F.substring(F.sha2("content", 256), 1, 32).alias("checksum"))


def content_checksum(df: DataFrame, *by: str) -> DataFrame:
    """Row count and an order-independent sum of row digests, in all or per `by`.

    Sums, unlike XOR, see repeated rows. The digest is a 32-bit md5 prefix over all other columns as
    text, timestamps as microseconds, so another engine can compute the same value.
    """
    kinds = dict(df.dtypes)
    plain = [
        F.unix_micros(F.col(c).cast("timestamp")) if kinds[c].startswith("timestamp") else F.col(c)
        for c in sorted(kinds)
        if c not in by
    ]
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("~")) for c in plain])
    digest = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return df.select(*by, digest.alias("_digest")).groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("_digest").alias("checksum")
    )
