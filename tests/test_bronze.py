from datetime import date, datetime

from pyspark.sql import functions as F

from tidemark.schemas import DDL
from tidemark.sources import bronze
from tidemark.sources.adapter import Bronze
from tidemark.streaming.bronze_stream import stream_upsert

SF = "/root/testdata/sf0.001"


def timed(spark, table):
    return spark.createDataFrame(table, "k int, updated_at timestamp, dt date")


def test_window_is_open_left_and_closed_right(spark, rows):
    lo, hi = datetime(2024, 1, 1), datetime(2024, 1, 2)
    df = timed(spark, [(1, lo, None), (2, datetime(2024, 1, 1, 0, 0, 1), None), (3, hi, None), (4, datetime(2024, 1, 2, 0, 0, 1), None), (5, None, None)])
    assert rows(bronze.extract_window(df, lo, hi), "k") == [(2,), (3,)]


def test_jdbc_slices_cover_the_window_once():
    lo, hi = datetime(2024, 1, 1), datetime(2024, 1, 2)
    parts = bronze.jdbc_predicates(lo, hi, 4)
    assert len(parts) == 4
    assert parts[0] == "updated_at > TIMESTAMP '2024-01-01 00:00:00' AND updated_at <= TIMESTAMP '2024-01-01 06:00:00'"
    ends = [p.split("TIMESTAMP ")[2] for p in parts]
    starts = [p.split("TIMESTAMP ")[1].split(" AND")[0] for p in parts]
    assert starts[1:] == ends[:-1] and ends[-1] == "'2024-01-02 00:00:00'"


def test_watermark_falls_back_and_skips_the_repeated_day(spark, rows):
    audit = spark.createDataFrame(
        [("orders", date(2024, 1, 1), datetime(2024, 1, 1, 8)), ("orders", date(2024, 1, 2), datetime(2024, 1, 2, 8))],
        "entity string, dt date, watermark timestamp",
    )
    assert rows(bronze.watermark_lookup(audit, ["orders", "new"])) == [("new", datetime(1970, 1, 1)), ("orders", datetime(2024, 1, 2, 8))]
    assert rows(bronze.watermark_lookup(audit, ["orders"], before=date(2024, 1, 2))) == [("orders", datetime(2024, 1, 1, 8))]


def test_partition_write_replaces_only_its_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "b")
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    bronze.write_partitions(timed(spark, [(1, None, d1), (2, None, d2)]), path)
    bronze.write_partitions(timed(spark, [(3, None, d2)]), path)
    bronze.write_partitions(timed(spark, [(3, None, d2)]), path)
    assert rows(spark.read.parquet(path), "k", "dt") == [(1, d1), (3, d2)]


def test_scan_prunes_partitions_and_types_dt(spark, tmp_path):
    path = str(tmp_path / "p")
    products = Bronze(spark, SF).products()
    bronze.write_partitions(products, path)
    one = bronze.scan(spark, path, "products", date(2001, 7, 20), date(2001, 7, 20))
    assert one.schema["dt"].dataType.simpleString() == "date"
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert one.count() == products.where(F.col("dt") == F.lit(date(2001, 7, 20))).count() > 0
    assert len(one.inputFiles()) >= 1


def test_every_entity_lands_in_its_declared_types(spark, tmp_path):
    b = Bronze(spark, SF)
    for entity, declared in DDL.items():
        path = str(tmp_path / entity)
        small = bronze.as_declared(b.entity(entity), entity).where(F.crc32(F.col("dt").cast("string")) % 50 == 0)
        bronze.write_partitions(small, path)
        back = bronze.scan(spark, path, entity)
        assert back.columns == [c.split()[0] for c in declared.split(", ")] + ["dt"]
        assert bronze.content_checksum(back).first() == bronze.content_checksum(small).first()


def test_path_date(spark, tmp_path, rows):
    path = str(tmp_path / "l")
    bronze.write_partitions(timed(spark, [(1, None, date(2024, 1, 1))]), path)
    assert rows(bronze.with_path_date(spark.read.schema("k int").parquet(path)), "k", "ingested_dt") == [(1, date(2024, 1, 1))]


def test_file_stats_and_checksums(spark, tmp_path):
    path = str(tmp_path / "s")
    bronze.write_partitions(timed(spark, [(i, None, date(2024, 1, 1 + i % 2)) for i in range(6)]), path)
    whole = bronze.file_stats(spark.read.parquet(path)).first()
    assert (whole["rows"], whole.files) == (6, 2) and "dt=2024-01-01" in whole.sample_path
    sums = bronze.file_checksums(spark, path).collect()
    assert len(sums) == 2 and all(len(r.checksum) == 32 for r in sums)


def test_content_checksum_ignores_order_but_not_copies(spark):
    a = timed(spark, [(1, None, None), (2, None, None)])
    b = timed(spark, [(2, None, None), (1, None, None)])
    assert bronze.content_checksum(a).first() == bronze.content_checksum(b).first()
    assert bronze.content_checksum(a.union(a)).first() != bronze.content_checksum(a).first()
    twice = bronze.content_checksum(a.union(b)).first().checksum
    assert twice == 2 * bronze.content_checksum(a).first().checksum


def test_stream_takes_each_file_once_and_late_files_do_not_win(spark, tmp_path, rows):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "k int, v string, p string, updated_at date, dt date"

    def land(*table):
        bronze.write_partitions(spark.createDataFrame(list(table), schema), source)

    def run():
        stream_upsert(spark, source, spark.createDataFrame([], schema).schema, target, state, ["k"], ["updated_at", "dt"], "p")
        return rows(spark.read.schema(schema).parquet(target), "k", "v", "p")

    d = [date(2024, 1, i) for i in range(1, 5)]
    land((1, "a", "x", d[1], d[1]), (2, "b", "x", d[1], d[1]))
    assert run() == [(1, "a", "x"), (2, "b", "x")]
    land((1, "old", "y", d[0], d[0]), (2, "new", "y", d[2], d[2]), (3, "c", "x", d[2], d[2]))
    assert run() == [(1, "a", "x"), (2, "new", "y"), (3, "c", "x")]
    assert run() == [(1, "a", "x"), (2, "new", "y"), (3, "c", "x")]
