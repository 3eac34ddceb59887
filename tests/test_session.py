import pytest

from tidemark import session
from tidemark.sources.files import Files


class Elsewhere:
    """A session on a cluster without a shared folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "yarn"


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError):
        session.checkpoint_root(Elsewhere)


def test_scratch_lies_in_the_checkpoint_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = (session.scratch_path(spark, "x") for _ in range(2))
    assert a != b and a.startswith(f"{root}/tidemark/")


def test_settle_writes_once(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "b")], "k int, v string")
    settled = session.settle(df, "t")
    assert rows(settled) == rows(df) and settled.schema == df.schema
    assert session.checkpoint_root(spark) in settled.inputFiles()[0]
    empty = session.settle(df.limit(0), "none")
    assert empty.count() == 0 and empty.columns == ["k", "v"]


def test_clear_scratch(spark):
    folder = session.settle(spark.range(3).toDF("k"), "gone").inputFiles()[0].rsplit("/", 1)[0]
    assert Files(spark, folder).exists(folder)
    session.clear_scratch(spark)
    assert not Files(spark, folder).exists(folder)


def test_a_scope_deletes_what_was_settled_inside(spark):
    from tidemark.session import scratch_scope, settle
    from tidemark.sources.files import Files

    outer = settle(spark.range(3), "outer")
    with scratch_scope(spark):
        path = settle(spark.range(5), "inner").inputFiles()[0].rsplit("/", 1)[0]
        files = Files(spark, path)
        assert files.exists(path)
    assert not files.exists(path) and outer.count() == 3


def test_settle_in_rounds_writes_every_row_once(spark, rows):
    df = spark.createDataFrame([(i % 30 if i % 11 else None, f"v{i % 50}") for i in range(300)], "k int, v string").repartition(3)
    several = session.settle(df, "several", "k", 4)
    assert rows(several) == rows(df) and several.schema == df.schema
    assert rows(session.settle(df.limit(0), "none", "k", 4)) == []


def test_a_nested_empty_scope_leaves_the_outer_one(spark):
    with session.scratch_scope(spark):
        with session.scratch_scope(spark):
            pass
        path = session.settle(spark.range(5), "after").inputFiles()[0].rsplit("/", 1)[0]
        assert Files(spark, path).exists(path)
    assert not Files(spark, path).exists(path)


def test_settings_are_put_back(spark):
    before = {k: spark.conf.get(k, None) for k in session.LEAN}
    with session.settings(spark, session.LEAN):
        assert {k: spark.conf.get(k) for k in session.LEAN} == session.LEAN
    assert {k: spark.conf.get(k, None) for k in session.LEAN} == before
