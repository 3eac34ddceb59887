from datetime import date

from hypothesis import HealthCheck, given, settings, strategies as st

from tidemark.operators import merge

KV = "k int, v string"
FEW = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
PAIRS = st.lists(st.tuples(st.integers(0, 6), st.sampled_from("abc")), max_size=8)


def test_delete_insert_keeps_every_batch_row(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], KV)
    batch = spark.createDataFrame([(2, "x"), (2, "y"), (4, "z")], KV)
    once = merge.delete_insert(target, batch, ["k"])
    assert rows(once) == [(1, "a"), (2, "x"), (2, "y"), (3, "c"), (4, "z")]
    assert rows(merge.delete_insert(once, batch, ["k"])) == rows(once)


@FEW
@given(target=PAIRS, batch=PAIRS)
def test_upserts_are_idempotent(spark, rows, target, batch):
    t, b = spark.createDataFrame(target, KV), spark.createDataFrame(batch, KV)
    once = merge.delete_insert(t, b, ["k"])
    assert rows(merge.delete_insert(once, b, ["k"])) == rows(once)
    added = merge.insert_ignore(t, b, ["k"])
    assert rows(merge.insert_ignore(added, b, ["k"])) == rows(added)
    keys = [k for k, _ in rows(added)]
    assert {k for k, _ in target} | {k for k, _ in batch} == set(keys)
    latest = merge.merge_latest(t, b, ["k"], ["v"])
    assert dict(rows(latest)) == {k: max(v for x, v in target + batch if x == k) for k, _ in target + batch}


def test_insert_ignore_leaves_the_target_alone(spark, rows):
    target = spark.createDataFrame([(1, "a")], KV)
    batch = spark.createDataFrame([(1, "x"), (2, "y"), (2, "b")], KV)
    assert rows(merge.insert_ignore(target, batch, ["k"])) == [(1, "a"), (2, "y")]


def test_frames_of_keys_only(spark, rows):
    target, batch = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(1,), (2,), (2,)], "k int")
    assert rows(merge.insert_ignore(target, batch, ["k"])) == [(1,), (2,)]


def test_left_any_join_keeps_the_grain(spark, rows):
    left = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    right = spark.createDataFrame([(2, 0, "old"), (2, 1, "new"), (3, 0, "only")], "k int, cur int, v string")
    assert rows(merge.left_any_join(left, right, "k", ["cur"]), "k", "v") == [(1, None), (2, "new"), (3, "only")]


def test_dedup_latest_takes_the_later_dt_on_a_tie(spark, rows):
    day = date(2024, 1, 1)
    df = spark.createDataFrame(
        [(1, "a", day, day), (1, "b", day, date(2024, 1, 2)), (2, "c", day, day), (2, "c", day, day)],
        "k int, v string, updated_at date, dt date",
    )
    assert rows(merge.dedup_latest(df, ["k"]), "k", "v") == [(1, "b"), (2, "c")]


def test_orphans_ignore_null_keys_and_count_rows(spark, rows):
    fact = spark.createDataFrame([(1,), (9,), (9,), (None,)], "fk int")
    dim = spark.createDataFrame([(1,), (1,)], "pk int")
    assert rows(merge.orphans(fact, "fk", dim, "pk")) == [(9, 2)]


def test_semi_and_anti_split_the_left_side(spark, rows):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], KV)
    right = spark.createDataFrame([(1, "x"), (1, "y")], KV)
    assert rows(merge.with_match(left, right, ["k"])) == [(1, "a"), (1, "b")]
    assert rows(merge.without_match(left, right, ["k"])) == [(2, "c"), (None, "d")]


def test_keep_recent_includes_the_limit_day(spark, rows):
    df = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 2),)], "d date")
    assert rows(merge.keep_recent(df, "d", date(2024, 1, 31), 29)) == [(date(2024, 1, 2),)]
