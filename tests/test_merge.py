import random

import pytest

from tests.conftest import rows
from tidemark.operators.merge import MergeTable, assert_unique, latest_per_key, merge, repeated_keys

KIND = "id int, v string, operation string"


def some(n, seed, keys=30):
    r = random.Random(seed)
    ids = [None, *r.sample(range(keys), min(n, keys))][: n + 1]
    return [(i, r.choice("abc"), r.choice(["u", "d", "c", None])) for i in ids[:n]]


def expected(target, source, tombstones):
    hit = {s[0]: s for s in source if s[0] is not None}
    have = {t[0] for t in target if t[0] is not None}
    out = [t for t in target if t[0] is None or t[0] not in hit]
    for s in source:
        matched = s[0] is not None and s[0] in have
        if s[2] == "d" and (matched or tombstones == "ignore"):
            continue
        out.append(s)
    return sorted(out, key=str)


@pytest.mark.parametrize("plan", ["outer", "broadcast", "auto"])
@pytest.mark.parametrize("tombstones", ["insert", "ignore"])
@pytest.mark.parametrize(("n", "m"), [(20, 15), (0, 10), (10, 0)])
def test_against_brute_force(spark, plan, tombstones, n, m):
    t, s = some(n, 1), some(m, 2)
    got = merge(spark.createDataFrame(t, KIND), spark.createDataFrame(s, KIND), tombstones=tombstones, plan=plan)
    assert rows(got) == expected(t, s, tombstones)


@pytest.mark.parametrize("plan", ["outer", "broadcast"])
def test_guard(spark, plan):
    kind = "id int, batch_id string, operation string"
    t = spark.createDataFrame([(1, "a", "u"), (2, "a", "u"), (3, None, "u"), (4, "x", "u")], kind)
    s = spark.createDataFrame([(1, "a", "u"), (2, "b", "u"), (3, "b", "u"), (4, "b", "d")], kind)
    # the same batch, or a null one, does not match: the source row is inserted beside it
    assert rows(merge(t, s, guard="batch_id", plan=plan)) == sorted([(1, "a", "u"), (1, "a", "u"), (2, "b", "u"), (3, None, "u"), (3, "b", "u")], key=str)


@pytest.mark.parametrize("plan", ["outer", "broadcast"])
def test_columns_of_one_side_and_odd_names(spark, plan):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id int, `a.b` string, t int")
    s = spark.createDataFrame([(2, "z", "u", 9), (3, "y", "u", 8)], "id int, `a.b` string, operation string, s int")
    assert rows(merge(t, s, plan=plan), "id", "`a.b`", "t", "s") == [(1, "a", 1, None), (2, "z", None, 9), (3, "y", None, 8)]


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 5), (1, "z", 3), (None, "x", 1), (None, "y", 2), (2, "q", None)], "id int, v string, key_rank int")
    assert rows(latest_per_key(df, "id", ("key_rank",)), "id", "v") == [(1, "a"), (2, "q"), (None, "y")]


def test_source_must_be_unique(spark):
    df = spark.createDataFrame([(1, "a", "u"), (1, "b", "u"), (None, "a", "u"), (None, "b", "u")], KIND)
    assert rows(repeated_keys(df)) == [(1, 2)]
    with pytest.raises(ValueError):
        assert_unique(df)
    assert_unique(df.limit(0))


def test_batches_are_taken_once_and_equal_a_replay(spark, at):
    t = MergeTable(spark, at, buckets=4)
    state: list = []
    for n in range(4):
        batch = some(12, n + 10)
        df = spark.createDataFrame(batch, KIND)
        for _ in range(2):
            t.merge_batch(df, n, offsets={"t/0": n})
        state = expected(state, batch, "insert")
    assert rows(t.rows()) == state
    assert t.offsets() == {"t/0": 3}
    t.merge_batch(spark.createDataFrame(some(12, 99), KIND), 2)  # an old number
    assert rows(t.rows()) == state


def test_a_batch_that_died_leaves_the_old_version(spark, at, monkeypatch):
    t = MergeTable(spark, at, buckets=4)
    t.merge_batch(spark.createDataFrame([(1, "a", "u")], KIND), 0)
    monkeypatch.setattr(t.table, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        t.merge_batch(spark.createDataFrame([(1, "b", "u")], KIND), 1)
    monkeypatch.undo()
    assert rows(t.rows(), "v") == [("a",)]
    t.merge_batch(spark.createDataFrame([(1, "b", "u")], KIND), 1)
    assert rows(t.rows(), "v") == [("b",)]


def test_a_growing_table_doubles_its_buckets(spark, at):
    t = MergeTable(spark, at, buckets=1, bucket_rows=10)
    state: list = []
    for n in range(4):
        batch = some(12, n + 10, keys=100)
        m = t.merge_batch(spark.createDataFrame(batch, KIND), n)
        state = expected(state, batch, "insert")
    assert rows(t.rows()) == state and m["properties"]["buckets"] >= 4 and len(m["parts"]) > 1


def test_two_writers_both_count(spark, at):
    one, two = MergeTable(spark, at, buckets=2), MergeTable(spark, at, buckets=2)
    real, calls = one.table.write_part, []

    def late(df, *by, **kw):
        if not calls:
            calls.append(1)
            two.merge_batch(spark.createDataFrame([(2, "b", "u")], KIND), 0, "two")
        return real(df, *by, **kw)

    one.table.write_part = late
    one.merge_batch(spark.createDataFrame([(1, "a", "u")], KIND), 0, "one")
    assert rows(one.rows(), "id") == [(1,), (2,)] and one.table.manifest()["properties"]["last"] == {"one": 0, "two": 0}
