import random
from datetime import datetime, timedelta

import pytest

from tests.conftest import rows
from tidemark.operators.changes import ChangeTable

KIND = "topic string, partition int, offset bigint, id int, name string, operation string, processing_time timestamp, batch_id string, `odd name` string"
T0 = datetime(2025, 1, 1)


def some(n, seed):
    """Changes of few items, delivered once or more, in any order, at few times."""
    r, out = random.Random(seed), []
    for o in range(n):
        m = (r.choice("tu"), r.randrange(2), o // 2)
        x = random.Random(str(m))
        op, key = x.choice(["u", "U ", "c", " d", "D", None]), x.choice([None, *range(8)])
        for _ in range(r.choice([1, 1, 2, 3])):
            out.append((*m, key, x.choice(["a", "b", None]), op, r.choice([None, *[T0 + timedelta(seconds=s) for s in range(12)]]), r.choice(["p", "q", None]), None))
    r.shuffle(out)
    return out


def expected(data):
    first = {}
    for t, p, o, i, _, op, at, *_ in data:
        if i is not None and at is not None:
            k = (t, p, o, i)
            first[k] = (min(at, first[k][0]) if k in first else at, op)
    best = {}
    for (t, p, o, i), (at, op) in first.items():
        if i not in best or (at, o, t, p) > best[i][0]:
            best[i] = ((at, o, t, p), op)
    return sorted(((i, t, p, o) for i, ((_, o, t, p), op) in best.items() if (op or "").strip().lower() != "d"), key=str)


@pytest.mark.parametrize(("runs", "split"), [(1, 1_000_000), (3, 1_000_000), (3, 4)])
def test_any_split_into_runs_gives_the_same(spark, at, runs, split):
    data = some(120, 5)
    t = ChangeTable(spark, at, buckets=4, split_rows=split)
    for i in range(runs):
        t.apply(spark.createDataFrame(data[i::runs], KIND), batch=f"run-{i}")
        t.apply(spark.createDataFrame(data[i::runs], KIND), batch=f"run-{i}")  # again: nothing
    assert rows(t.current(), "id", "topic", "partition", "offset") == expected(data)


def test_buckets_split_as_they_grow(spark, at):
    data = [(t, p, o, i, n, op, at_, b, x) for t, p, o, i, n, op, at_, b, x in some(200, 6)]
    data += [("t", 0, 1000 + i, 100 + i, "n", "u", T0 + timedelta(seconds=i % 5), "b", None) for i in range(200)]
    random.Random(1).shuffle(data)
    t = ChangeTable(spark, at, buckets=1, bucket_rows=40, split_rows=15)
    sizes = []
    for i in range(4):
        m = t.apply(spark.createDataFrame(data[i::4], KIND), batch=f"run-{i}")
        sizes.append(len(m["properties"]["buckets"]))
    assert sizes[0] > 1 and sizes == sorted(sizes) and sizes[-1] > sizes[0]
    leaves = [tuple(map(int, x.split("-"))) for x in m["properties"]["buckets"]]
    assert sum(2.0**-d for d, _ in leaves) == 1  # every hash has exactly one bucket
    assert rows(t.current(), "id", "topic", "partition", "offset") == expected(data)


def test_a_lost_commit_is_applied_again(spark, at):
    one, two = ChangeTable(spark, at, buckets=2), ChangeTable(spark, at, buckets=2)
    row = lambda o, i: ("t", 0, o, i, "n", "u", T0, "b", None)
    one.apply(spark.createDataFrame([row(0, 0)], KIND))
    real, calls = one.table.write_part, []

    def late(df, *by, **kw):
        if not calls:
            calls.append(1)
            two.apply(spark.createDataFrame([row(1, 1)], KIND), batch="two")
        return real(df, *by, **kw)

    one.table.write_part = late
    one.apply(spark.createDataFrame([row(2, 2)], KIND), batch="one")
    assert rows(one.current(), "id") == [(0,), (1,), (2,)]
    assert one.table.manifest()["properties"]["batches"] == ["two", "one"]


def test_payload_is_that_of_the_deciding_message(spark, at):
    row = lambda o, name, s, op="u": ("t", 0, o, 1, name, op, T0 + timedelta(seconds=s), "b", "x")
    t = ChangeTable(spark, at, buckets=2)
    t.apply(spark.createDataFrame([row(1, "old", 1), row(2, "new", 5)], KIND))
    t.apply(spark.createDataFrame([row(1, "old", 9)], KIND))  # an old message delivered again, late
    assert rows(t.current(), "name") == [("new",)]
    t.apply(spark.createDataFrame([row(3, "gone", 7, "d")], KIND))
    assert t.current().count() == 0
    t.apply(spark.createDataFrame([row(4, "late", 6)], KIND))  # older than the delete
    assert t.current().count() == 0
    assert rows(t.current(2), "name") == [("new",)]  # versions stay readable


def test_untouched_buckets_are_carried_over(spark, at):
    t = ChangeTable(spark, at, buckets=8)
    t.apply(spark.createDataFrame([("t", 0, i, i, "n", "u", T0, "b", None) for i in range(64)], KIND))
    before = t.table.manifest()["parts"]
    t.apply(spark.createDataFrame([("t", 0, 100, 7, "n", "u", T0, "b", None)], KIND))
    after = t.table.manifest()["parts"]
    assert len(before) == 8 and sum(before[k] != after[k] for k in before) == 1  # the heads of one bucket
    assert t.current().count() == 64


def test_hot_key_and_hot_message(spark, at):
    hot = spark.range(60_000).selectExpr("'t' AS topic", "0 AS partition", "IF(id % 2 = 0, 7, id) AS offset", "IF(id % 2 = 0, 1, CAST(id % 100 AS INT)) AS id", "'n' AS name", "'u' AS operation", "timestamp_seconds(id) AS processing_time", "'b' AS batch_id")
    t = ChangeTable(spark, at, buckets=4, split_rows=5_000)
    t.apply(hot)
    got = rows(t.current(), "id", "offset")
    want = sorted([(i, 59_900 + i) for i in range(1, 100, 2)], key=str)
    assert got == want


def test_empty_tables_and_clashing_names(spark, at):
    t = ChangeTable(spark, f"{at}/a")
    t.apply(spark.createDataFrame([], KIND))
    assert t.current().count() == 0
    t = ChangeTable(spark, f"{at}/b", buckets=2)
    t.apply(spark.createDataFrame([("t", 0, 1, 1, "n", "u", T0, "b", None)], KIND))
    t.apply(spark.createDataFrame([("t", 0, 2, 2, "n", "u", T0, "b", None, 5, 6)], KIND + ", cow_bucket int, cow_rank int"))
    t.apply(spark.createDataFrame([("t", 0, 3, 3, "n", "u", T0, "b", None)], KIND))
    assert rows(t.current(), "id", "cow_bucket", "cow_rank") == [(1, None, None), (2, 5, 6), (3, None, None)]
