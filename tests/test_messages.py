import random
from datetime import datetime, timedelta

import pytest

from tests.conftest import rows
from tidemark.operators.messages import MessageStore, first_copies, ranked_copies, repeated_messages

KIND = "topic string, partition int, offset bigint, processing_time timestamp, name string, batch_id string, copy_no int, `a.b` map<string,int>"
T0 = datetime(2025, 1, 1)


def some(n, seed, keys=20):
    r = random.Random(seed)
    pick = lambda *x: r.choice(x)
    return [(pick("t", "u", None), pick(0, 1, None), r.randrange(keys), pick(None, T0 + timedelta(seconds=r.randrange(4))), pick("x", "y", None), pick("b1", "b2", None), r.randrange(2), pick(None, {"k": 1})) for _ in range(n)]


def expected(data):
    keep, loose = {}, []
    none_last = lambda v: (v is None, v if v is not None else 0)
    text = lambda v: (v is None, str(v))
    for x in data:
        if None in x[:3]:
            loose.append(x)
            continue
        order = (none_last(x[3]), text(x[4]), text(x[5]), none_last(x[6]), text(None if x[7] is None else "1"))
        if x[:3] not in keep or order < keep[x[:3]][0]:
            keep[x[:3]] = (order, x)
    return [v for _, v in keep.values()] + loose


@pytest.mark.parametrize("n", [0, 1, 300])
def test_first_copies_against_brute_force(spark, n):
    data = some(n, n)
    got = first_copies(spark.createDataFrame(data, KIND)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected(data)))


def test_repeated(spark):
    data = some(300, 7)
    whole = [x[:3] for x in data if None not in x[:3]]
    want = {k for k in whole if whole.count(k) > 1}
    got = rows(repeated_messages(spark.createDataFrame(data, KIND)))
    assert set(got) == want and len(got) == len(want)


def test_rank_name_may_not_clash(spark):
    with pytest.raises(ValueError):
        ranked_copies(spark.createDataFrame([], KIND))


def test_hot_message_is_reduced_before_the_shuffle(spark):
    df = spark.range(30_000).selectExpr("'t' AS topic", "0 AS partition", "IF(id % 3 = 0, 0, id) AS offset", "timestamp_seconds(id) AS processing_time")
    plan = repeated_messages(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert rows(repeated_messages(df)) == [("t", 0, 0)]
    assert first_copies(df).count() == 20_001


def test_store_takes_each_message_once(spark, at):
    data = [x for x in some(400, 3) if None not in x[:3]]
    s = MessageStore(spark, at)
    for i in range(4):
        s.add(spark.createDataFrame(data[i * 100 : (i + 1) * 100], KIND), f"run-{i}")
        s.add(spark.createDataFrame(data[i * 100 : (i + 1) * 100], KIND), f"run-{i}")  # again: nothing
    got = rows(s.rows(), "topic", "partition", "offset")
    assert got == sorted(set(x[:3] for x in data), key=str)


def test_store_survives_a_run_that_died(spark, at):
    s = MessageStore(spark, at)
    batch = spark.createDataFrame([x for x in some(50, 9) if None not in x[:3]], KIND)
    s.table.write_part(first_copies(batch))  # written, never committed
    s.add(batch, "run")
    assert s.rows().count() == batch.select("topic", "partition", "offset").distinct().count()
    s.add(batch.limit(0), "nothing")
    assert s.rows().count() == batch.select("topic", "partition", "offset").distinct().count()


def test_two_writers_on_one_version(spark, at):
    one, two = MessageStore(spark, at), MessageStore(spark, at)
    batch = lambda n: spark.createDataFrame([("t", 0, 5, T0, "x", n, 0, None), ("t", 1, 10**6, T0, "x", n, 0, None)], KIND)
    real, calls = one.table.write_part, []

    def late(df, *by, **kw):
        if not calls:
            calls.append(1)
            two.add(batch("theirs"), "theirs")
        return real(df, *by, **kw)

    one.table.write_part = late
    one.add(batch("mine"), "mine")
    assert rows(one.rows(), "offset", "batch_id") == [(1000000, "theirs"), (5, "theirs")]
    assert one.table.manifest()["properties"]["batches"] == ["theirs", "mine"]


def test_more_topic_partitions_than_ranges(spark, at, monkeypatch):
    import tidemark.operators.messages as m

    monkeypatch.setattr(m, "RANGES", 1)
    data = [x for x in some(200, 5) if None not in x[:3]]
    s = MessageStore(spark, at)
    for i in range(2):
        s.add(spark.createDataFrame(data[i::2], KIND), f"run-{i}")
    assert rows(s.rows(), "topic", "partition", "offset") == sorted(set(x[:3] for x in data), key=str)
