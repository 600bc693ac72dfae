import random
from datetime import datetime

import pytest

from tests.conftest import rows
from tidemark.operators.compare import aligned, differences, latest, presence_bitmaps

KIND = "id int, name string, price double, f0 boolean, `odd.name` string"
FIELDS = ("name", "price", "f0", "odd.name")


def some(n, seed):
    r = random.Random(seed)
    ids = r.sample(range(n * 2), n)
    return [(i, r.choice(["a", "b", "", None]), r.choice([1.0, float("nan"), None]), r.choice([True, False, None]), r.choice(["x", None])) for i in ids] + [(None, "a", 1.0, True, "x")]


def same(a, b):
    return a is b is None or (a is not None and b is not None and (a == b or (a != a and b != b)))


def expected(a, b):
    a, b = ({x[0]: x for x in s if x[0] is not None} for s in (a, b))
    out = [(k, "missing_in_b") for k in a.keys() - b.keys()] + [(k, "missing_in_a") for k in b.keys() - a.keys()]
    out += [(k, f) for k in a.keys() & b.keys() for i, f in enumerate(FIELDS, 1) if not same(a[k][i], b[k][i])]
    return sorted(out, key=str)


@pytest.mark.parametrize(("n", "m"), [(200, 150), (0, 5), (5, 0), (0, 0)])
def test_against_brute_force(spark, at, n, m):
    a, b = some(n, 1), some(m, 2)
    got = differences(spark, spark.createDataFrame(a, KIND), spark.createDataFrame(b, KIND), "id", FIELDS, path=at)
    assert rows(got, "id", "field") == expected(a, b)


def test_values_are_shown(spark, at):
    a, b = (spark.createDataFrame([(1, n, 1.0, True, "x")], KIND) for n in ("old", None))
    assert rows(differences(spark, a, b, "id", FIELDS, path=at)) == [(1, "name", "old", None)]


def test_bitmaps_span_blocks_and_are_compressed(spark, at):
    a, b = spark.range(100_000).withColumnRenamed("id", "k"), spark.range(50_000, 150_000).withColumnRenamed("id", "k")
    both = aligned(spark, a, b, "k", (), f"{at}/w")
    assert both.select("ordinal").distinct().count() == both.count() == 150_000
    got = presence_bitmaps(both.selectExpr("ordinal", "a IS NOT NULL AS has_a", "b IS NOT NULL AS has_b")).collect()
    assert len(got) >= 5 and max(len(v or b"") for r in got for v in r[1:]) < 4096
    assert rows(differences(spark, a, b, "k", (), path=f"{at}/d").groupBy("field").count()) == [("missing_in_a", 50_000), ("missing_in_b", 50_000)]


def test_latest_row_of_a_hot_key(spark):
    df = spark.range(30_000).selectExpr("IF(id % 3 = 0, 1, id + 10) AS id", "timestamp_seconds(id) AS at", "id AS v")
    got = latest(df, "id", "at")
    assert got.where("id = 1").first().v == 29_997 and got.count() == 20_001
    assert got._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2


def test_latest_with_nulls(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, datetime(2025, 1, 1), "b"), (None, None, "c"), (2, None, "z"), (2, None, "y")], "id int, at timestamp, latest_rank string")
    assert rows(latest(df, "id", "at"), "id", "latest_rank") == [(1, "b"), (2, "y")]


def test_marks_beyond_the_broadcast_are_joined_by_block(spark, at, monkeypatch):
    import tidemark.operators.compare as m

    monkeypatch.setattr(m, "MARK_BLOCKS", 0)
    a, b = some(300, 3), some(200, 4)
    got = differences(spark, spark.createDataFrame(a, KIND), spark.createDataFrame(b, KIND), "id", FIELDS, path=at)
    assert rows(got, "id", "field") == expected(a, b)


def test_one_range_shuffle_brings_both_sides_together(spark, at):
    a, b = (spark.createDataFrame(some(50, n), KIND) for n in (5, 6))
    plan = differences(spark, a, b, "id", FIELDS, path=f"{at}/d")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("BroadcastExchange") == 1  # the marks
