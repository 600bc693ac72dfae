import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import history

KIND = "id int, price int, on_offer boolean, processing_time timestamp, loaded_time timestamp, slot string"
T0 = datetime(2025, 1, 1)
day = lambda n: T0 + timedelta(days=n)


def some(n, seed, slots=6, loads=3):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        s = r.randrange(slots)
        out.append((r.choice([None, 1, 2, 3, 4]), r.choice([None, 5, 6]), r.choice([None, True]), r.choice([None, *[day(s)] * 9]), r.choice([None, *[day(s) + timedelta(hours=20 * h) for h in range(loads)]]), "x"))
    return out


def value(x):
    return (x[1] is not None, x[1] or 0, x[2] is not None, bool(x[2])), (x[1], x[2])


def held(data, until=None):
    """(id, time) -> values: the latest reading of each, as known at a time."""
    best = {}
    for x in data:
        if x[0] is None or x[3] is None:
            continue
        at = x[4] or datetime(1900, 1, 1)
        if until is not None and at > until:
            continue
        k = (x[0], x[3])
        if k not in best or (at, value(x)[0]) > best[k][0]:
            best[k] = ((at, value(x)[0]), value(x)[1])
    return {k: v for k, (_, v) in best.items()}


def expected_versions(data):
    times = sorted({x[3] for x in data if x[3] is not None})
    h, out = held(data), []
    for i in sorted({k[0] for k in h}):
        run = None
        for n, t in enumerate([*times, None]):
            v = h.get((i, t)) if t else None
            if run and (t is None or (i, t) not in h or v != run[0]):
                out.append((i, *run[0], run[1], t))
                run = None
            if t and (i, t) in h and run is None:
                run = (v, t)
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [0, 1, 40, 300])
def test_versions_against_brute_force(spark, n):
    data = some(n, n)
    df = spark.createDataFrame(data, KIND)
    grid = history.slots(df)
    for ledger in (history.build(df, grid=grid), history.from_readings(df, grid)):
        got = history.versions(history.as_of(ledger), grid)
        assert rows(got, "id", "values.price", "values.on_offer", "valid_from", "valid_to") == expected_versions(data)


def test_the_ledger_knows_what_it_held(spark):
    data = some(200, 4)
    df = spark.createDataFrame(data, KIND)
    grid = history.slots(df)
    ledger = history.build(df, grid=grid).cache()
    times = {r.slot: r.slot_at for r in grid.collect()}
    for until in (day(2), day(3) + timedelta(hours=1), day(9)):
        got = {(r.id, times[r.slot_from]): tuple(r["values"]) for r in history.as_of(ledger, str(until)).collect()}
        assert got == held(data, until)


def points(spark, ledger, until=None):
    got = history.as_of(ledger, until).withColumn("s", F.explode(F.sequence("slot_from", F.col("slot_to") - 1)))
    out = rows(got, "id", "s", "values.price", "values.on_offer")
    assert len({x[:2] for x in out}) == len(out)  # held rows of an entity do not overlap
    return out


def test_late_updates_split_and_supersede(spark):
    early = [(i, p, True, day(s), day(s), "x") for i in (1, 2) for s, p in enumerate([5, 5, 5, 7, 7])]
    late = [(1, 9, True, day(1), day(20), "x"), (1, 7, True, day(3), day(20), "x"), (3, 1, None, day(4), day(20), "x"), (1, 9, True, day(2), day(19), "x"), (1, 5, True, day(2), day(22), "x")]
    df = spark.createDataFrame(early, KIND)
    grid = history.slots(df)
    # a ledger of joined rows, as a keeper of versions would hold it
    v = history.versions(history.as_of(history.build(df, grid=grid)), grid)
    ends = grid.agg(F.max("slot")).first()[0] + 1
    ledger = v.join(grid.select("slot_at", F.col("slot").alias("slot_from")), v.valid_from == F.col("slot_at")).drop("slot_at")
    ledger = ledger.join(grid.select("slot_at", F.col("slot").alias("slot_to")), ledger.valid_to == F.col("slot_at"), "left").select("id", "values", "slot_from", F.coalesce("slot_to", F.lit(ends)).alias("slot_to"), F.lit(day(5)).alias("recorded_from"), F.lit(None).cast("timestamp").alias("recorded_to"))
    after = history.apply(ledger, spark.createDataFrame(late, KIND), grid).cache()
    assert points(spark, after, str(day(6))) == points(spark, ledger)  # what was held stays known
    s = {x[3]: n for n, x in enumerate(sorted(rows(grid, "slot", "slot_at", "slot_at", "slot_at"), key=lambda x: x[0]), 1)}
    want = {(i, n + 1): (p, True) for i in (1, 2) for n, p in enumerate([5, 5, 5, 7, 7])}
    flat = lambda d: sorted([(*k, *v) for k, v in d.items()], key=str)
    want |= {(1, s[day(2)]): (9, True)}
    assert points(spark, after, str(day(19))) == flat(want)
    want |= {(1, s[day(1)]): (9, True), (3, s[day(4)]): (1, None)}
    assert points(spark, after, str(day(21))) == flat(want)
    want |= {(1, s[day(2)]): (5, True)}
    assert points(spark, after) == flat(want)
    assert after.where("id = 2 AND recorded_to IS NOT NULL").count() == 0


def test_random_loads_equal_one_build(spark):
    data = [x for x in some(150, 11) if x[4] is not None]
    df = spark.createDataFrame(data, KIND)
    grid = history.slots(df)
    r = random.Random(3)
    loads = [[], [], []]
    for x in data:
        n = r.randrange(3)
        loads[n].append((*x[:4], day(30 + n), "x"))  # one recorded time for a load
    ledger = history.build(spark.createDataFrame(loads[0], KIND), grid=grid)
    for more in loads[1:]:
        ledger = history.apply(ledger, spark.createDataFrame(more, KIND), grid).cache()
    whole = history.build(spark.createDataFrame([x for p in loads for x in p], KIND), grid=grid).cache()
    for until in (day(30), day(31), None):
        assert points(spark, ledger, until and str(until)) == points(spark, whole, until and str(until))


@pytest.mark.parametrize("seed", [11, 12])
def test_late_loads_equal_one_build_at_every_recorded_time(spark, seed):
    data = [(*x[:4], None if x[4] is None else x[3] and x[3] + timedelta(hours=random.Random(i).choice([1, 30, 30, 60, 90, 100])), "x") for i, x in enumerate(some(250, seed))]
    df = spark.createDataFrame(data, KIND)
    grid = history.slots(df)
    ledger, whole = history.from_readings(df, grid).cache(), history.build(df, grid=grid).cache()
    for until in [None, *sorted({x[4] for x in data if x[4]})[::7]]:
        assert points(spark, ledger, until and str(until)) == points(spark, whole, until and str(until))
    assert rows(ledger, "id", "values", "slot_from", "recorded_from", "recorded_to") == rows(whole, "id", "values", "slot_from", "recorded_from", "recorded_to")


def test_a_table_takes_loads_in_turn_and_rewrites_nothing(spark, at):
    data = [x for x in some(250, 21, loads=5)]
    grid = history.slots(spark.createDataFrame(data, KIND))
    t = history.HistoryTable(spark, at)
    bounds = [day(1), day(3), day(20)]
    kept = []
    for n, until in enumerate(bounds):
        since = bounds[n - 1] if n else datetime(1, 1, 1)
        load = [x for x in data if since < (x[4] or datetime(1900, 1, 1)) <= until]
        for _ in range(2):  # the second is skipped
            m = t.load(spark.createDataFrame(load, KIND), f"load-{n}", grid)
        assert m["parts"]["rows"][: len(kept)] == kept and m["version"] == n + 1
        kept = m["parts"]["rows"]
    whole = history.build(spark.createDataFrame(data, KIND), grid=grid).cache()
    for until in (*bounds, day(2), None):
        assert points(spark, t.ledger(), until and str(until)) == points(spark, whole, until and str(until))
    assert points(spark, t.ledger(1)) == points(spark, whole, str(bounds[0]))


def test_snapshots_may_come_later_but_not_in_between(spark, at):
    t = history.HistoryTable(spark, at)
    row = lambda i, p, d: (i, p, True, day(d), day(d), "x")
    t.load(spark.createDataFrame([row(1, 5, 0), row(1, 5, 2)], KIND), "a")
    t.load(spark.createDataFrame([row(1, 6, 4), row(2, 1, 4)], KIND), "b")
    got = history.versions(history.as_of(t.ledger()), t.grid())
    assert rows(got, "id", "values.price", "valid_from", "valid_to") == [(1, 5, day(0), day(4)), (1, 6, day(4), None), (2, 1, day(4), None)]
    with pytest.raises(ValueError):
        t.load(spark.createDataFrame([row(1, 5, 1)], KIND), "c")
    # a reading dated before what is held counts from the time of that on
    t.load(spark.createDataFrame([(1, 9, True, day(2), day(1), "x")], KIND), "d")
    assert rows(history.as_of(t.ledger()).where("slot_from = 2"), "values.price") == [(9,)]
