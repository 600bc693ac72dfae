from datetime import datetime

import pytest

from tests.conftest import rows
from tidemark.operators.incremental import IncrementalReader, ledger_positions, unplaced
from tidemark.store import CommitConflict

LOG = "topic string, partition int, offset bigint, append_time timestamp, value binary, extra string"
T = datetime(2025, 1, 1)


def log(spark, *keys):
    return spark.createDataFrame([(*k, T, b"x", "e") for k in keys], LOG)


def ledgers(spark, offsets, done):
    o = spark.createDataFrame([(T, *x) for x in offsets], "commit_time timestamp, topic string, partition int, offset bigint, batch_id string")
    return ledger_positions(o, spark.createDataFrame([(b, T, 1) for b in done], "batch_id string, processed_time timestamp, record_count int"))


def test_positions_come_from_recorded_runs_only(spark):
    got = ledgers(spark, [("t", 0, 5, "a"), ("t", 0, 9, "failed"), ("t", 0, 7, None), ("t", 1, -1001, "a"), ("t", 0, 3, "a"), ("t", 0, None, "a")], ["a", "a", None])
    assert rows(got) == [("t", 0, 5), ("t", 1, -1001)]


def test_runs_neither_skip_nor_repeat(spark, at):
    r = IncrementalReader(spark, at)
    start = ledgers(spark, [("t", 0, 2, "a"), ("t", 1, -1, "a")], ["a"])
    first = [("t", 0, i) for i in range(5)] + [("t", 1, 0), ("t", 1, 0), ("u", 0, 7), ("t", None, 1), (None, 0, 1), ("t", 0, None)]
    r.run(log(spark, *first), start)
    assert rows(r.new_records(), "topic", "partition", "offset") == [("t", 0, 3), ("t", 0, 4), ("t", 1, 0), ("u", 0, 7)]
    r.run(log(spark, *first), start)
    assert r.new_records().count() == 0
    more = [*first, ("t", 0, 5), ("u", 0, 9), ("v", 3, 0)]
    r.plan(log(spark, *more))  # a run that dies before its commit
    r.run(log(spark, *more))
    assert rows(r.new_records(), "topic", "partition", "offset") == [("t", 0, 5), ("u", 0, 9), ("v", 3, 0)]
    assert rows(r.positions()) == [("t", 0, 5), ("t", 1, 0), ("u", 0, 9), ("v", 3, 0)]
    assert r.table.versions() == [1, 2, 3]


def test_upper_bound_is_fixed_at_the_start(spark, at):
    r = IncrementalReader(spark, at)
    bounds = r.plan(log(spark, ("t", 0, 1)))
    later = log(spark, ("t", 0, 1), ("t", 0, 2))
    assert rows(r.between(later, bounds), "offset") == [(1,)]


def test_two_runs_at_once(spark, at):
    r = IncrementalReader(spark, at)
    base = r.table.manifest()
    r.run(log(spark, ("t", 0, 1)))
    with pytest.raises(CommitConflict):
        r.table.commit(base, {}, None, "incremental")


def test_salted_join_gives_the_same(spark, at, monkeypatch):
    import tidemark.operators.incremental as m

    monkeypatch.setattr(m, "BROADCAST_ROWS", 0)
    r = IncrementalReader(spark, at)
    r.run(log(spark, *[("t", 0, i) for i in range(100)]), ledgers(spark, [("t", 0, 89, "a")], ["a"]))
    assert rows(r.new_records(), "offset") == [(i,) for i in range(90, 100)]


def test_empty_log_and_names(spark, at):
    r = IncrementalReader(spark, at)
    r.run(log(spark), ledgers(spark, [], []))
    assert r.new_records().count() == 0
    r.run(log(spark, ("t", 0, 1)).withColumnsRenamed({"extra": "position_low", "value": "salt"}))
    assert rows(r.new_records(), "position_low") == [("e",)]
    assert unplaced(log(spark, ("t", None, 1), ("t", 0, 1))).count() == 1
