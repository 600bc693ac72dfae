from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import ledger, maintain, monitor, mutate, workload
from tidemark.operators.decode import decode
from tidemark.operators.merge import latest_per_key
from tidemark.sources import catalog, log
from tidemark.store import SnapshotTable
from tidemark.streaming.items import current_items, end_offsets, item_table, offsets, start, start_all, stop

T = datetime(2025, 1, 1)
ITEM = "id int, name string, description string, price int, on_offer boolean"


def test_requests(spark):
    t = spark.createDataFrame([(1, "a", "x", 1, True), (2, "b", "y", 2, False), (3, None, "z", 3, None)], ITEM)
    new = spark.createDataFrame([(9, "a", "q", 1, True), (8, "c", "q", 1, True), (7, "c", "q", 1, True), (6, None, "q", 1, True)], ITEM)
    out, refused = mutate.insert_if_absent(t, new)
    assert rows(out, "id") == [(1,), (2,), (3,), (6,), (8,)] and rows(refused, "id") == [(9,)]
    req = spark.createDataFrame([(1, "n", None, 5, False), (4, "m", None, 5, False), (None, "k", None, 1, True)], ITEM)
    out, missing = mutate.update_by_key(t, req)
    assert rows(out) == sorted([(1, "n", None, 5, False), (2, "b", "y", 2, False), (3, None, "z", 3, None)], key=str)
    assert rows(missing, "name") == [("k",), ("m",)]
    out, gone, missing = mutate.delete_by_key(t, spark.createDataFrame([(1,), (1,), (5,), (None,)], "id int"))
    assert rows(out, "id") == [(2,), (3,)] and rows(gone, "id") == [(1,)] and rows(missing) == [(5,)]
    assert rows(mutate.select_by_key(t, 2), "name") == [("b",)] and mutate.select_all(t) is t


def test_ledgers(spark):
    kind = "topic string, partition int, offset bigint, commit_time timestamp, batch_id string"
    led = spark.createDataFrame([("t", 0, 5, T, "a"), ("t", 0, 4, T, "b"), ("t", 0, 99, None, "c"), ("t", 1, 2, T, None), ("u", 0, 1, T, "a")], kind)
    assert rows(ledger.latest_offsets(led, "t"), "partition", "offset") == [(0, 5), (1, 2)]
    assert rows(ledger.resume_offsets(led)) == [("t", 0, 6), ("t", 1, 3), ("u", 0, 2)]
    assert ledger.latest_offsets(led.limit(0)).count() == 0
    assert ledger.starting_offsets([("t", 0, 6), ("t", 1, 3)]) == '{"t": {"0": 6, "1": 3}}'
    assert rows(ledger.reset(led, "t"), "topic") == [("u",)]
    done = spark.createDataFrame([("a",), ("a",), (None,)], "batch_id string")
    assert ledger.seen(led, done).count() == 2 and ledger.unseen(led, done).count() == 3
    odd = spark.createDataFrame([(None, 1, 0), (None, None, 0), (1, 5, 0), (1, 5, 1)], "p int, o bigint, batch_chunk int")
    assert rows(ledger.microbatches(odd, ("p",), "o", 1)) == sorted([(None, 1, 0, 0), (None, None, 0, 1), (1, 5, 0, 0), (1, 5, 1, 1)], key=str)
    assert ledger.append(led, led.drop("batch_id")).count() == 10
    for chunk in (1_000_000, 30):
        b = ledger.microbatches(spark.range(250).selectExpr("id % 2 AS p", "id AS o"), ("p",), "o", 100, chunk)
        assert rows(ledger.batch_end_offsets(b, ("p", "batch_no"), "o")) == [(0, 0, 198, 100), (0, 1, 248, 25), (1, 0, 199, 100), (1, 1, 249, 25)]


def test_upkeep(spark, at):
    f = spark.createDataFrame([(f"f{i % 6}", "2025", 10) for i in range(12)] + [("g", "2024", 1), (None, "2025", 1)], "file_path string, year string, size int")
    assert rows(maintain.compaction_plan(f, ("year",), size="size")) == [("2025", 6, 60)]
    assert maintain.compaction_plan(f, ("year",), least=7).count() == 0
    snaps = spark.createDataFrame([(i, T + timedelta(days=i)) for i in range(20)] + [(99, None)], "snapshot_id int, made_current_at timestamp")
    now = F.lit(T + timedelta(days=45))
    assert rows(maintain.expired_snapshots(snaps, now), "snapshot_id") == sorted([(i,) for i in range(15)], key=str)
    assert maintain.expired_snapshots(snaps.where("snapshot_id < 5"), now).count() == 0
    assert maintain.old_snapshots(snaps, F.lit(T + timedelta(days=10))).count() == 3
    assert maintain.latest_snapshot(snaps).first().snapshot_id == 19
    listing = spark.createDataFrame([("a", T), ("b", T), ("c", T + timedelta(days=9))], "file_path string, modified_at timestamp")
    assert rows(maintain.orphan_files(listing, listing.where("file_path = 'a'"), F.lit(T + timedelta(days=10))), "file_path") == [("b",)]
    t = SnapshotTable(spark, at)
    for i in range(4):
        t.replace(spark.range(i))
    out = maintain.optimize(t, days_to_retain=0, retain_last=2, orphan_days=-1)
    assert out["expired"] == [1, 2] and len(out["removed"]) == 2
    assert maintain.history(t).count() == 2 and t.live().count() == 3


def test_monitoring(spark):
    docs = [("ok", '{"connector": {"state": "RUNNING"}, "tasks": [{"state": "RUNNING"}]}'), ("none", '{"connector": {"state": "RUNNING"}}'), ("task", '{"connector": {"state": "RUNNING"}, "tasks": [{"state": "RUNNING"}, {"state": "FAILED"}, {}]}'), ("down", '{"connector": {"state": "PAUSED"}, "tasks": []}'), ("bad", "{x"), ("null", None)]
    got = monitor.connector_status(spark.createDataFrame(docs, "connector string, status string"))
    assert rows(got, "connector", "failed_tasks", "running") == sorted([("ok", 0, True), ("none", 0, True), ("task", 2, False), ("down", 0, False), ("bad", 0, False), ("null", 0, False)], key=str)
    assert not monitor.all_running(got).first().all_running and monitor.all_running(got.limit(0)).first().all_running
    lag = lambda n: '{"tasks": [{"metrics": {"lag-in-millis": %d}}, {"metrics": {}}]}' % n
    docs = [("a", "RUNNING", lag(60000)), ("b", "RUNNING", lag(60001)), ("c", "RUNNING", "{}"), ("d", "FAILED", lag(1)), ("e", None, None)]
    got = monitor.replication_lag(spark.createDataFrame(docs, "connector string, state string, metrics string"))
    assert rows(got, "connector", "is_acceptable") == [("a", True), ("b", False), ("c", True), ("d", False), ("e", False)]


def test_workload(spark):
    a, b = workload.workload(spark, 1200, 1), workload.workload(spark, 1200, 1, partitions=7)
    assert rows(a) == rows(b) and rows(a) != rows(workload.workload(spark, 1200, 2))
    n = {r[0]: r[1] for r in rows(a.groupBy("action").count())}
    assert set(n) == set(workload.MIX) and n["get"] > n["update"] > 0
    assert 500 <= a.agg(F.min("price")).first()[0] and a.agg(F.max("price")).first()[0] <= 10000
    assert rows(workload.seed_items(spark, 1, 2)) == [("Test Item 0-0", 0, True), ("Test Item 0-1", 1000, False)]


def test_catalog(spark):
    catalog.create_namespace(spark, "shop_test")
    assert ("shop_test",) in rows(catalog.namespaces(spark))
    try:
        assert not catalog.table_exists(spark, "shop_test.items")
        catalog.create_items(spark, "shop_test.items")
        catalog.create_items(spark, "shop_test.items")
        catalog.create_ledgers(spark, "shop_test.kafka_offsets", "shop_test.processed_batches")
        assert catalog.table_exists(spark, "shop_test.items")
        assert spark.table("shop_test.items").columns[-2:] == ["year", "month"]
    finally:
        for t in ("items", "kafka_offsets", "processed_batches"):
            catalog.drop_table(spark, f"shop_test.{t}")
        spark.sql("DROP NAMESPACE shop_test")


def test_source_options():
    o = log.kafka_options("h:1", "t", True, None)
    assert o["startingOffsets"] == "earliest" and o["kafka.isolation.level"] == "read_committed"
    assert log.kafka_options("h:1", "t", False)["startingOffsets"] == "latest"
    assert log.connector_config("c", "h", "d")["config"]["transforms.unwrap.delete.handling.mode"] == "rewrite"


def messages(spark):
    one = lambda o, i, p, deleted="false": ("t", o % 2, o, T + timedelta(seconds=o), f'{{"payload": {{"id": {i}, "name": "n{o}", "price": {p}, "__deleted": "{deleted}"}}}}'.encode())
    data = [one(0, 1, 5), one(1, 2, 6), one(2, 1, 7), one(3, 3, 1), one(4, 2, 0, "true"), one(5, 1, 8), one(6, 4, 2, "true"), ("t", 0, 7, T, b"bad"), ("t", 1, 8, T, None)]
    return spark.createDataFrame(data, "topic string, partition int, offset bigint, append_time timestamp, value binary")


def test_stream_equals_batch_and_restarts(spark, tmp_path):
    m = messages(spark)
    m.where("offset < 4").coalesce(1).write.parquet(f"{tmp_path}/log/a")
    for part in (m.where("offset < 4"), m.where("offset >= 4")):
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/all")
    table = item_table(spark, f"file://{tmp_path}/table")
    rejects = SnapshotTable(spark, f"file://{tmp_path}/rejects")
    start(log.parquet_stream(spark, f"{tmp_path}/all"), table, f"{tmp_path}/check", rejects, every=None).awaitTermination()
    good, _ = decode(m, time=F.col("append_time"))
    last = latest_per_key(good.where("id IS NOT NULL"), "id", ("processing_time", "offset", "topic", "partition")).unionByName(good.where("id IS NULL"))
    assert rows(current_items(table), "id", "name", "price", "operation") == rows(last.where("operation <> 'd'"), "id", "name", "price", "operation")
    assert offsets(table) == {"t/0": 7, "t/1": 8} and rows(rejects.live(), "offset", "reason") == [(7, "bad_json"), (8, "null")]
    version = table.table.manifest()["version"]
    # the same checkpoint: nothing new; a lost checkpoint: all batches again, none taken twice
    start(log.parquet_stream(spark, f"{tmp_path}/all"), table, f"{tmp_path}/check", rejects, every=None).awaitTermination()
    start(log.parquet_stream(spark, f"{tmp_path}/all"), table, f"{tmp_path}/check2", rejects, every=None).awaitTermination()
    assert table.table.manifest()["version"] == version and rejects.live().count() == 2


def test_one_query_for_each_topic(spark, tmp_path):
    messages(spark).coalesce(1).write.parquet(f"{tmp_path}/all")
    qs = start_all(spark, {n: log.parquet_stream(spark, f"{tmp_path}/all") for n in ("a", "b")}, f"file://{tmp_path}/root", every=None)
    for q in qs.values():
        q.awaitTermination()
    want = len({r.id for r in decode(messages(spark), time=F.col("append_time"))[0].where("id IS NOT NULL").collect()})
    assert want and all(current_items(item_table(spark, f"file://{tmp_path}/root/{n}/table")).where("id IS NOT NULL").count() <= want for n in qs)


def test_end_offsets(spark):
    assert end_offsets(messages(spark)) == {"t/0": 7, "t/1": 8} and end_offsets(messages(spark).limit(0)) == {}


def test_snapshot_then_changes(spark):
    s, ch = spark.createDataFrame([(1, "a")], "id int, name string"), spark.createDataFrame([(1, "d")], "id int, operation string")
    assert rows(log.snapshot_then_changes(s, ch)) == sorted([(1, "a", "r"), (1, None, "d")], key=str)


@pytest.mark.parametrize("package", ["kafka"])
def test_missing_package_is_told(spark, package):
    with pytest.raises(Exception, match=package):
        log.kafka_stream(spark, subscribe="t", **{"kafka.bootstrap.servers": "h:1"})


def test_a_late_event_does_not_overwrite_a_younger_one(spark, tmp_path):
    value = lambda p, gone="false": f'{{"payload": {{"id": 1, "name": "n", "price": {p}, "__deleted": "{gone}"}}}}'.encode()
    day = lambda n: datetime(2025, 1, n)
    kind = "topic string, partition int, offset bigint, append_time timestamp, value binary"
    for batch in ([("t", 0, 5, day(5), value(2))], [("t", 0, 1, day(1), value(1))], [("t", 0, 9, day(9), value(3, "true"))], [("t", 0, 7, day(7), value(4))]):
        spark.createDataFrame(batch, kind).coalesce(1).write.mode("append").parquet(f"{tmp_path}/log")
    table = item_table(spark, f"file://{tmp_path}/table")
    q = start(log.parquet_stream(spark, f"{tmp_path}/log"), table, f"{tmp_path}/check", every="0 seconds")
    stop(q)
    assert not q.isActive and table.table.manifest()["version"] == 4
    assert current_items(table).count() == 0 and offsets(table) == {"t/0": 9}
    spark.createDataFrame([("t", 0, 11, day(11), value(5)), ("t", 0, 10, day(10), value(6))], kind).coalesce(1).write.mode("append").parquet(f"{tmp_path}/log")
    start(log.parquet_stream(spark, f"{tmp_path}/log"), table, f"{tmp_path}/check", every=None).awaitTermination()
    assert rows(current_items(table), "price") == [(5,)]
