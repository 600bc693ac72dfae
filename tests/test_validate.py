import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark import cli
from tidemark.operators import validate as v

T = datetime(2025, 1, 1)


@pytest.mark.parametrize(("s", "t", "ok"), [(1000, 1000, True), (1000, 999, True), (1000, 998, False), (0, 5, True), (5, 0, False)])
def test_row_count(spark, s, t, ok):
    r = v.row_count(spark.range(s), spark.range(t)).first()
    assert (r.source_count, r.target_count, r.difference, r.is_valid) == (s, t, abs(s - t), ok)


def test_checksums_do_not_depend_on_order(spark):
    a = spark.createDataFrame([(1, "x", None), (2, None, True), (2, None, True)], "id int, name string, b boolean")
    for f in (v.table_checksum, v.table_digest):
        assert rows(f(a, a.columns)) == rows(f(a.orderBy(F.desc("id")), a.columns))
        assert rows(f(a, a.columns)) != rows(f(a.distinct(), a.columns))
    many = spark.range(3000).selectExpr("IF(id % 3 = 0, 7, id) AS id")
    for digits in (1, 2, 3, 6):
        want = rows(v.table_checksum(many, ["id"], digits))
        assert want == rows(v.table_checksum(many.orderBy(F.desc("id")), ["id"], digits))
        assert want != rows(v.table_checksum(many.where("id <> 1000"), ["id"], digits))
    assert rows(v.table_checksum(a.limit(0), a.columns)) == rows(v.table_checksum(a.where("false"), a.columns))
    assert v.checksum_match(a, a, a.columns).first().is_valid
    assert not v.checksum_match(a, a.limit(1), a.columns).first().is_valid
    assert v.checksum_match(a.limit(0), a.limit(0), a.columns).first().is_valid


def test_samples(spark):
    s = spark.range(100)
    r = v.sample_match(s, s.where("id <> 7").union(s.where("id = 9")), "id").first()
    assert (r.sample_size, r.matched_records, r.mismatch_count, r.is_valid) == (100, 98, 2, False)
    assert rows(v.sample_mismatches(s, s.where("id <> 7").union(s.where("id = 9")), "id")) == [(7, False, False), (9, True, True)]
    assert v.sample_match(s.limit(0), s, "id").first().match_rate == 0
    assert v.sample_match(s, s, "id", size=10).first().sample_size == 10
    nulls = spark.createDataFrame([(None,), (1,)], "id int")
    assert v.sample_match(nulls, nulls, "id").first().matched_records == 2


def test_primary_key(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id int")
    assert tuple(v.primary_key_check(df, "id").first()) == (4, 1, 1, False)
    assert tuple(v.primary_key_check(df.limit(0), "id").first()) == (0, 0, 0, True)


def test_lag_and_freshness(spark):
    s = spark.createDataFrame([(T,), (None,), (T + timedelta(days=1),)], "at timestamp")
    load = spark.createDataFrame([(T, T + timedelta(seconds=10)), (T, T + timedelta(seconds=400)), (None, T)], "at timestamp, loaded timestamp")
    r = v.combined_lag(s, load, "at", "loaded").first()
    assert (r.avg_lag_seconds, r.samples_count, r.is_acceptable) == (400.0, 1, False)
    assert not v.combined_lag(s.limit(0), load, "at", "loaded").first().is_acceptable
    now = F.lit(T + timedelta(days=1, minutes=30))
    assert v.data_freshness(s, "at", now).first().is_fresh
    assert not v.data_freshness(s.where("at IS NULL"), "at", now).first().is_fresh


def test_health(spark):
    snaps = spark.createDataFrame([(T + timedelta(days=i),) for i in range(10)], "made_current_at timestamp")
    part = spark.range(400).selectExpr("IF(id < 380, 'big', CAST(id AS STRING)) AS p")
    r = v.table_health(snaps, spark.range(151), v.partition_balance(part, ("p",)), F.lit(T + timedelta(days=30))).first()
    # 20 for ten old snapshots, 5 for manifests, 15 for skew, 10 for 21 small partitions
    assert (r.health_score, r.health_level, r.is_skewed, r.small_partitions) == (50, "Poor", True, 21)
    r = v.table_health(snaps.limit(0), spark.range(0), v.partition_balance(part.limit(0), ("p",)), F.lit(T)).first()
    assert (r.health_score, r.health_level) == (100, "Good")


@pytest.mark.parametrize(("ok", "n", "level"), [(20, 20, "Good"), (19, 20, "Good"), (17, 20, "Warning"), (15, 20, "Poor"), (0, 0, "Poor")])
def test_summary(spark, ok, n, level):
    df = spark.createDataFrame([(i < ok,) for i in range(n)], "passed boolean")
    assert v.suite_summary(df).first().level == level


def test_a_check_that_fails_is_a_false_verdict(spark):
    r = v.as_result(lambda: v.row_count(spark.range(1), spark.read.parquet("/nowhere")), "row_count")
    assert r["is_valid"] is False and "error" in r


def test_suite_goes_on_after_an_error(spark):
    a = spark.createDataFrame([(1, T)], "id int, processing_time timestamp")
    out = v.run_suite(spark, a, a, time="no_such_column")
    assert out["results"]["freshness"]["is_fresh"] is False and out["results"]["row_count"]["is_valid"]
    assert out["summary"]["checks"] == 3


def test_command_line(spark, tmp_path, capsys):
    spark.range(10).write.parquet(f"{tmp_path}/s")
    spark.range(5).write.parquet(f"{tmp_path}/t")
    assert cli.main(["--test", "row_count", "--source", f"{tmp_path}/s", "--target", f"{tmp_path}/s", "--output", f"{tmp_path}/out"]) == 0
    assert json.loads(capsys.readouterr().out)["source_count"] == 10
    assert len(list((tmp_path / "out").iterdir())) == 1
    assert cli.main(["--test", "sample", "--source", f"{tmp_path}/s", "--target", f"{tmp_path}/t"]) == 1
    assert cli.main(["--test", "checksum", "--source", f"{tmp_path}/s"]) == 1
    assert cli.main(["--test", "suite", "--source", f"{tmp_path}/s", "--target", f"{tmp_path}/s"]) == 0
    (tmp_path / "d.json").write_text(json.dumps({"connector": "c", "status": '{"connector": {"state": "RUNNING"}, "tasks": []}', "state": "RUNNING", "metrics": "{}"}))
    assert cli.main(["--test", "connector_status", "--documents", f"{tmp_path}/d.json"]) == 0
    assert cli.main(["--test", "replication_lag", "--documents", f"{tmp_path}/d.json"]) == 0
    with pytest.raises(SystemExit):
        cli.main(["--test", "nothing"])


def test_key_is_the_first_column_unless_given(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert v.default_key(df) == "a" and v.default_key(df, "b") == "b"
    with pytest.raises(ValueError):
        v.default_key(spark.createDataFrame([], "struct<>"))


def test_message_lag(spark):
    kind = "topic string, partition int, offset bigint"
    log = spark.createDataFrame([("t", 0, 3), ("t", 0, 9), ("t", 1, 5), ("u", 0, 7), ("u", 0, None)], kind)
    done = spark.createDataFrame([("t", 0, 9), ("t", 0, 4), ("t", 1, -1001), ("u", 0, 8), ("gone", 0, 1)], kind)
    assert rows(v.message_lag(log, done)) == [("t", 0, 9, 9, 0), ("t", 1, 5, None, 1), ("u", 0, 7, 8, 0)]


def test_suite_reports_health_and_kinds_beside_the_rate(spark, tmp_path):
    at = datetime(2025, 1, 1)
    df = spark.createDataFrame([(1, "u", at), (2, None, at)], "id int, operation string, processing_time timestamp")
    out = v.run_suite(spark, df, df, snapshots=df.withColumn("made_current_at", F.col("processing_time")), partitions=("operation",), columns=("id",), source_time="processing_time")
    assert out["summary"]["checks"] == 4 and out["summary"]["passed_checks"] == 4
    assert out["results"]["event_types"]["events"] == {"u": 1, "null": 1} and "health_score" in out["results"]["table_health"]
    saved = v.save_results(spark, out, f"file://{tmp_path}/new/folder", "t")
    assert saved and len(list((tmp_path / "new/folder").glob("t_validation_*.json"))) == 1
