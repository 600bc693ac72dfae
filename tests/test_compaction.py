from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators.compaction import Compactor, DigestMismatch, hilbert, plan

ROWS = "year string, month string, batch_id string, id int, processing_time timestamp, text string"
FILES = "file_path string, year string, month string, batch_id string, file_size_in_bytes bigint, removed_time timestamp"
DONE = "batch_id string"
T = datetime(2025, 1, 1)


@pytest.mark.parametrize(("n", "bits"), [(2, 4), (3, 3)])
def test_the_curve_visits_every_point_by_single_steps(n, bits):
    points = np.array(np.meshgrid(*[np.arange(2**bits)] * n)).reshape(n, -1)
    code = hilbert(points, bits)
    assert sorted(code) == list(range(2 ** (bits * n)))
    walk = points[:, np.argsort(code)]
    assert (np.abs(np.diff(walk, axis=1)).sum(axis=0) == 1).all()


def listing(spark, *extra):
    base = [(f"f{i}", "2025", "01", "a", 100, None) for i in range(6)] + [("f0", "2025", "01", "a", 100, None), ("g", "2025", "02", "a", 100, None)]
    return spark.createDataFrame([*base, *extra], FILES)


def test_plan(spark):
    f = listing(spark, ("big", "2025", "01", "a", 2**24, None), ("gone", "2025", "01", "a", 1, T), ("failed", "2025", "01", "x", 1, None), ("unknown", "2025", "01", None, 1, None), ("nosize", "2025", "01", "a", None, None))
    done = spark.createDataFrame([("a",), ("a",), (None,)], DONE)
    assert rows(plan(f, done), "file_path") == [(f"f{i}",) for i in range(6)]
    assert plan(f, done, least=7).count() == 0


def data(spark, n=4000):
    return spark.range(n).selectExpr(
        "'2025' AS year", "IF(id % 10 = 0, '02', '01') AS month", "CASE WHEN id % 7 = 0 THEN 'failed' WHEN id % 11 = 0 THEN NULL ELSE 'a' END AS batch_id", "IF(id % 3 = 0, 5, CAST(id % 97 AS INT)) AS id", "IF(id % 13 = 0, NULL, timestamp_seconds(id)) AS processing_time", "repeat('x', 50) AS text"
    )


def test_rows_of_recorded_runs_come_exactly_once(spark, at):
    d = data(spark)
    d = d.unionByName(d.limit(10))  # equal rows are rows like others
    c = Compactor(spark, at, file_bytes=40_000)
    m = c.compact(d, listing(spark), spark.createDataFrame([("a",)], DONE), row_bytes=60)
    want = d.where("batch_id = 'a' AND month = '01'")
    assert rows(c.rows()) == rows(want)
    assert m["properties"]["rows"] == want.count() and m["properties"]["files"] > 2
    sizes = [r[0] for r in c.rows().selectExpr("input_file_name() AS f").groupBy("f").count().select("count").collect()]
    assert len(sizes) == m["properties"]["files"] and max(sizes) < 2.5 * sum(sizes) / len(sizes)
    assert rows(c.replaced(), "file_path") == [(f"f{i}",) for i in range(6)]


def test_a_hot_point_is_split(spark, at):
    d = spark.range(3000).selectExpr("'2025' AS year", "'01' AS month", "'a' AS batch_id", "1 AS id", "timestamp_seconds(0) AS processing_time", "CAST(id AS STRING) AS text")
    c = Compactor(spark, at, file_bytes=10_000)
    m = c.compact(d, listing(spark), spark.createDataFrame([("a",)], DONE), row_bytes=20)
    assert m["properties"]["files"] == 6 and c.rows().count() == 3000


def test_a_loss_is_found_and_nothing_is_committed(spark, at, monkeypatch):
    c = Compactor(spark, at)
    whole = c.table.write_part
    monkeypatch.setattr(c.table, "write_part", lambda df, *by: whole(df.where("id IS NULL OR id <> 5") if "id" in df.columns else df, *by))
    with pytest.raises(DigestMismatch):
        c.compact(data(spark), listing(spark), spark.createDataFrame([("a",)], DONE))
    assert c.table.versions() == []


def test_nothing_to_do(spark, at):
    c = Compactor(spark, at)
    c.compact(data(spark), listing(spark).limit(0), spark.createDataFrame([], DONE))
    assert c.rows().count() == 0 and c.replaced().count() == 0


def test_clashing_names(spark, at):
    c = Compactor(spark, at)
    d = data(spark, 200).withColumnsRenamed({"text": "pack_code"}).withColumn("PACK_g0", F.lit(1))
    c.compact(d, listing(spark), spark.createDataFrame([("a",)], DONE))
    assert rows(c.rows()) == rows(d.where("batch_id = 'a' AND month = '01'"))


def test_many_recorded_batches_are_joined_by_shuffle(spark, at, monkeypatch):
    import tidemark.functions.joins as joins

    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    c = Compactor(spark, at)
    c.compact(data(spark, 500), listing(spark), spark.createDataFrame([("a",)], DONE))
    assert rows(c.rows()) == rows(data(spark, 500).where("batch_id = 'a' AND month = '01'"))
    assert len(c.table.orphans(older_than_s=-1)) == 0


def test_a_second_run_carries_the_other_groups(spark, at):
    done = spark.createDataFrame([("a",)], DONE)
    d = data(spark, 600)
    c = Compactor(spark, at)
    c.compact(d, listing(spark), done)
    february = spark.createDataFrame([(f"h{i}", "2025", "02", "a", 100, None) for i in range(5)], FILES)
    more = d.unionByName(spark.createDataFrame([("2025", "01", "b", 7, T, "late")], ROWS))
    c.compact(more, february, done)
    recorded = d.where("batch_id = 'a'")
    assert rows(c.rows()) == rows(recorded)
    c.compact(more, listing(spark).limit(0), done)  # an empty plan leaves all as it is
    assert rows(c.rows()) == rows(recorded)
    c.table.compact()  # one part for all groups
    c.compact(more.where("id <> 5 OR month = '01'"), february, done)
    assert rows(c.rows()) == rows(recorded.where("id <> 5 OR month = '01'"))


def test_the_whole_table_has_every_recorded_row_once(spark, at):
    d = data(spark, 600)
    d = d.unionByName(d.limit(10)).unionByName(spark.createDataFrame([(None, None, "a", 1, T, "x"), ("2025", "01", "b", 2, T, "x")], ROWS))
    c = Compactor(spark, at)
    c.compact(d, listing(spark), spark.createDataFrame([("a",)], DONE))
    assert rows(c.consolidated(d, spark.createDataFrame([("a",), ("a",), (None,)], DONE))) == rows(d.where("batch_id = 'a'"))
    # a batch recorded after the rewrite comes from the source until the next one
    assert rows(c.consolidated(d, spark.createDataFrame([("a",), ("b",)], DONE))) == rows(d.where("batch_id IN ('a', 'b')"))


def test_large_files_of_rewritten_groups_are_superseded(spark, at):
    files = listing(
        spark, ("big", "2025", "01", "a", 2**24, None), ("big", "2025", "01", "a", 2**24, None), ("nosize", "2025", "01", "a", None, None), ("gone", "2025", "01", "a", 2**25, T),
        ("failed", "2025", "01", "x", 2**25, None), ("unknown", "2025", "01", None, 2**25, None), ("other", "2025", "03", "a", 2**25, None),
    )
    c = Compactor(spark, at)
    c.compact(data(spark, 200), files, spark.createDataFrame([("a",), ("a",), (None,)], DONE))
    small = [(f"f{i}",) for i in range(6)]
    assert rows(c.replaced(), "file_path") == small
    assert rows(c.superseded()) == [("big",), *small, ("nosize",)]
    assert c.table.orphans(older_than_s=-1) == []


def test_hundreds_of_groups_and_bounds_on_whole_codes(spark, at):
    d = spark.range(9000).selectExpr("CAST(2000 + id % 25 AS STRING) AS year", "lpad(CAST(id DIV 25 % 12 + 1 AS STRING), 2, '0') AS month", "'a' AS batch_id", "CAST(IF(id % 5 = 0, 1000000, id % 7) AS INT) AS id", "timestamp_seconds(id % 50) AS processing_time", "'x' AS text")
    files = spark.range(1500).selectExpr("concat('f', id) AS file_path", "CAST(2000 + id % 25 AS STRING) AS year", "lpad(CAST(id DIV 25 % 12 + 1 AS STRING), 2, '0') AS month", "'a' AS batch_id", "100L AS file_size_in_bytes", "CAST(NULL AS TIMESTAMP) AS removed_time")
    c = Compactor(spark, at, cell_bits=2, file_bytes=200)
    m = c.compact(d, files, spark.createDataFrame([("a",)], DONE), row_bytes=20)
    assert len(m["parts"]) == 300 and m["properties"]["files"] == 900
    assert rows(c.rows()) == rows(d) and c.replaced().count() == 1500
    sizes = [r["count"] for r in c.rows().selectExpr("input_file_name() AS f").groupBy("f").count().collect()]
    assert len(sizes) > 850 and max(sizes) <= 2 * 10


def test_files_follow_the_curve(spark, at):
    d = spark.range(6400).selectExpr("'2025' AS year", "'01' AS month", "'a' AS batch_id", "CAST(id % 80 AS INT) AS id", "timestamp_seconds(id DIV 80) AS processing_time", "'x' AS text")
    c = Compactor(spark, at, file_bytes=16_000)
    assert c.compact(d, listing(spark), spark.createDataFrame([("a",)], DONE), row_bytes=40)["properties"]["files"] == 16
    boxes = c.rows().groupBy(F.input_file_name()).agg(F.count("*").alias("n"), ((F.max("id") - F.min("id") + 1) * (F.max(F.unix_seconds("processing_time")) - F.min(F.unix_seconds("processing_time")) + 1)).alias("area")).collect()
    assert len(boxes) == 16 and all(350 < r["n"] < 450 for r in boxes)
    assert sum(r["area"] for r in boxes) < 3 * 6400  # by id or by time alone it would be 16 times as many


def test_more_files_than_allowed_grow_instead(spark, at, monkeypatch):
    import tidemark.operators.compaction as m

    monkeypatch.setattr(m, "MAX_FILES", 4)
    c = Compactor(spark, at, file_bytes=100)
    got = c.compact(data(spark, 2000), listing(spark), spark.createDataFrame([("a",)], DONE), row_bytes=60)
    assert got["properties"]["files"] == 4 and rows(c.rows()) == rows(data(spark, 2000).where("batch_id = 'a' AND month = '01'"))
