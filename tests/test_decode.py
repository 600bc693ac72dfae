from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators.decode import classify, decode, parse, reasons

CASES = [
    (None, "null"), (b"", "blank"), (b" \t\r\n", "blank"), (b"empty", "empty"), (b" empty \n", "empty"), (b"{bad", "bad_json"), (b"\xff\xfe{", "bad_json"),
    (b"[1]", "no_payload"), (b"{}", "no_payload"), (b"7", "no_payload"), (b'{"payload": {}}', "no_payload"), (b'{"payload": null}', "no_payload"), (b'{"payload": 0}', "no_payload"), (b'{"payload": false}', "no_payload"), (b'{"payload": []}', "no_payload"), (b'{"payload": ""}', "no_payload"),
    (b'{"payload": [1]}', "bad_payload"), (b'{"payload": "x"}', "bad_payload"), (b'{"payload": true}', "bad_payload"),
    (b'{"payload": {"id": 1, "price": 1.5}}', "bad_type"), (b'{"payload": {"id": "1"}}', "bad_type"), (b'{"payload": {"id": 2147483648}}', "bad_type"), (b'{"payload": {"id": true}}', "bad_type"), (b'{"payload": {"id": 1, "on_offer": "true"}}', "bad_type"), (b'{"payload": {"id": 1, "on_offer": 1}}', "bad_type"),
]


def log(spark, *values):
    return spark.createDataFrame([("t", 0, i, v) for i, v in enumerate(values)], "topic string, partition int, offset bigint, value binary")


@pytest.fixture(scope="module")
def refused(spark):
    return {r.offset: r.reason for r in parse(log(spark, *(v for v, _ in CASES))).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_refusals(refused, i):
    assert refused[i] == CASES[i][1]


def items(spark, *values):
    return [r.item for r in parse(log(spark, *values)).orderBy("offset").collect()]


def test_rows(spark):
    full = b'{"schema": {"x": 1}, "payload": {"id": 7, "name": "A \\u00e9", "description": "d", "price": 900, "on_offer": true, "__deleted": "false", "more": [1]}}'
    got = items(spark, full, b'{"payload": {"name": 5, "description": {"a": 1}}}', b'{"payload": {"id": null, "on_offer": null, "name": null, "price": null}}')
    assert tuple(got[0]) == (7, "A é", "d", 900, True, "u")
    assert tuple(got[1]) == (None, "5", '{"a":1}', None, False, "c")  # on_offer absent: false
    assert tuple(got[2]) == (None, None, None, None, None, "c")  # on_offer null: null


@pytest.mark.parametrize(("flag", "want"), [('"true"', "d"), ('"TRUE"', "d"), ("true", "d"), ('"false"', "u"), ("null", "u"), ("0", "u"), ('"d"', "u")])
def test_delete_flag(spark, flag, want):
    assert items(spark, b'{"payload": {"id": 1, "__deleted": %s}}' % flag.encode())[0].operation == want


def test_decode_splits_and_adds(spark):
    df = log(spark, b'{"payload": {"id": 1}}', b"x").withColumn("a.b", F.lit(1))
    good, bad = decode(df, time=F.lit(datetime(2025, 3, 4)), batch_id="b")
    assert rows(good, "topic", "partition", "offset", "id", "year", "month", "batch_id") == [("t", 0, 0, 1, "2025", "03", "b")]
    assert rows(bad, "offset", "reason", "`a.b`") == [(1, "bad_json", 1)]
    assert rows(reasons(df)) == [("bad_json", 1), ("ok", 1)]


def test_long_and_empty_input(spark):
    text = "x" * 300_000
    assert items(spark, b'{"payload": {"id": 1, "description": "%s"}}' % text.encode())[0].description == text
    assert parse(log(spark)).count() == 0


def test_reserved_names(spark):
    with pytest.raises(ValueError):
        parse(log(spark).withColumn("reason", F.lit(1)))


def test_classify(spark):
    df = spark.createDataFrame([(True, 1), (False, None), (None, None), (None, 1)], "deleted boolean, id int")
    assert rows(df.select(classify(F.col("deleted"), F.col("id")))) == [("c",), ("c",), ("d",), ("u",)]


def test_values_as_text(spark):
    df = spark.createDataFrame([('{"payload": {"id": 3}}',)], "value string")
    assert parse(df).first().item.id == 3
