"""The one set of schemas that every module shares."""

from __future__ import annotations

from pyspark.sql import types as T

ITEM_FIELDS = ("id", "name", "description", "price", "on_offer")

ITEMS = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("price", T.IntegerType()),
        T.StructField("on_offer", T.BooleanType()),
        T.StructField("operation", T.StringType()),
        T.StructField("processing_time", T.TimestampType()),
        T.StructField("year", T.StringType()),
        T.StructField("month", T.StringType()),
        T.StructField("batch_id", T.StringType()),
    ]
)

LOG = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("append_time", T.TimestampType()),
        T.StructField("value", T.BinaryType()),
    ]
)

#: Offsets are 64-bit.
OFFSETS = T.StructType(
    [
        T.StructField("commit_time", T.TimestampType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("batch_id", T.StringType()),
    ]
)

BATCHES = T.StructType([T.StructField("batch_id", T.StringType()), T.StructField("processed_time", T.TimestampType()), T.StructField("record_count", T.IntegerType())])

CONNECTOR_STATUS = T.StructType(
    [T.StructField("connector", T.StructType([T.StructField("state", T.StringType())])), T.StructField("tasks", T.ArrayType(T.StructType([T.StructField("state", T.StringType()), T.StructField("trace", T.StringType())])))]
)

CONNECTOR_METRICS = T.StructType(
    [T.StructField("tasks", T.ArrayType(T.StructType([T.StructField("metrics", T.StructType([T.StructField("source-record-lag", T.LongType()), T.StructField("lag-in-millis", T.LongType())]))])))]
)
