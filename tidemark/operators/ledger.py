"""Offset and batch ledgers as tables: appending, the latest offsets, where to resume, which batches are known.

Nulls and the like: ledger rows without batch are kept and simply match nothing; equal commit times are settled by
the greater offset; an empty ledger gives no positions, which means from the beginning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.columns import c, fresh, tie_break
from tidemark.operators.merge import latest_per_key


def latest_offsets(ledger: DataFrame, topic: str | None = None, by: Sequence[str] = ("topic", "partition"), time: str = "commit_time", offset: str = "offset") -> DataFrame:
    """The last committed row of each topic and partition."""
    rows = ledger if topic is None else ledger.where(F.col("topic") == topic)
    return latest_per_key(rows, by, (time, offset))


def resume_offsets(ledger: DataFrame, topic: str | None = None, by: Sequence[str] = ("topic", "partition"), time: str = "commit_time", offset: str = "offset") -> DataFrame:
    """The first offset to read again: one after the last committed one."""
    return latest_offsets(ledger, topic, by, time, offset).select(*map(c, by), (c(offset) + 1).alias("start_offset"))


def starting_offsets(positions: list[tuple[str, int, int]]) -> str:
    """A Kafka source's startingOffsets (JSON) for topic, partition, first offset; partitions are few."""
    import json

    out: dict[str, dict[str, int]] = {}
    for topic, partition, start in positions:
        out.setdefault(topic, {})[str(partition)] = int(start)
    return json.dumps(out, sort_keys=True)


def reset(ledger: DataFrame, topic: str) -> DataFrame:
    """The ledger without a topic, as after its consumer group was reset."""
    return ledger.where(~F.coalesce(F.col("topic") == topic, F.lit(False)))


def append(ledger: DataFrame, rows: DataFrame) -> DataFrame:
    return ledger.unionByName(rows, allowMissingColumns=True)


def batch_end_offsets(rows: DataFrame, by: Sequence[str], offset: str = "offset") -> DataFrame:
    """The greatest offset of each batch and partition, from the data itself."""
    return rows.groupBy(*map(c, by)).agg(F.max(c(offset)).alias("end_offset"), F.count("*").alias("records"))


def seen(rows: DataFrame, batches: DataFrame, batch: str = "batch_id") -> DataFrame:
    """The rows whose batch a ledger holds."""
    return rows.join(batches.select(c(batch)).where(c(batch).isNotNull()).distinct(), batch, "left_semi")


def unseen(rows: DataFrame, batches: DataFrame, batch: str = "batch_id") -> DataFrame:
    return rows.join(batches.select(c(batch)).where(c(batch).isNotNull()).distinct(), batch, "left_anti")


def microbatches(rows: DataFrame, partition: Sequence[str], order: str, size: int = 100, chunk: int = 1_000_000) -> DataFrame:
    """The rows with `batch_no`: each partition's log cut into batches of `size` rows, in the order of an integer offset.

    Rows are numbered within chunks of offsets, and counts of the chunks before are added, so one partition with
    most of the log is numbered by many tasks. Rows without offset come last.
    """
    of = fresh(rows.columns, "batch_chunk")
    at = fresh(rows.columns, "batch_before")
    tagged = rows.withColumn(of, F.coalesce(F.floor(c(order) / chunk).cast("bigint"), F.lit((1 << 62))))
    keys = [*partition, of]
    counts = tagged.groupBy(*map(c, keys)).agg(F.count("*").alias(at))
    before = Window.partitionBy(*map(c, partition)).orderBy(c(of)).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*(c(k).alias(f"k{i}") for i, k in enumerate(keys)), F.coalesce(F.sum(c(at)).over(before), F.lit(0)).alias(at))
    within = Window.partitionBy(*map(c, keys)).orderBy(c(order).asc_nulls_last(), *tie_break(rows, [*partition, order]))
    numbered = tagged.withColumn("batch_no", F.row_number().over(within))
    joined = numbered.join(counts, [c(k).eqNullSafe(F.col(f"k{i}")) for i, k in enumerate(keys)])
    return joined.withColumn("batch_no", F.floor((F.col("batch_no") - 1 + c(at)) / size).cast("bigint")).select(*map(c, rows.columns), "batch_no")
