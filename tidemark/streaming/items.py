"""Change events into a table of current items, exactly once and in the order in which they happened.

Each micro-batch is decoded and applied to the buckets it touches by time and offset, so an event that comes in a
later batch than a younger one does not overwrite it; it is committed with its number and its end offsets in one
manifest. A batch that runs again, after a lost executor or a restart from an older checkpoint, carries a number
the table has committed already and is skipped. Refused messages are appended to a table of their own under the
same number.

Nulls and the like: an event without id is a creation of its own, once for each message; an event without time
counts as the oldest of its item; a batch of refused messages only commits its number and offsets.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.changes import ChangeTable
from tidemark.operators.decode import decode
from tidemark.operators.messages import MESSAGE_KEY
from tidemark.store import SnapshotTable, retrying

_KEY, _TIME = "item_key", "item_time"


def item_table(spark: SparkSession, path: str) -> ChangeTable:
    return ChangeTable(spark, path, key=_KEY, time=_TIME)


def keyed(items: DataFrame) -> DataFrame:
    """Items with what orders and tells them apart: the id, or the message where there is none; the time, or the least there is."""
    message = F.concat_ws("/", F.lit("message"), *MESSAGE_KEY)
    return items.withColumns({_KEY: F.coalesce(F.concat(F.lit("id/"), F.col("id").cast("string")), message), _TIME: F.coalesce("processing_time", F.lit("0001-01-01").cast("timestamp"))})


def current_items(table: ChangeTable) -> DataFrame:
    return table.current().drop(_KEY, _TIME)


def end_offsets(rows: DataFrame) -> dict[str, int]:
    """topic/partition -> the greatest offset of the batch; a row for each topic partition."""
    got = rows.where("topic IS NOT NULL AND partition IS NOT NULL").groupBy("topic", "partition").agg(F.max("offset")).collect()
    return {f"{t}/{p}": o for t, p, o in got}


def _refuse(rejects: SnapshotTable, bad: DataFrame, number: int) -> None:
    base = rejects.manifest()
    if number > base["properties"].get("last", -1):
        rejects.append(bad, "rejects", base, last=number)


def batch_writer(table: ChangeTable, rejects: SnapshotTable | None = None, origin: str = "stream") -> Callable[[DataFrame, int], None]:
    """What foreachBatch calls."""

    def write(batch: DataFrame, number: int) -> None:
        if number <= table.table.manifest()["properties"].get("last", {}).get(origin, -1):
            return
        batch = batch.persist()
        good, bad = decode(batch, time=F.col("append_time"), batch_id=f"{origin}-{number}", keep=MESSAGE_KEY)
        good = keyed(good).persist()  # decoded once, though it is counted, routed and written
        try:
            if rejects is not None:
                retrying(lambda: _refuse(rejects, bad, number))
            table.apply(good, f"{origin}-{number}", last={origin: number}, offsets=end_offsets(batch))
        finally:
            good.unpersist()
            batch.unpersist()

    return write


def offsets(table: ChangeTable) -> dict[str, int]:
    """Where the committed batches end, as `topic/partition` -> offset."""
    return table.table.manifest()["properties"].get("offsets", {})


def start(stream: DataFrame, table: ChangeTable, checkpoint: str, rejects: SnapshotTable | None = None, origin: str = "stream", every: str | None = "60 seconds") -> StreamingQuery:
    """Start a stream of LOG rows into the table; every=None processes what is there and stops."""
    w = stream.writeStream.foreachBatch(batch_writer(table, rejects, origin)).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if every is None else w.trigger(processingTime=every)).start()


def stop(query: StreamingQuery) -> None:
    """Shut a stream down in order: what has arrived is processed and committed, then it ends."""
    query.processAllAvailable()
    query.stop()


def start_all(spark: SparkSession, streams: dict[str, DataFrame], root: str, every: str | None = "60 seconds") -> dict[str, StreamingQuery]:
    """One query for each topic, all at once, each with a table and a checkpoint of its own."""
    return {name: start(s, item_table(spark, f"{root}/{name}/table"), f"{root}/{name}/checkpoint", SnapshotTable(spark, f"{root}/{name}/rejects"), name, every) for name, s in streams.items()}
