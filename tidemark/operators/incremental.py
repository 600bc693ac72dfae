"""Processing only new or changed records.

A run reads the log from the last committed position (exclusive) to an upper bound that is fixed at its start
(inclusive), and commits its output together with the new positions as one version of a table. The version
numbers are the monotonic commit sequence; the positions in the latest version are the high watermark. A run
that dies before the commit leaves nothing visible, so the next one starts from the same positions: nothing is
skipped and nothing comes twice. Messages appended while a run is under way lie above its bound and wait.

The first run takes its positions from the ledgers: of each topic and partition the greatest offset among the
ledger rows whose batch succeeded; a position below 0, or none, means from the beginning.

Nulls and the like: a message without topic, partition or offset has no place in the log; such rows are not
returned (`unplaced` gives them). Messages read twice come once. Ledger rows with null batch ids never count.
An empty log commits an empty version; an empty ledger means from the beginning. Extra columns are carried,
whatever their names.

One topic partition may hold any share of the rows: the table of positions has a row for each topic partition,
is written, counted and broadcast only below `BROADCAST_ROWS`; beyond that its rows are repeated under a salt
and the log is joined on topic, partition and salt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import c
from tidemark.operators.messages import MESSAGE_KEY, first_copies
from tidemark.store import SnapshotTable, retrying

BROADCAST_ROWS = 200_000
SALTS = 32
_LOW, _HIGH = "position_low", "position_high"


def ledger_positions(offsets: DataFrame, batches: DataFrame) -> DataFrame:
    """topic, partition, position: the last offset that a successful run has recorded."""
    done = batches.select("batch_id").where("batch_id IS NOT NULL").distinct()
    by_batch = offsets.where("batch_id IS NOT NULL AND `offset` IS NOT NULL").groupBy("batch_id", "topic", "partition").agg(F.max("offset").alias("position"))
    return by_batch.join(done, "batch_id", "left_semi").groupBy("topic", "partition").agg(F.max("position").alias("position"))


def unplaced(log: DataFrame) -> DataFrame:
    """Rows that lack a part of the message identifier."""
    return log.where("topic IS NULL OR partition IS NULL OR `offset` IS NULL")


class IncrementalReader:
    """Runs over a log; every run is one committed version of the table at `path`."""

    def __init__(self, spark: SparkSession, path: str, arrival: str = "append_time"):
        self.spark, self.table, self.arrival = spark, SnapshotTable(spark, path), arrival

    def positions(self, base: dict | None = None) -> DataFrame | None:
        """The high watermark of a version, the latest unless told; None before the first."""
        at = (base or self.table.manifest())["properties"].get("positions")
        return None if at is None else self.spark.read.parquet(f"{self.table.path}/{at}").selectExpr("topic", "partition", f"{_HIGH} AS position")

    def plan(self, log: DataFrame, start: DataFrame | None = None, base: dict | None = None) -> str:
        """Fix the bounds of the run after a version: a written table of topic, partition, low (exclusive) and high (inclusive)."""
        low = self.positions(base)
        low = low if low is not None else start
        high = log.where("topic IS NOT NULL AND partition IS NOT NULL").groupBy("topic", "partition").agg(F.max("offset").alias("top"))
        if low is None:
            bounds = high.withColumn("position", F.lit(None).cast("bigint"))
        else:
            bounds = low.groupBy("topic", "partition").agg(F.max("position").alias("position")).join(high, ["topic", "partition"], "full_outer")
        bounds = bounds.where("topic IS NOT NULL AND partition IS NOT NULL").select(
            "topic",
            "partition",
            F.when(F.col("position") >= 0, F.col("position")).alias(_LOW),
            F.greatest(F.when(F.col("position") >= 0, F.col("position")), "top").cast("bigint").alias(_HIGH),
        )
        return self.table.write_part(bounds)

    def run(self, log: DataFrame, start: DataFrame | None = None) -> dict:
        """Read what is new, write it, and commit it with the new positions."""
        return retrying(lambda: self._run(self.table.manifest(), log, start))

    def _run(self, base: dict, log: DataFrame, start: DataFrame | None) -> dict:
        at = self.plan(log, start, base)
        part = self.table.write_part(first_copies(self.between(log, at), MESSAGE_KEY, self.arrival, loose=False))
        return self.table.commit(base, {"all": [part]}, log.schema.json(), "incremental", positions=at, extra_parts=[at])

    def between(self, log: DataFrame, bounds: str) -> DataFrame:
        """The log's rows within written bounds."""
        b = self.spark.read.parquet(f"{self.table.path}/{bounds}")
        # rows travel as a struct, so no column of theirs can clash with the bounds
        rows = log.select("topic", "partition", "offset", F.struct(*(c(x) for x in log.columns)).alias("row"))
        if b.count() <= BROADCAST_ROWS:
            joined = rows.join(F.broadcast(b), ["topic", "partition"])
        else:
            b = b.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            joined = rows.withColumn("salt", F.pmod(F.xxhash64("offset"), F.lit(SALTS)).cast("int")).join(b, ["topic", "partition", "salt"])
        new = joined.where((F.col(_LOW).isNull() | (F.col("offset") > F.col(_LOW))) & (F.col("offset") <= F.col(_HIGH)))
        return new.select("row.*")

    def new_records(self, version: int | None = None) -> DataFrame:
        """The output of one committed run (the latest unless told)."""
        return self.table.live(version)
