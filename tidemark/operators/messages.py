"""Messages delivered more than once: keep exactly one copy of each.

Copies share an identifier (topic, partition, offset). They are ranked by arrival with an order over all other
columns behind it, so the choice is the same in every run, and the first is kept. The ranks are limited in every
map task before the shuffle (a window group limit), so a message that makes up a third of all rows sends a row
or two from each task and no task gathers its copies.

Nulls and the like: rows that lack a part of the identifier cannot be told apart or together and are all kept;
a null arrival sorts last; rows equal in every column are interchangeable; an empty table gives an empty table;
extra columns are carried, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.columns import c, fresh, tie_break
from tidemark.store import SnapshotTable, retrying

MESSAGE_KEY = ("topic", "partition", "offset")
#: Topic partitions of a batch whose ranges of offsets are looked at one by one.
RANGES = 128


def _whole(key: Sequence[str]):
    cond = F.lit(True)
    for k in key:
        cond = cond & c(k).isNotNull()
    return cond


def ranked_copies(df: DataFrame, key: Sequence[str] = MESSAGE_KEY, arrival: str = "processing_time", depth: int = 1, rank: str = "copy_no") -> DataFrame:
    """The first `depth` copies of every message with a whole identifier, numbered from 1 in column `rank`."""
    if rank in df.columns:
        raise ValueError(f"{rank} is a column already; name another for the rank")
    order = [c(arrival).asc_nulls_last(), *tie_break(df, [*key, arrival])]
    w = Window.partitionBy(*map(c, key)).orderBy(*order)
    return df.where(_whole(key)).withColumn(rank, F.row_number().over(w)).where(c(rank) <= depth)


def first_copies(df: DataFrame, key: Sequence[str] = MESSAGE_KEY, arrival: str = "processing_time", loose: bool = True) -> DataFrame:
    """One row for each message, and every row that has no whole identifier (not read for again if `loose` is false)."""
    rank = fresh(df.columns, "copy_no")
    kept = ranked_copies(df, key, arrival, 1, rank).drop(rank)
    return kept.unionByName(df.where(~_whole(key))) if loose else kept


def repeated_messages(df: DataFrame, key: Sequence[str] = MESSAGE_KEY, arrival: str = "processing_time") -> DataFrame:
    """Identifiers of the messages that have a second copy, each once, by the very ranking that `first_copies` keeps the first of."""
    rank = fresh(df.columns, "copy_no")
    return ranked_copies(df, key, arrival, 2, rank).where(c(rank) == 2).select(*map(c, key))


class MessageStore:
    """A table of first copies that grows batch by batch; every batch is anti-joined with the stored identifiers.

    Only stored rows within the batch's own range of offsets are read for that, a range for each topic partition if
    they are at most `RANGES` and one for all otherwise (ranges go down to the Parquet scan), so the cost of a batch
    follows the batch. A batch and its id are committed together, after the version that the anti-join read: a batch id
    that is already there is skipped, so a repeated run changes nothing, and if another writer was first the batch is
    joined with the new version and tried again.
    """

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str] = MESSAGE_KEY, arrival: str = "processing_time"):
        self.table, self.key, self.arrival = SnapshotTable(spark, path), tuple(key), arrival

    def add(self, batch: DataFrame, batch_id: str) -> dict:
        return retrying(lambda: self._add(self.table.manifest(), batch, batch_id))

    def _add(self, base: dict, batch: DataFrame, batch_id: str) -> dict:
        if self.table.has_batch(base, batch_id):
            return base
        new = first_copies(batch, self.key, self.arrival)
        if base["schema"] is not None:
            stored = self.table.live(base["version"]).where(_whole(self.key)).where(self._ranges(batch)).select(*map(c, self.key))
            new = new.join(stored, list(self.key), "left_anti").select(*map(c, batch.columns))
        return self.table.append(new, "add", base, **self.table.with_batch(base, batch_id))

    def _ranges(self, batch: DataFrame) -> Column:
        """Where the stored identifiers lie that a batch can repeat."""
        *group, last = self.key
        by = batch.where(_whole(self.key)).groupBy(*map(c, group)).agg(F.min(c(last)).alias("lo"), F.max(c(last)).alias("hi"))
        got = by.limit(RANGES + 1).collect()
        if len(got) > RANGES:
            lo, hi = by.agg(F.min("lo"), F.max("hi")).first()
            return c(last).between(lo, hi)
        out = F.lit(False)
        for r in got:
            at = c(last).between(r["lo"], r["hi"])
            for k, v in zip(group, r, strict=False):
                at = at & (c(k) == F.lit(v))
            out = out | at
        return out

    def rows(self) -> DataFrame:
        return self.table.live()

    def compact(self, files: int | None = None) -> dict:
        """Fold the parts of many batches into one."""
        return self.table.compact(files)
