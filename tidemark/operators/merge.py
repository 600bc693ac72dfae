"""Merging a batch of changes into a table, and the table that keeps such batches exactly once.

The rule: a source row whose key is in the target deletes it if its operation is `d`, else replaces it; a source
row whose key is not there is inserted, a delete as a tombstone (or not at all: `tombstones="ignore"`). Rows with
a null key never match and are inserted. The optional guard column adds "and the target's value differs" to the
match, which makes rows with a null guard unmatched.

Two plans give the same rows: a full outer equi-join, for any size, with skew handled by adaptive execution; and,
when the source is counted to be small, a broadcast of its keys against the target followed by a union, which does
not shuffle the target.

Nulls and the like: a source with several rows for one key is refused by `assert_unique` (use `latest_per_key`
first); null operations update; an empty source changes nothing; columns may have any names, as rows travel in
structs; columns that only one side has are null on the other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.columns import c, fresh, tie_break
from tidemark.functions.joins import BROADCAST_ROWS
from tidemark.store import SnapshotTable, advanced, retrying


def latest_per_key(df: DataFrame, key: str | Sequence[str] = "id", order: Sequence[str] = ("processing_time",)) -> DataFrame:
    """One row for each key (nulls are one key): the greatest by `order`, ties settled by an order over all columns."""
    keys = [key] if isinstance(key, str) else list(key)
    rank = fresh(df.columns, "key_rank")
    w = Window.partitionBy(*map(c, keys)).orderBy(*(c(o).desc_nulls_last() for o in order), *tie_break(df, [*keys, *order]))
    return df.withColumn(rank, F.row_number().over(w)).where(c(rank) == 1).drop(rank)


def repeated_keys(df: DataFrame, key: str = "id") -> DataFrame:
    """key, n: keys that more than one row has (null keys may repeat)."""
    return df.where(c(key).isNotNull()).groupBy(c(key)).agg(F.count("*").alias("n")).where("n > 1")


def assert_unique(df: DataFrame, key: str = "id") -> None:
    if again := repeated_keys(df, key).take(1):
        raise ValueError(f"several source rows for {key} = {again[0][0]}")


def _aligned(target: DataFrame, source: DataFrame) -> tuple[DataFrame, DataFrame]:
    empty = target.limit(0).unionByName(source.limit(0), allowMissingColumns=True)
    cols = empty.columns
    have = lambda df: df.select(*(c(x).cast(empty.schema[x].dataType) if x in df.columns else F.lit(None).cast(empty.schema[x].dataType).alias(x) for x in cols))
    return have(target), have(source)


def merge(target: DataFrame, source: DataFrame, key: str = "id", operation: str = "operation", tombstones: str = "insert", guard: str | None = None, plan: str = "auto") -> DataFrame:
    """The target after the merge. plan: outer, broadcast, or auto (broadcast if the source is counted small)."""
    if tombstones not in ("insert", "ignore"):
        raise ValueError("tombstones: insert or ignore")
    if plan != "outer":
        small = source.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        if plan == "broadcast" and not small:
            raise ValueError(f"more than {BROADCAST_ROWS} source rows are not broadcast")
        plan = "broadcast" if small else "outer"
    target, source = _aligned(target, source)
    return (_broadcast if plan == "broadcast" else _outer)(target, source, key, operation, tombstones, guard)


def _is_delete(x: Column) -> Column:
    return F.coalesce(x == "d", F.lit(False))


def _outer(target: DataFrame, source: DataFrame, key: str, operation: str, tombstones: str, guard: str | None) -> DataFrame:
    row = lambda df, name: df.select(c(key).alias(f"{name}_key"), F.struct(*(c(x) for x in df.columns)).alias(name))
    on = F.col("t_key") == F.col("s_key")
    if guard:
        on = on & (F.col("t").getField(guard) != F.col("s").getField(guard))
    j = row(target, "t").join(row(source, "s"), on, "full_outer")
    delete = _is_delete(F.col("s").getField(operation))
    gone = F.col("s").isNotNull() & delete & (F.lit(True) if tombstones == "ignore" else F.col("t").isNotNull())
    return j.where(~gone).select(F.when(F.col("s").isNotNull(), F.col("s")).otherwise(F.col("t")).alias("r")).select(*(F.col("r").getField(x).alias(x) for x in target.columns))


def _broadcast(target: DataFrame, source: DataFrame, key: str, operation: str, tombstones: str, guard: str | None) -> DataFrame:
    keys = source.select(c(key).alias("merge_key"), *([c(guard).alias("merge_guard")] if guard else []))
    on = target[f"`{key}`"] == keys["merge_key"]
    if guard:
        on = on & (target[f"`{guard}`"] != keys["merge_guard"])
    kept = target.join(F.broadcast(keys), on, "left_anti")
    deletes = _is_delete(c(operation))
    out = kept.unionByName(source.where(~deletes))
    if tombstones == "ignore":
        return out
    # deletes of keys that the target does not have: the matched keys are at most as many as the source's
    hit = target.join(F.broadcast(keys), on, "left_semi").select(c(key).alias("merge_key")).distinct()
    lone = source.where(deletes).join(hit, c(key) == F.col("merge_key"), "left_anti")
    return out.unionByName(lone)


class MergeTable:
    """A table of current rows, bucketed by the hash of the key, that takes batches exactly once.

    A batch rewrites only the buckets that its keys touch and is committed together with its number, the offsets
    it ends at and its counts, after the version it was merged with (a lost commit is merged again). Numbers grow for
    each source; a number that is not greater than the committed one is skipped, so replaying a batch, even one with
    deletes or null keys, changes nothing. Batches count in the order of their numbers; where events may come late,
    `changes.ChangeTable` orders them by time and offset. A table that outgrows `bucket_rows` for each bucket doubles
    its buckets, which rewrites it once for every doubling. Null keys are spread over the buckets by the whole row.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "id", buckets: int = 16, tombstones: str = "insert", guard: str | None = None, bucket_rows: int = 4_000_000):
        self.spark, self.table, self.key, self.tombstones, self.guard = spark, SnapshotTable(spark, path), key, tombstones, guard
        self.buckets, self.bucket_rows = buckets, bucket_rows

    def _bucketed(self, df: DataFrame, buckets: int) -> DataFrame:
        texts = [c(f.name) if f.dataType.typeName() not in ("map", "variant") else F.to_json(F.struct(c(f.name))) for f in df.schema.fields]
        by = F.when(c(self.key).isNull(), F.xxhash64(*texts)).otherwise(F.xxhash64(c(self.key)))
        return df.withColumn(fresh(df.columns, "merge_bucket"), F.pmod(by, F.lit(buckets)).cast("int"))

    def merge_batch(self, source: DataFrame, number: int, origin: str = "stream", offsets: dict[str, int] | None = None, order: Sequence[str] | None = None) -> dict:
        if number <= self.table.manifest()["properties"].get("last", {}).get(origin, -1):
            return self.table.manifest()
        if order:
            source = latest_per_key(source, self.key, order)
        source = source.persist()  # a batch is read several times below
        try:
            return retrying(lambda: self._merge(self.table.manifest(), source, number, origin, offsets))
        finally:
            source.unpersist()

    def _merge(self, base: dict, source: DataFrame, number: int, origin: str, offsets: dict[str, int] | None) -> dict:
        last = base["properties"].get("last", {})
        if number <= last.get(origin, -1):
            return base
        now = buckets = base["properties"].get("buckets", self.buckets)
        src = self._bucketed(source, buckets)
        counts = src.groupBy(src.columns[-1]).count().collect()  # a row for each bucket
        touched, new = [r[0] for r in counts], sum(r[1] for r in counts)
        small, rows = new <= BROADCAST_ROWS, base["properties"].get("rows", 0) + new
        while rows > self.bucket_rows * buckets:
            buckets *= 2
        if buckets > now:
            touched = [int(k) for k in base["parts"]]
        kind = base["schema"] or source.schema.json()
        old = self.table.read([p for b in touched for p in base["parts"].get(str(b), [])], kind)
        merged = (_broadcast if small else _outer)(*_aligned(old, source), self.key, "operation", self.tombstones, self.guard)
        placed = self._bucketed(merged, buckets)
        bucket = placed.columns[-1]
        part = self.table.write_part(placed.repartition(bucket).sortWithinPartitions(bucket), bucket)
        parts = {k: v for k, v in base["parts"].items() if int(k) not in touched}
        parts |= {b: [p] for b, p in self.table.buckets_of(part).items()}
        return self.table.commit(base, parts, merged.schema.json(), "merge", buckets=buckets, rows=rows, last={**last, origin: number}, offsets=advanced(base["properties"].get("offsets", {}), offsets or {}))

    def rows(self, version: int | None = None) -> DataFrame:
        return self.table.live(version)

    def offsets(self) -> dict[str, int]:
        """Where the committed batches end, as `topic/partition` -> offset."""
        return self.table.manifest()["properties"].get("offsets", {})
