"""Applying a stream of inserts, updates and deletes to a bucketed copy-on-write table.

Rows belong to the bucket that the hash of their key names. A run routes its changes to their buckets, reads the
files of the touched buckets only, sort-merges them with the changes, writes replacement files and commits a new
manifest after the version it read; the files of all other buckets are carried over by name.

A bucket keeps one row for each message, the earliest of its copies, which makes the result independent of how
often, how late, in what order and in how many runs changes are delivered: a copy that comes in a later run never
makes an old change young again. Its rows lie in two folders, both written in the one pass that merges them:
`heads` has the row of each key that decides (latest time, at equal times the greater offset, then topic and
partition), deletes included as tombstones; `rest` has all other messages. The current rows are the heads that are
no deletes, and reading them does not touch `rest`.

Buckets grow with the data: a bucket is a suffix of the key's hash of some length (its depth). One that a rewrite
finds above `bucket_rows` becomes two of the next depth, and so on, in that same rewrite; the others stay. So a
rewrite costs at most `bucket_rows` for each touched bucket, whatever the size of the table.

Skew: one pass over the keys counts rows by hash slot and message cell (combined before the shuffle; a row for each
slot reaches the driver, at most 2^MOST_DEPTH of them). The rows of a bucket are spread over tasks of about
`split_rows`; a slot beyond that, such as a key with a third of all rows, is spread by message hash, and its few
candidates for a head, one from each task, are reduced when the heads are read. A cell far above the others of its
slot holds a message with very many copies; rows of such cells are first reduced by a window group limit, which
works before the shuffle.

Nulls and the like: rows without key or time are left out (they cannot be ordered); rows without a part of the
message identifier count as messages by the parts they have, nulls being equal; null operation, payload and
batch id are values like others; operation is compared trimmed and in lower case, only `d` deletes; an empty
change set commits nothing new but still makes version 1; extra columns are payload, whatever their names.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from tidemark.functions.columns import c, fresh_prefix, tie_break
from tidemark.operators.messages import MESSAGE_KEY
from tidemark.store import SnapshotTable, advanced, retrying

#: Slots are 2^LEAST_DEPTH or more, eight times as many as a level of buckets has, up to 2^MOST_DEPTH.
LEAST_DEPTH, MOST_DEPTH = 11, 20
#: Message cells of a slot; copies that a cell may hold before it can be hot.
CELLS, HOT_ROWS = 16, 20_000

Leaf = tuple[int, int]  # depth, bits


class ChangeTable:
    """`buckets` is how many a new table begins with (a power of two)."""

    def __init__(self, spark: SparkSession, path: str, key: str = "id", time: str = "processing_time", operation: str = "operation", message: Sequence[str] = MESSAGE_KEY, buckets: int = 16, bucket_rows: int = 8_000_000, split_rows: int = 1_000_000):
        self.spark, self.table = spark, SnapshotTable(spark, path)
        self.key, self.time, self.operation, self.message = key, time, operation, tuple(message)
        self.first_depth, self.bucket_rows, self.split_rows = max(0, (buckets - 1).bit_length()), bucket_rows, split_rows
        self._name(())

    def _name(self, columns: Iterable[str]) -> None:
        """Names for the run's own columns that no column of the rows has; files are found by folder, not by these."""
        p = fresh_prefix(columns, "cow")
        self._slot, self._cell, self._bucket, self._sub, self._base, self._over, self._rank, self._place = (p + x for x in ("slot", "cell", "bucket", "sub", "base", "over", "rank", "place"))

    def _slotted(self, df: DataFrame, depth: int) -> DataFrame:
        return df.where(c(self.key).isNotNull() & c(self.time).isNotNull()).withColumn(self._slot, F.pmod(F.xxhash64(c(self.key)), F.lit(1 << depth)).cast("int"))

    def _counts(self, slotted: DataFrame) -> tuple[dict[int, int], list[int]]:
        """Rows of each slot, and the hot cells (as slot * CELLS + cell)."""
        cell = F.pmod(F.xxhash64(*map(c, self.message)), F.lit(CELLS)).cast("int")
        cells = slotted.groupBy(self._slot, cell.alias(self._cell)).count().persist()
        try:
            n = {r[0]: r[1] for r in cells.groupBy(self._slot).agg(F.sum("count")).collect()}
            most = max(HOT_ROWS, 20 * sum(n.values()) // (CELLS * max(1, len(n))))
            high = cells.where(F.col("count") > most).collect()
            return n, [s * CELLS + k for s, k, x in high if x * (CELLS - 1) > 4 * (n[s] - x)]
        finally:
            cells.unpersist()

    def _first(self, df: DataFrame, partition: list[str]) -> DataFrame:
        """The earliest copy of every message; which one among equals is fixed by an order over all columns."""
        w = Window.partitionBy(*map(c, partition)).orderBy(c(self.time).asc(), *tie_break(df, [*partition, self.time]))
        return df.withColumn(self._rank, F.row_number().over(w)).where(c(self._rank) == 1).drop(self._rank)

    def _grown(self, leaf: Leaf, depth: int, n: dict[int, int]) -> list[tuple[Leaf, list[int]]]:
        """The buckets that take the place of one, each with the slots it has rows of."""
        d, bits = leaf
        slots = [s for s in range(bits, 1 << depth, 1 << d) if s in n]
        rows = sum(n[s] for s in slots)
        # a slot that holds most of the bucket, as a hot key's does, is not helped by fewer neighbours
        if rows <= self.bucket_rows or d >= depth or max(n[s] for s in slots) * 2 > rows:
            return [(leaf, slots)]
        return [x for child in ((d + 1, bits), (d + 1, bits | 1 << d)) for x in self._grown(child, depth, n)]

    def _tasks(self, slots: list[int], n: dict[int, int]) -> list[tuple[int, int, int]]:
        """slot, first task, number of tasks; a slot has several only if one would be too large."""
        out, task, filled = [], 0, 0
        for s in slots:
            if n[s] > self.split_rows:
                k = -(-n[s] // self.split_rows)
                task += filled > 0
                out.append((s, task, k))
                task, filled = task + k, 0
                continue
            if filled and filled + n[s] > self.split_rows:
                task, filled = task + 1, 0
            out.append((s, task, 1))
            filled += n[s]
        return out

    def apply(self, changes: DataFrame, batch: str | None = None, **properties) -> dict:
        """Merge changes in; a batch id that a manifest already names is skipped. A lost commit is tried again.

        properties: what becomes visible with the batch, such as the offsets it ends at; dictionaries of positions advance those there.
        """
        return retrying(lambda: self._apply(self.table.manifest(), changes, batch, properties))

    def _apply(self, base: dict, changes: DataFrame, batch: str | None, properties: dict) -> dict:
        if batch is not None and self.table.has_batch(base, batch):
            return base
        self._name([*changes.columns, *(f["name"] for f in json.loads(base["schema"] or '{"fields": []}')["fields"])])
        known = base["properties"].get("buckets")
        leaves: set[Leaf] = {tuple(map(int, x.split("-"))) for x in known} if known else {(self.first_depth, b) for b in range(1 << self.first_depth)}
        depth = min(MOST_DEPTH, max(LEAST_DEPTH, 3 + max(d for d, _ in leaves)))
        new = self._slotted(changes, depth)
        n, hot = self._counts(new)
        depths = sorted({d for d, _ in leaves})
        touched = {next(x for d in depths if (x := (d, s & ((1 << d) - 1))) in leaves) for s in n}
        name = lambda leaf: f"{leaf[0]}-{leaf[1]}"
        if hot:
            cell = F.col(self._slot) * CELLS + F.pmod(F.xxhash64(*map(c, self.message)), F.lit(CELLS)).cast("int")
            new = self._first(new.where(cell.isin(hot)), [self._slot, self.key, *self.message]).unionByName(new.where(~cell.isin(hot)))
        if base["schema"] is not None:
            parts = [p for x in touched for kind in ("heads", "rest") for p in base["parts"].get(f"{kind}/{name(x)}", [])]
            old = self._slotted(self.table.read(parts, base["schema"]), depth)
            if parts:
                for s, k in old.groupBy(self._slot).count().collect():
                    n[s] = n.get(s, 0) + k
            new = new.unionByName(old, allowMissingColumns=True)
        grown = [x for leaf in touched for x in self._grown(leaf, depth, n)]
        route = [(s, i, first, k) for i, (_, slots) in enumerate(grown) for s, first, k in self._tasks(slots, n)]
        split = {name(grown[i][0]) for _, i, _, k in route if k > 1}
        payload = StructType([f for f in new.schema.fields if f.name != self._slot]).json()
        where = F.broadcast(self.spark.createDataFrame(route, f"`{self._slot}` int, `{self._bucket}` int, `{self._base}` int, `{self._over}` int"))  # a row for each slot
        sub = F.col(self._base) + F.pmod(F.xxhash64(*map(c, self.message), F.lit("sub")), F.col(self._over)).cast("int")
        routed = new.join(where, self._slot).withColumn(self._sub, sub).drop(self._slot, self._base, self._over)
        task = [self._bucket, self._sub]
        # both windows find their rows together and in order already, as the shuffle's columns are among their own
        one = self._first(routed.repartition(*task), [*task, self.key, *self.message])
        age = F.struct(*map(c, (self.time, self.message[-1], *self.message[:-1])))
        is_head = age.eqNullSafe(F.max(age).over(Window.partitionBy(*task, c(self.key))))
        placed = one.withColumn(self._place, F.col(self._bucket) * 2 + is_head.cast("int")).drop(*task)
        written = self.table.buckets_of(self.table.write_part(placed.sortWithinPartitions(self._place, c(self.key)), self._place, compression="zstd"))
        gone = {f"{kind}/{name(x)}" for x in touched for kind in ("heads", "rest")}
        parts = {k: v for k, v in base["parts"].items() if k not in gone}
        parts |= {f"{'heads' if int(p) % 2 else 'rest'}/{name(grown[int(p) // 2][0])}": [at] for p, at in written.items()}
        stay = leaves - touched
        split |= set(base["properties"].get("split", ())) & {name(x) for x in stay}
        now = sorted(stay | {x for x, _ in grown})
        return self.table.commit(base, parts, payload, "apply", buckets=[*map(name, now)], split=sorted(split), touched=len(touched), **{k: advanced(base["properties"].get(k, {}), v) if isinstance(v, dict) else v for k, v in properties.items()}, **({} if batch is None else self.table.with_batch(base, batch)))

    def current(self, version: int | None = None) -> DataFrame:
        """The rows that exist after all changes applied so far, each with the message that gave it."""
        m = self.table.manifest(version)
        if m["schema"] is None:
            raise ValueError("nothing has been applied yet")
        split = {f"heads/{x}" for x in m["properties"]["split"]}
        heads = self.table.read([p for k, ps in m["parts"].items() if k.startswith("heads/") and k not in split for p in ps], m["schema"])
        if several := [p for k, ps in m["parts"].items() if k in split for p in ps]:
            candidates = self.table.read(several, m["schema"])
            latest = [c(x).desc_nulls_last() for x in (self.time, self.message[-1], *self.message[:-1])]
            self._name(candidates.columns)
            one = candidates.withColumn(self._rank, F.row_number().over(Window.partitionBy(c(self.key)).orderBy(*latest))).where(c(self._rank) == 1).drop(self._rank)
            heads = heads.unionByName(one)
        return heads.where(~F.coalesce(F.lower(F.trim(c(self.operation))) == "d", F.lit(False)))
