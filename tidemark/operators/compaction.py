"""Far too many small files: write the rows of recorded runs into few files of good size.

`plan` names the files worth replacing. `compact` rewrites every group (the partition columns, such as year and
month) that the plan names: rows get a Hilbert code over several columns, so that rows near in all of them land
in the same file; exact counts of codes place the file bounds so that files are balanced; each row is shuffled once,
straight to the partition of its file; the files are written, and for each group the count, the sum and the
exclusive-or of row digests of source and destination are compared. Only then is a manifest committed, with two
lists of files of the verified groups: the small ones that the plan names, and all live recorded files, large ones
included, as their rows are in the new files too. A row of a recorded run is there exactly once: copies in
the source stay copies, rows of runs without a record do not come along.

As a listing does not tell which rows a file holds, a group is rewritten whole, from the rows of recorded runs.
A manifest names the parts of each group, so a run replaces the groups it rewrites and carries all others.
`rows` reads the groups rewritten so far, `consolidated` the whole table: it adds the rows of recorded runs that
no rewrite holds yet.

Scale: the histogram stays distributed. Its first level counts cells, the leading `cell_bits` of a code, and sums the
digests with them; a prefix sum over the at most 2^cell_bits cells of a group tells which cells hold a bound between
two files. Only the rows of those cells are counted by their whole code, and a prefix sum within each cell gives the
bound's code; a code with more rows than a file may hold is cut by the hash of their place in the source, which parts
even equal rows. What reaches the driver is a row for
each group (at most `MAX_GROUPS`; a manifest has an entry for each) and one for each bound, which workers search.
Files grow beyond `file_bytes` rather than being more than `MAX_FILES` in a run.
The sets of groups and of recorded batches are counted and broadcast while they are small (see
`checked_broadcast`), so wide rows are shuffled only once, to their files; with more recorded batches than that,
the rows in scope are selected by a shuffle join once and staged.

Nulls and the like: null dimensions have the least coordinate; rows with a null batch belong to no recorded run;
null partition values make a group of their own; equal rows are kept as often as they occur; an empty plan
commits an empty version; any extra columns are carried, whatever their names.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from tidemark.functions.columns import c, fresh_prefix
from tidemark.functions.joins import checked_broadcast, is_small
from tidemark.store import SnapshotTable, retrying

#: Groups and files of one run, at most.
MAX_GROUPS, MAX_FILES = 1_000_000, 100_000


class DigestMismatch(RuntimeError):
    """Source and destination differ; nothing was committed."""


def hilbert(coordinates: Sequence[np.ndarray], bits: int) -> np.ndarray:
    """The index along the Hilbert curve of points with `bits`-bit coordinates (Skilling's transposition)."""
    x = [np.asarray(v, dtype=np.uint64).copy() for v in coordinates]
    n, one = len(x), np.uint64(1)
    q = 1 << (bits - 1)
    while q > 1:
        p = np.uint64(q - 1)
        for i in range(n):
            high = (x[i] & np.uint64(q)) != 0
            t = np.where(high, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, t)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[n - 1] & np.uint64(q)) != 0, np.uint64(q - 1), np.uint64(0))
        q >>= 1
    code = np.zeros_like(x[0])
    x = [v ^ t for v in x]
    for b in range(bits - 1, -1, -1):
        for v in x:
            code = (code << one) | ((v >> np.uint64(b)) & one)
    return code.astype(np.int64)


def hilbert_column(columns: Sequence[Column], bits: int) -> Column:
    """Columns must be integers from 0 to 2^bits - 1."""

    @F.pandas_udf("bigint")
    def code(points: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert([points[k].to_numpy() for k in points.columns], bits))

    return code(F.struct(*(x.cast("bigint").alias(f"x{i}") for i, x in enumerate(columns))))


def file_column(columns: Sequence[Column], bits: int, group: Column, within: Column, within_bits: int, bounds, first: np.ndarray) -> Column:
    """code and file of a row: struct of the Hilbert code and the number of its file.

    group: the number of the row's group; within: an integer below 2^within_bits that orders the rows of one code;
    bounds: a broadcast pair of arrays, group and place of every bound, in order; first: the first file of each group.
    """

    n = len(columns)

    @F.pandas_udf("code bigint, file int")
    def placed(points: pd.DataFrame) -> pd.DataFrame:
        code = hilbert([points[f"x{i}"].to_numpy() for i in range(n)], bits)
        of, place = bounds.value
        g, at = points["g"].to_numpy(), (code << within_bits) | points["w"].to_numpy()
        file = first[g].copy()
        for x in np.unique(g) if len(of) else ():
            lo, hi = np.searchsorted(of, [x, x + 1])
            mine = g == x
            file[mine] += np.searchsorted(place[lo:hi], at[mine], side="right")
        return pd.DataFrame({"code": code, "file": file.astype(np.int32)})

    return placed(F.struct(*(x.cast("bigint").alias(f"x{i}") for i, x in enumerate(columns)), group.cast("int").alias("g"), within.cast("bigint").alias("w")))


def row_digests(df: DataFrame) -> tuple[Column, Column]:
    """Two 64-bit digests of a row that tell a null from its absence."""
    cols = [F.to_json(F.struct(c(f.name))) if f.dataType.typeName() in ("map", "variant") else c(f.name) for f in df.schema.fields]
    flags = F.concat(*(F.isnull(x).cast("string") for x in cols)) if cols else F.lit("")
    return F.xxhash64(*cols, flags), F.xxhash64(F.lit(1), flags, *reversed(cols))


def plan(files: DataFrame, batches: DataFrame, small: int = 16 * 1024 * 1024, least: int = 5, group: Sequence[str] = ("year", "month")) -> DataFrame:
    """file_path and the group columns of live, recorded files below `small` bytes in groups with at least `least` of them."""
    done = batches.select("batch_id").where("batch_id IS NOT NULL").distinct()
    live = files.where(F.col("removed_time").isNull() & (F.col("file_size_in_bytes") < small) & F.col("file_path").isNotNull())
    live = live.select("file_path", *map(c, group), "batch_id").distinct().join(done, "batch_id", "left_semi").groupBy("file_path").agg(*(F.first(c(g)).alias(g) for g in group))
    enough = live.groupBy(*map(c, group)).count().where(F.col("count") >= least)
    on = [F.col(f"l.`{g}`").eqNullSafe(F.col(f"e.`{g}`")) for g in group]
    return live.alias("l").join(enough.alias("e"), on, "left_semi")


def members(files: DataFrame, batches: DataFrame, groups: DataFrame, on: Sequence[Column]) -> DataFrame:
    """file_path of live, recorded files of any size in the groups that `on` matches."""
    done = batches.select("batch_id").where("batch_id IS NOT NULL").distinct()
    live = files.where(F.col("removed_time").isNull() & F.col("file_path").isNotNull())
    return live.join(groups, [*on], "left_semi").join(done, "batch_id", "left_semi").select("file_path").distinct()


def _coordinate(x: Column, kind: str, lo, hi, bits: int) -> Column:
    if lo is None or hi is None or lo == hi:
        return F.when(x.isNull(), 0).otherwise(1)
    v = (F.unix_micros(x) if kind == "timestamp" else x).cast("double")
    return F.coalesce(F.least(F.floor((v - F.lit(float(lo))) / F.lit((float(hi) - float(lo)) / (2**bits - 2))), F.lit(2**bits - 2)) + 1, F.lit(0))


def _row_bytes(rows: DataFrame, n: int) -> float:
    """Bytes of a row as the files' sizes say; as the columns' kinds say if these are not known."""
    plan = rows._jdf.queryExecution().optimizedPlan()
    size = int(plan.stats().sizeInBytes())
    known = size < int(rows.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes())
    return size / n if known and n else float(plan.schema().defaultSize())


class Compactor:
    def __init__(self, spark: SparkSession, path: str, group: Sequence[str] = ("year", "month"), dimensions: Sequence[str] = ("id", "processing_time"), bits: int = 16, cell_bits: int = 16, file_bytes: int = 128 * 1024 * 1024):
        self._prefix = "pack_"
        self.spark, self.table = spark, SnapshotTable(spark, path)
        self.group, self.dimensions, self.bits, self.cell_bits, self.file_bytes = tuple(group), tuple(dimensions), bits, cell_bits, file_bytes
        self.code_bits = bits * len(self.dimensions)
        self.within_bits = min(31, 62 - self.code_bits)
        if self.within_bits < 8:
            raise ValueError("too many dimensions or bits for a code of 54 bits")

    def _own(self, name: str) -> str:
        """A column name of the run's own that no column of the rows has."""
        return self._prefix + name

    def _key(self, values: Sequence) -> str:
        """The name of a group in a manifest."""
        return json.dumps([*values], default=str)

    def _carried(self, base: dict, planned: set[str], groups: DataFrame, in_group: list[Column]) -> dict[str, list[str]]:
        """The parts of the groups that this run does not rewrite."""
        carried = {k: v for k, v in base["parts"].items() if k.startswith("[") and k not in planned}
        if mixed := [x for k, v in base["parts"].items() if not k.startswith("[") for x in v]:  # parts of several groups, as the table's own upkeep writes them
            carried["all"] = [self.table.write_part(self.table.read(mixed, base["schema"]).join(groups, in_group, "left_anti"))]
        return carried

    def _digests(self, df: DataFrame, *by: Column | str) -> DataFrame:
        """n, sum and xor of the rows' digests."""
        d1, d2 = row_digests(df)
        return df.groupBy(*by).agg(F.count("*").alias("n"), F.sum(F.shiftrightunsigned(d1, 32)).alias("sum"), F.bit_xor(d2).alias("xor"))

    def _coordinates(self, rows: DataFrame) -> tuple[list[Column], int]:
        """The dimensions scaled to `bits`, over all rows, and the number of these."""
        kinds = {k: rows.schema[k].dataType.typeName() for k in self.dimensions}
        value = {k: F.unix_micros(c(k)) if kinds[k] == "timestamp" else c(k) for k in self.dimensions}
        ends = rows.agg(F.count("*").alias("n"), *(f(value[k]).alias(f"{n}{i}") for i, k in enumerate(self.dimensions) for n, f in (("lo", F.min), ("hi", F.max)))).first()
        return [_coordinate(c(k), kinds[k], ends[f"lo{i}"], ends[f"hi{i}"], self.bits) for i, k in enumerate(self.dimensions)], ends["n"]

    def _bounds(self, cells: DataFrame, coded: DataFrame, share: dict[int, tuple[float, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Group and place of each bound between two files of a group; share: rows of a file, and files, by group number."""
        g, cell, code, shift = F.col(self._own("no")), F.col(self._own("cell")), F.col(self._own("code")), max(0, self.code_bits - self.cell_bits)
        several = self.spark.createDataFrame([(k, *v) for k, v in share.items() if v[1] > 1], "no int, most double, files int")
        if not several.take(1):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        before = lambda by, order: F.coalesce(F.sum("n").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        # bounds lie at the ranks k * most, and a cell or code has the ranks from `since` up to `since + n`
        holds = F.ceil(F.col("since") / F.col("most")) < F.ceil((F.col("since") + F.col("n")) / F.col("most"))
        of_cells = cells.join(F.broadcast(several), g == F.col("no")).withColumn("since", before([g], cell)).where(holds).select("no", cell.alias("in_cell"), F.col("since").alias("cell_since"), "most", "files")
        there = coded.join(checked_broadcast(of_cells), (g == F.col("no")) & (F.shiftrightunsigned(code, shift) == F.col("in_cell")))
        codes = there.groupBy("no", "in_cell", "cell_since", "most", "files", code.alias("code")).agg(F.count("*").alias("n"))
        codes = codes.withColumn("since", F.col("cell_since") + before(["no", "in_cell"], F.col("code"))).where(holds)
        k = F.explode(F.sequence(F.ceil(F.col("since") / F.col("most")), F.ceil((F.col("since") + F.col("n")) / F.col("most")) - 1)).alias("k")
        part = F.floor((F.col("k") * F.col("most") - F.col("since")) / F.col("n") * (1 << self.within_bits))
        at = codes.select("*", k).where("k BETWEEN 1 AND files - 1").select("no", (F.shiftleft("code", self.within_bits) + part).cast("bigint").alias("place")).orderBy("no", "place").collect()
        return np.array([r[0] for r in at], np.int64), np.array([r[1] for r in at], np.int64)

    def compact(self, rows: DataFrame, files: DataFrame, batches: DataFrame, row_bytes: float | None = None) -> dict:
        """Rewrite what the plan names; commit the new files and the lists of those they replace."""
        return retrying(lambda: self._compact(self.table.manifest(), rows, files, batches, row_bytes))

    def _compact(self, base: dict, rows: DataFrame, files: DataFrame, batches: DataFrame, row_bytes: float | None) -> dict:
        older = StructType.fromJson(json.loads(base["schema"])).fields if base["schema"] else []
        p = self._prefix = fresh_prefix([*rows.columns, *files.columns, *(f.name for f in older)], "pack")
        schema = StructType([*rows.schema.fields, *(f for f in older if f.name not in rows.columns)]).json()
        chosen = self.table.write_part(plan(files, batches, group=self.group))
        named = self.spark.read.parquet(f"{self.table.path}/{chosen}")
        values = sorted(map(tuple, named.select(*map(c, self.group)).distinct().limit(MAX_GROUPS + 1).collect()), key=lambda v: [(x is None, x if x is not None else 0) for x in v])
        if len(values) > MAX_GROUPS:
            raise ValueError(f"more than {MAX_GROUPS} groups")
        kinds = ", ".join(f"{p}g{i} {rows.schema[g].dataType.simpleString()}" for i, g in enumerate(self.group))
        groups = self.spark.createDataFrame([(*v, i) for i, v in enumerate(values)], f"{kinds}, {p}no int")
        done = batches.select(F.col("batch_id").alias(f"{p}b")).where(F.col(f"{p}b").isNotNull()).distinct()
        in_group = [c(g).eqNullSafe(F.col(f"{p}g{i}")) for i, g in enumerate(self.group)]
        parts = self._carried(base, {self._key(v) for v in values}, groups, in_group)
        few = is_small(done)
        scope = rows.join(F.broadcast(groups), in_group).join(F.broadcast(done) if few else done, F.col("batch_id") == F.col(f"{p}b"), "left_semi").select(*map(c, rows.columns), f"{p}no")  # a row for each group
        staged = None
        if not few:  # the join shuffles whole rows, so it is done once and its result is read from then on
            staged = self.table.write_part(scope)
            scope = self.table.read([staged], scope.schema.json())
        at, n_rows = self._coordinates(rows)
        if row_bytes is None:
            row_bytes = _row_bytes(rows, n_rows)
        coded = scope.withColumn(self._own("code"), hilbert_column(at, self.bits))
        cell = F.shiftrightunsigned(self._own("code"), max(0, self.code_bits - self.cell_bits)).alias(self._own("cell"))
        d1, d2 = row_digests(rows)
        cells = coded.groupBy(F.col(self._own("no")), cell).agg(F.count("*").alias("n"), F.sum(F.shiftrightunsigned(d1, 32)).alias("sum"), F.bit_xor(d2).alias("xor")).persist()
        try:
            source = {r[0]: (r[1], r[2], r[3]) for r in cells.groupBy(self._own("no")).agg(F.sum("n"), F.sum("sum"), F.bit_xor("xor")).collect()}
            size = max(self.file_bytes, sum(n for n, *_ in source.values()) * row_bytes / MAX_FILES)
            share = {g: (n / k, k) for g, (n, *_) in source.items() for k in [min(n, max(1, round(n * row_bytes / size)))]}
            bounds = self._bounds(cells, coded, share)
        finally:
            cells.unpersist()
        first, n_files = np.zeros(len(values), np.int64), 0
        for g in sorted(source):
            first[g], n_files = n_files, n_files + share[g][1]
        if source:
            shared = self.spark.sparkContext.broadcast(bounds)
            where = file_column(at, self.bits, F.col(self._own("no")), F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << self.within_bits)), self.within_bits, shared, first)
            routed = scope.withColumn(self._own("at"), where).select(*map(c, rows.columns), self._own("no"), F.col(self._own("at"))["code"].alias(self._own("code")), F.col(self._own("at"))["file"].alias(self._own("file")))
            # a file has rows of one group only, so writing by group makes no more files
            placed = routed.repartitionById(n_files, F.col(self._own("file"))).sortWithinPartitions(self._own("no"), self._own("code"))
            folders = self.table.buckets_of(self.table.write_part(placed.drop(self._own("code"), self._own("file")), self._own("no")))
            self._verify(self.table.read([*folders.values()], rows.schema.json()), {values[g]: s for g, s in source.items()})
            parts |= {self._key(values[int(g)]): [folder] for g, folder in folders.items()}
        if staged:
            self.table.files.delete(f"{self.table.path}/{staged}")
        # all groups are verified now (those without rows have nothing to lose): these are the files that the new ones replace
        replaced = self.table.write_part(named.join(F.broadcast(groups), in_group, "left_semi"))
        whole = self.table.write_part(members(files, batches, F.broadcast(groups), in_group))
        self.table.files.delete(f"{self.table.path}/{chosen}")
        return self.table.commit(base, parts, schema, "compact", plan=replaced, superseded=whole, extra_parts=[replaced, whole], files=n_files, rows=sum(n for n, *_ in source.values()))

    def _verify(self, written: DataFrame, source: dict) -> None:
        got = self._digests(written, *map(c, self.group)).collect()
        there = {tuple(r)[: len(self.group)]: tuple(r)[len(self.group) :] for r in got}
        if there != source:
            raise DigestMismatch(f"{self.table.path}: digests of {sum(there.get(g) != s for g, s in source.items())} groups differ")

    def replaced(self, version: int | None = None) -> DataFrame:
        """The small files that a committed, verified rewrite was planned for."""
        return self.spark.read.parquet(f"{self.table.path}/{self.table.manifest(version)['properties']['plan']}")

    def superseded(self, version: int | None = None) -> DataFrame:
        """All files whose rows a committed, verified rewrite holds: those to remove when it is put in place."""
        return self.spark.read.parquet(f"{self.table.path}/{self.table.manifest(version)['properties']['superseded']}")

    def rows(self) -> DataFrame:
        """The rows of all groups rewritten so far."""
        return self.table.live()

    def consolidated(self, rows: DataFrame, batches: DataFrame) -> DataFrame:
        """The whole table, every row of a recorded run once.

        rows, batches: those of the last run or younger ones. A recorded batch gets no more rows, so a batch and group
        that the new files hold is read from them, any other from `rows`.
        """
        new = self.rows()
        p = fresh_prefix([*rows.columns, *new.columns], "pack")
        done = batches.select(F.col("batch_id").alias(f"{p}b")).where(F.col(f"{p}b").isNotNull()).distinct()
        held = new.select(*(c(g).alias(f"{p}g{i}") for i, g in enumerate(self.group)), F.col("batch_id").alias(f"{p}b")).distinct()
        at = F.col("batch_id") == F.col(f"{p}b")
        recorded = rows.join(checked_broadcast(done), at, "left_semi")
        left = recorded.join(checked_broadcast(held), [*(c(g).eqNullSafe(F.col(f"{p}g{i}")) for i, g in enumerate(self.group)), at], "left_anti")
        return left.unionByName(new, allowMissingColumns=True)
