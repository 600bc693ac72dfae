"""History of changing entity attributes: a bitemporal ledger.

A ledger row says that an entity had the given values from `valid_from` up to `valid_to`, and that the ledger
held this from `recorded_from` up to `recorded_to` (null: still). Rows are never overwritten: a later reading of a
snapshot that says something else ends the recorded time of the rows it supersedes and adds new ones.

Snapshots cut the valid time into slots, each from one snapshot to the next. `build` orders the readings of each
entity and slot by the time they were recorded; each holds until the next. `apply` takes late readings to a ledger
that exists, any number of recorded times at once: boundaries of the rows still held and of the slots read again are
swept in the order of slot and recorded time for each entity, which splits overlapping rows into segments; segments
under a reading are replaced from its recorded time on, their neighbours are carried. `HistoryTable` keeps a ledger
on disk and commits it load by load. `versions` reads what is held and joins neighbouring slots of equal values.

Scale: readings are reduced to one for each entity, slot and recorded time by partial aggregation before any
window, so repeated rows of one entity do not meet in a task; a window over an entity holds at most its slots
and the times they were read again, is sorted with spilling, and keeps no list of them. Only entities that a load
names are swept. The list of slots has a row for each snapshot.

Nulls and the like: rows without entity or snapshot time are left out; null values are values, equal to each
other; a null recorded time counts as the year 1900; of readings with the same recorded time and different
values the greatest counts; an entity that a snapshot does not list has no row for that slot; an empty table
gives an empty ledger; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.columns import c
from tidemark.functions.joins import checked_broadcast
from tidemark.store import SnapshotTable, retrying

#: Columns of a ledger besides the entity's; `values` is a struct of the attributes.
LEDGER = ("values", "slot_from", "slot_to", "recorded_from", "recorded_to")
LOCAL_SLOTS = 10_000
_FIRST = "timestamp'1900-01-01 00:00:00'"


def slots(readings: DataFrame, at: str = "processing_time") -> DataFrame:
    """slot, slot_at, slot_end: the snapshots in order; the last one ends at null.

    Up to `LOCAL_SLOTS` snapshots are fetched once, so that the joins with them know how few they are and no reading
    is shuffled for them; more stay distributed.
    """
    order = Window.orderBy("slot_at")
    one = readings.where(c(at).isNotNull()).select(c(at).alias("slot_at")).distinct()
    grid = one.select(F.row_number().over(order).alias("slot"), "slot_at", F.lead("slot_at").over(order).alias("slot_end"))
    few = one.limit(LOCAL_SLOTS + 1).collect()
    if len(few) > LOCAL_SLOTS:
        return grid
    times = sorted(r[0] for r in few)
    return F.broadcast(readings.sparkSession.createDataFrame(list(zip(range(1, len(times) + 1), times, [*times[1:], None], strict=False)), grid.schema))


def _readings(df: DataFrame, grid: DataFrame, entity: str, attributes: Sequence[str], at: str, recorded: str) -> DataFrame:
    """entity, slot, recorded, values; one row for each entity, slot and recorded time."""
    rows = df.where(c(entity).isNotNull() & c(at).isNotNull()).groupBy(c(entity).alias("entity"), c(at).alias("slot_at"), F.coalesce(c(recorded), F.expr(_FIRST)).alias("recorded")).agg(F.max(F.struct(*(c(a).alias(a) for a in attributes))).alias("values"))
    return rows.join(grid.select("slot", "slot_at"), "slot_at").select("entity", "slot", "recorded", "values")


def build(df: DataFrame, entity: str = "id", attributes: Sequence[str] = ("price", "on_offer"), at: str = "processing_time", recorded: str = "loaded_time", grid: DataFrame | None = None) -> DataFrame:
    """The ledger of all readings: entity and the columns of LEDGER, slots as numbers, `slot_to` exclusive."""
    grid = slots(df, at) if grid is None else grid
    r = _readings(df, grid, entity, attributes, at, recorded)
    by_slot = Window.partitionBy("entity", "slot").orderBy("recorded")
    # a reading that repeats what is held already supersedes nothing
    r = r.withColumn("same", F.coalesce(F.lag("values").over(by_slot).eqNullSafe(F.col("values")), F.lit(False))).where(~F.col("same"))
    return r.select("entity", "values", F.col("slot").alias("slot_from"), (F.col("slot") + 1).alias("slot_to"), F.col("recorded").alias("recorded_from"), F.lead("recorded").over(by_slot).alias("recorded_to")).withColumnRenamed("entity", entity)


def _sweep(held: DataFrame, upd: DataFrame) -> DataFrame:
    """What late readings change: rows that end (`closes`, with their `recorded_to`) and rows to add.

    held: entity, load and the columns of LEDGER, of rows that are held now; upd: entity, slot, recorded, values.
    """
    load = held.schema["load"].dataType
    one = held.select("entity", F.struct("values", "recorded_from", "slot_from", "slot_to", "load").alias("row"))
    no_row, no_time, no_values = (F.lit(None).cast(x) for x in (one.schema["row"].dataType, "timestamp", upd.schema["values"].dataType))
    mark = lambda pos, at, row, values: F.struct(pos.cast("int").alias("pos"), at.alias("at"), row.alias("row"), values.alias("says"))
    # every row and reading marks where it begins and where it ends; readings of a slot follow its mark in recorded order
    rows = one.select("entity", F.inline(F.array(mark(F.col("row.slot_from"), no_time, F.col("row"), no_values), mark(F.col("row.slot_to"), no_time, no_row, no_values))))
    slot = F.col("slot")
    readings = upd.select("entity", F.inline(F.array(mark(slot, no_time, no_row, no_values), mark(slot, F.col("recorded"), no_row, F.col("values")), mark(slot + 1, no_time, no_row, no_values))))
    # one shuffle by entity serves the grouping and all windows
    marks = rows.unionByName(readings).repartition("entity").groupBy("entity", "pos", "at").agg(F.max("row").alias("row"), F.max("says").alias("says"))
    sweep = Window.partitionBy("entity").orderBy("pos", F.col("at").asc_nulls_first())
    same_pos = Window.partitionBy("entity", "pos").orderBy(F.col("at").asc_nulls_first())
    read = F.col("at").isNotNull()
    s = marks.withColumns({"open": F.last("row", ignorenulls=True).over(sweep), "next": F.when(F.lead("at").over(same_pos).isNotNull(), F.col("pos") + 1).otherwise(F.lead("pos").over(sweep))})
    s = s.withColumn("open", F.when(F.col("open.slot_to") > F.col("pos"), F.col("open")))
    # a reading older than what its slot holds counts as recorded when that was: the load came after it
    s = s.withColumns({"since": F.when(read, F.greatest("at", "open.recorded_from")), "state": F.when(read, F.struct(F.col("says").alias("v"))).when(F.col("open").isNotNull(), F.struct(F.col("open.values").alias("v")))})
    s = s.withColumn("before", F.lag("state").over(same_pos))
    # a reading that repeats what is held supersedes nothing
    s = s.where(~(read & F.col("before").isNotNull() & F.col("before.v").eqNullSafe(F.col("says"))))
    s = s.withColumn("until", F.lead("since").over(same_pos))
    s = s.withColumn("cut", F.min(F.when(~read, F.col("until"))).over(Window.partitionBy("entity", "open.slot_from")))
    out = lambda closes, values, lo, hi, since, until, of: F.struct(F.lit(closes).alias("closes"), values.alias("values"), lo.cast("int").alias("slot_from"), hi.cast("int").alias("slot_to"), since.alias("recorded_from"), until.alias("recorded_to"), of.cast(load).alias("load"))
    row, cut, until, none = F.col("row"), F.col("cut"), F.col("until"), F.lit(None)
    ends = F.when(~read & row.isNotNull() & cut.isNotNull(), out(True, row["values"], row["slot_from"], row["slot_to"], row["recorded_from"], cut, row["load"]))
    # of a row that ended there remain its segments that no reading replaces from then on
    remains = F.when(~read & F.col("open").isNotNull() & cut.isNotNull() & ~until.eqNullSafe(cut), out(False, F.col("open.values"), F.col("pos"), F.col("next"), cut, until, none))
    says = F.when(read, out(False, F.col("says"), F.col("pos"), F.col("pos") + 1, F.col("since"), until, none))
    return s.select("entity", F.inline(F.array_compact(F.array(ends, remains, says))))


def _swept(ledger: DataFrame, df: DataFrame, grid: DataFrame, entity: str, attributes: Sequence[str], at: str, recorded: str) -> DataFrame:
    """`_sweep` over the entities that late readings name; what is held of all others is not looked at."""
    upd = _readings(df, grid, entity, attributes, at, recorded)
    named = upd.select(F.col("entity").alias("named")).distinct()
    held = ledger.where("recorded_to IS NULL").withColumnRenamed(entity, "entity")
    return _sweep(held.join(checked_broadcast(named), F.col("entity") == F.col("named"), "left_semi"), upd)


def _closed(ledger: DataFrame, closures: DataFrame, entity: str) -> DataFrame:
    """A ledger with its rows' `recorded_to` as closures say."""
    ends = closures.select(F.col("entity").alias("end_entity"), F.col("slot_from").alias("end_slot"), F.col("load").alias("end_load"), F.col("recorded_to").alias("end_at"))
    on = (c(entity) == F.col("end_entity")) & (F.col("slot_from") == F.col("end_slot")) & (F.col("load") == F.col("end_load")) & F.col("recorded_to").isNull()
    return ledger.join(checked_broadcast(ends), on, "left").withColumn("recorded_to", F.coalesce("recorded_to", "end_at")).select(c(entity), *LEDGER, "load")


def apply(ledger: DataFrame, df: DataFrame, grid: DataFrame, entity: str = "id", attributes: Sequence[str] = ("price", "on_offer"), at: str = "processing_time", recorded: str = "loaded_time") -> DataFrame:
    """The ledger after a load of late readings, each from its own recorded time on.

    Rows of the ledger come back unchanged, or with `recorded_to` set where a reading supersedes them; new rows carry
    the split remains and the readings. A reading older than what its slot holds already counts as recorded at the
    time of that, since its load came later.
    """
    numbered = ledger.select(c(entity), *LEDGER, F.lit(0).alias("load"))
    swept = _swept(numbered, df, grid, entity, attributes, at, recorded)
    new = swept.where(~F.col("closes")).select(F.col("entity").alias(entity), *LEDGER)
    return _closed(numbered, swept.where("closes"), entity).drop("load").unionByName(new)


def on_time_and_late(df: DataFrame, grid: DataFrame, entity: str = "id", attributes: Sequence[str] = ("price", "on_offer"), at: str = "processing_time", recorded: str = "loaded_time") -> tuple[DataFrame, DataFrame]:
    """Readings recorded before the next snapshot, and those recorded later."""
    ends = grid.select(F.col("slot_at").alias("history_at"), F.col("slot_end").alias("history_end"))
    names = list(dict.fromkeys([entity, *attributes, at, recorded]))
    marked = df.select(*map(c, names)).join(ends, c(at) == F.col("history_at")).withColumn("history_late", F.coalesce(c(recorded) >= F.col("history_end"), F.lit(False)))
    return marked.where(~F.col("history_late")).select(*map(c, names)), marked.where("history_late").select(*map(c, names))


def from_readings(df: DataFrame, grid: DataFrame, entity: str = "id", attributes: Sequence[str] = ("price", "on_offer"), at: str = "processing_time", recorded: str = "loaded_time") -> DataFrame:
    """The ledger of readings made on time, with the late ones applied; a late one supersedes whatever its slot held."""
    args = (entity, attributes, at, recorded)
    on_time, late = on_time_and_late(df, grid, *args)
    return apply(build(on_time, *args, grid=grid), late, grid, *args)


class HistoryTable:
    """A ledger on disk, committed load by load.

    A load adds two parts and rewrites none: rows, and closures that end the recorded time of earlier rows (each names
    its entity, slot and load). Its cost follows the load and what is held of the entities that it names. Snapshots are
    numbered as they come; one that is older than the last and was never seen is refused, as it would renumber the
    others. A load whose id a version names already is skipped.
    """

    def __init__(self, spark: SparkSession, path: str, entity: str = "id", attributes: Sequence[str] = ("price", "on_offer"), at: str = "processing_time", recorded: str = "loaded_time"):
        self.spark, self.table = spark, SnapshotTable(spark, path)
        self.args, self.entity, self.at = (entity, tuple(attributes), at, recorded), entity, at

    def load(self, readings: DataFrame, load_id: str, grid: DataFrame | None = None) -> dict:
        """grid: the snapshots, if the readings of this load do not name them all."""
        return retrying(lambda: self._load(self.table.manifest(), readings, load_id, grid))

    def _load(self, base: dict, readings: DataFrame, load_id: str, grid: DataFrame | None) -> dict:
        if self.table.has_batch(base, load_id):
            return base
        at = self._numbered(base, slots(readings, self.at) if grid is None else grid)
        grid = self._grid(at)
        number = F.lit(base["version"] + 1)
        parts = {k: list(v) for k, v in base["parts"].items()}
        if base["schema"] is None:
            rows = build(readings, *self.args, grid=grid).withColumn("load", number)
            parts["rows"] = [self.table.write_part(rows)]
            schema = rows.schema.json()
        else:
            schema = base["schema"]
            swept = _swept(self.ledger(base["version"], keep_load=True), readings, grid, *self.args)
            new = self.table.buckets_of(self.table.write_part(swept.withColumn("load", F.when(F.col("closes"), F.col("load")).otherwise(number)).withColumnRenamed("entity", self.entity), "closes"))
            for kind, folder in (("rows", "false"), ("closures", "true")):
                parts[kind] = parts.get(kind, []) + ([new[folder]] if folder in new else [])
        return self.table.commit(base, parts, schema, "load", grid=at, extra_parts=[at], **self.table.with_batch(base, load_id))

    def _numbered(self, base: dict, snapshots: DataFrame) -> str:
        """A part with the snapshots known so far and new ones after them."""
        known = self._grid(base["properties"]["grid"]) if "grid" in base["properties"] else None
        times = snapshots.select("slot_at")
        if known is not None:
            last = known.agg(F.max("slot_at")).first()[0]
            if last is not None and times.where(F.col("slot_at") < F.lit(last)).join(known.select("slot_at"), "slot_at", "left_anti").take(1):
                raise ValueError("a snapshot older than the last one was not known before")
            times = times.union(known.select("slot_at"))
        return self.table.write_part(slots(times, "slot_at"))

    def _grid(self, part: str) -> DataFrame:
        return checked_broadcast(self.spark.read.parquet(f"{self.table.path}/{part}"), LOCAL_SLOTS)

    def grid(self, version: int | None = None) -> DataFrame:
        return self._grid(self.table.manifest(version)["properties"]["grid"])

    def ledger(self, version: int | None = None, keep_load: bool = False) -> DataFrame:
        """The entity and the columns of LEDGER: everything ever held."""
        m = self.table.manifest(version)
        if m["schema"] is None:
            raise ValueError("nothing has been loaded yet")
        rows = self.table.read(m["parts"].get("rows", []), m["schema"])
        if ends := m["parts"].get("closures"):
            rows = _closed(rows, self.table.read(ends, m["schema"]).withColumnRenamed(self.entity, "entity"), self.entity)
        return rows if keep_load else rows.drop("load")


def as_of(ledger: DataFrame, recorded: str | None = None) -> DataFrame:
    """What the ledger held at a recorded time; what it holds now if none is given."""
    if recorded is None:
        return ledger.where("recorded_to IS NULL")
    t = F.lit(recorded).cast("timestamp")
    return ledger.where((F.col("recorded_from") <= t) & (F.col("recorded_to").isNull() | (F.col("recorded_to") > t)))


def versions(held: DataFrame, grid: DataFrame, entity: str = "id") -> DataFrame:
    """entity, values, valid_from, valid_to: neighbouring slots of equal values joined; valid_to is null for the last snapshot."""
    w = Window.partitionBy(c(entity)).orderBy("slot_from")
    begins = ~F.coalesce(F.lag("values").over(w).eqNullSafe(F.col("values")) & (F.lag("slot_to").over(w) == F.col("slot_from")), F.lit(False))
    runs = held.withColumn("run", F.sum(begins.cast("int")).over(w)).groupBy(c(entity), "run").agg(F.first("values").alias("values"), F.min("slot_from").alias("slot_from"), F.max("slot_to").alias("slot_to"))
    first = grid.select(F.col("slot").alias("slot_from"), F.col("slot_at").alias("valid_from"))
    last = grid.select((F.col("slot") + 1).alias("slot_to"), F.col("slot_end").alias("valid_to"))
    return runs.join(first, "slot_from").join(last, "slot_to").select(c(entity), "values", "valid_from", "valid_to")
