"""Upkeep of versioned tables: what to compact, which snapshots to expire, which files nobody refers to.

These work on listings as DataFrames, so they hold for any number of files; `store.SnapshotTable` has the calls
that act on a table, and `compaction.Compactor` rewrites rows.

Nulls and the like: files listed twice count once; null sizes and times never make a file a candidate; ties in
snapshot times are settled by the greater id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import c
from tidemark.store import SnapshotTable


def compaction_plan(files: DataFrame, group: Sequence[str], path: str = "file_path", size: str | None = None, least: int = 5) -> DataFrame:
    """group, files[, bytes]: groups with at least `least` distinct files."""
    one = files.where(c(path).isNotNull()).groupBy(*map(c, group), c(path)).agg(F.max(c(size)).alias("bytes") if size else F.lit(0).alias("bytes"))
    out = one.groupBy(*map(c, group)).agg(F.count("*").alias("files"), *([F.sum("bytes").alias("bytes")] if size else []))
    return out.where(F.col("files") >= least)


def expired_snapshots(snapshots: DataFrame, now: Column, days: int = 30, retain_last: int = 5, time: str = "made_current_at", snapshot: str = "snapshot_id") -> DataFrame:
    """Snapshots older than `days` that are not among the last `retain_last`."""
    keep = snapshots.select(c(snapshot), c(time)).orderBy(c(time).desc_nulls_last(), c(snapshot).desc()).limit(retain_last).select(c(snapshot))
    return snapshots.where(c(time) < now - F.expr(f"INTERVAL {int(days)} DAYS")).join(keep, snapshot, "left_anti")


def orphan_files(listing: DataFrame, referenced: DataFrame, now: Column, path: str = "file_path", modified: str = "modified_at", days: int = 3) -> DataFrame:
    """Listed files that no manifest refers to and that are old enough not to belong to a run under way."""
    return listing.where(c(modified) < now - F.expr(f"INTERVAL {int(days)} DAYS")).join(referenced.select(c(path)).distinct(), path, "left_anti")


def history(table: SnapshotTable) -> DataFrame:
    return table.history()


def latest_snapshot(snapshots: DataFrame, time: str = "made_current_at", snapshot: str = "snapshot_id") -> DataFrame:
    return snapshots.orderBy(c(time).desc_nulls_last(), c(snapshot).desc()).limit(1)


def old_snapshots(snapshots: DataFrame, now: Column, days: int = 7, time: str = "made_current_at") -> DataFrame:
    return snapshots.where(c(time) < now - F.expr(f"INTERVAL {int(days)} DAYS"))


def optimize(table: SnapshotTable, days_to_retain: int = 30, retain_last: int = 5, orphan_days: float = 3, least: int = 5, files: int | None = None) -> dict[str, list]:
    """Fold a table's parts into one if it has at least `least`, expire old versions, then remove the parts nothing refers to any more.

    Only plain tables of appended parts are folded; bucketed ones rewrite their buckets as they take changes. Failures
    are raised, not swallowed.
    """
    parts = table.manifest()["parts"]
    fold = set(parts) == {"all"} and len(parts["all"]) >= least
    compacted = [table.compact(files)["version"]] if fold else []
    return {"compacted": compacted, "expired": table.expire(days_to_retain * 86400, retain_last), "removed": table.remove_orphans(orphan_days * 86400)}
