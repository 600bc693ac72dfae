"""Validation of a target against its source; every check is one DataFrame of one row with its verdict.

`as_result` turns such a row into a dictionary and, should the check fail to run, into one with `error` and a false
verdict, so that a suite goes on. No check collects rows, sorts globally or asks for keys one by one.

Nulls and the like: counts include rows of nulls; a source of 0 rows has a difference of 0 %; empty tables have
equal checksums; null keys are compared null-safely in samples; lags ignore rows without time.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import c
from tidemark.store import Files

#: Limits the checks compare with.
ROW_COUNT_PERCENT, MATCH_RATE, LAG_MILLIS, LAG_SECONDS, FRESH_MINUTES = 0.1, 0.99, 60_000, 300, 30
SUITE_GOOD, SUITE_WARNING = 95, 80
HEALTH_GOOD, HEALTH_WARNING = 90, 70


def row_count(source: DataFrame, target: DataFrame) -> DataFrame:
    s, t = source.agg(F.count("*").alias("source_count")), target.agg(F.count("*").alias("target_count"))
    diff = F.abs(F.col("source_count") - F.col("target_count"))
    percent = F.when(F.col("source_count") == 0, F.lit(0.0)).otherwise(diff / F.col("source_count") * 100)
    both = s.join(F.broadcast(t))  # one row each
    return both.withColumns({"difference": diff, "difference_percentage": percent}).withColumn("is_valid", F.col("difference_percentage") <= ROW_COUNT_PERCENT)


def row_text(df: DataFrame, columns: Sequence[str]) -> Column:
    return F.concat_ws("#", *(F.coalesce(c(x).cast("string"), F.lit("")) for x in columns))


def table_checksum(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """checksum: an MD5 tree over the rows' texts; equal for equal tables, whatever the order of their rows.

    Texts, each with the number of rows that have it, are grouped by the first `digits` hexadecimal digits of their
    MD5 (with 6, a group of a table of 10^12 different texts has 60,000); a group's checksum is the MD5 of its sorted
    texts, and groups are joined by two digits at a time up to the root. Checksums with other `digits` differ.
    """
    texts = df.select(row_text(df, columns).alias("t")).groupBy("t").agg(F.count("*").alias("n"))
    one = F.concat(F.col("t"), F.lit("*"), F.col("n").cast("string"))
    joined = lambda x: F.md5(F.array_join(F.sort_array(F.collect_list(x)), ","))
    nodes = texts.groupBy(F.substring(F.md5("t"), 1, digits).alias("p")).agg(joined(one).alias("m"))
    while digits > 2:
        digits -= 2
        nodes = nodes.groupBy(F.substring("p", 1, digits).alias("p")).agg(joined(F.concat("p", F.lit(":"), "m")).alias("m"))
    return nodes.agg(joined(F.concat("p", F.lit(":"), "m")).alias("checksum"))


def table_digest(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """rows, digest_sum, digest_xor: an order-free digest by partial aggregation, for tables of any size."""
    t = row_text(df, columns)
    return df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.xxhash64(t).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("digest_sum"), F.coalesce(F.bit_xor(F.xxhash64(F.lit(7), t)), F.lit(0)).alias("digest_xor"))


def checksum_match(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Compared by digest; both digests and the verdict."""
    s = table_digest(source, columns).select(F.struct("*").alias("source"))
    t = table_digest(target, columns).select(F.struct("*").alias("target"))
    return s.join(F.broadcast(t)).withColumn("is_valid", F.col("source") == F.col("target"))


def sample_keys(source: DataFrame, key: str, size: int = 1000) -> DataFrame:
    """A sample by hash order of the key: the same in every run, and a top-k, not a sort."""
    return source.select(c(key)).orderBy(F.md5(c(key).cast("string")), c(key)).limit(size)


def sample_counts(source: DataFrame, target: DataFrame, key: str, size: int = 1000) -> DataFrame:
    """key, matches: how many target rows each sampled key has, in one join."""
    sample = sample_keys(source, key, size).select(c(key).alias("sample_key"))
    hits = target.join(F.broadcast(sample), c(key).eqNullSafe(F.col("sample_key")), "inner").groupBy("sample_key").agg(F.count("*").alias("n"))
    return sample.alias("s").join(hits.alias("h"), F.col("s.sample_key").eqNullSafe(F.col("h.sample_key")), "left").select(F.col("s.sample_key").alias(key), F.coalesce("n", F.lit(0)).alias("matches"))


def sample_match(source: DataFrame, target: DataFrame, key: str, size: int = 1000) -> DataFrame:
    """A key matches if exactly one target row has it."""
    n = sample_counts(source, target, key, size)
    out = n.agg(F.count("*").alias("sample_size"), F.count(F.when(F.col("matches") == 1, 1)).alias("matched_records"))
    out = out.withColumn("match_rate", F.when(F.col("sample_size") > 0, F.col("matched_records") / F.col("sample_size")).otherwise(F.lit(0.0)))
    return out.withColumns({"mismatch_count": F.col("sample_size") - F.col("matched_records"), "is_valid": F.col("match_rate") >= MATCH_RATE})


def sample_mismatches(source: DataFrame, target: DataFrame, key: str, size: int = 1000, show: int = 5) -> DataFrame:
    bad = sample_counts(source, target, key, size).where("matches <> 1")
    return bad.orderBy(c(key)).limit(show).select(c(key), (F.col("matches") > 0).alias("found_in_target"), (F.col("matches") > 1).alias("multiple_matches"))


def primary_key_check(df: DataFrame, key: str) -> DataFrame:
    """rows, duplicate_keys, null_keys, is_unique."""
    per = df.groupBy(c(key).alias("k")).agg(F.count("*").alias("n"))
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.when(F.col("k").isNotNull() & (F.col("n") > 1), 1)).alias("duplicate_keys"), F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).alias("null_keys")
    ).withColumn("is_unique", (F.col("duplicate_keys") == 0) & (F.col("null_keys") == 0))


def recent(df: DataFrame, time: str, since: Column, tie: str, limit: int = 100) -> DataFrame:
    """The latest rows after a time: the feature is a top-k report."""
    return df.where(c(time) > since).orderBy(c(time).desc(), c(tie)).limit(limit)


def combined_lag(source: DataFrame, loads: DataFrame, time: str, loaded: str) -> DataFrame:
    """Lag in seconds between event and load time, over event times that both sides have; acceptable up to 300 s on average."""
    one = loads.where(c(time).isNotNull()).groupBy(c(time)).agg(F.max(c(loaded)).alias("loaded"))
    j = source.select(c(time)).where(c(time).isNotNull()).distinct().join(one, time)
    lag = (F.unix_micros(F.col("loaded").cast("timestamp")) - F.unix_micros(c(time).cast("timestamp"))) / F.lit(1e6)
    out = j.select(lag.alias("lag")).agg(F.avg("lag").alias("avg_lag_seconds"), F.min("lag").alias("min_lag_seconds"), F.max("lag").alias("max_lag_seconds"), F.count("lag").alias("samples_count"))
    return out.withColumn("is_acceptable", F.coalesce(F.col("avg_lag_seconds") <= LAG_SECONDS, F.lit(False)))


def message_lag(log: DataFrame, processed: DataFrame, by: Sequence[str] = ("topic", "partition"), offset: str = "offset") -> DataFrame:
    """How far processing has come in each topic partition: last logged and last processed offset, and messages between them.

    A partition that was never processed counts from its first message; one that nothing was logged for has no row.
    """
    head = log.where(c(offset).isNotNull()).groupBy(*map(c, by)).agg(F.min(c(offset)).alias("first_offset"), F.max(c(offset)).alias("last_offset"))
    done = processed.where(c(offset) >= 0).groupBy(*map(c, by)).agg(F.max(c(offset)).alias("processed_offset"))
    j = head.join(done, list(by), "left")
    return j.select(*map(c, by), "last_offset", "processed_offset", F.greatest(F.lit(0), F.col("last_offset") - F.coalesce("processed_offset", F.col("first_offset") - 1)).alias("behind"))


def default_key(df: DataFrame, key: str | None = None) -> str:
    """The column that tells rows apart: the one given, else the first one."""
    if key:
        return key
    if not df.columns:
        raise ValueError("a table without columns has no key")
    return df.columns[0]


def data_freshness(df: DataFrame, time: str, now: Column, minutes: int = FRESH_MINUTES) -> DataFrame:
    """The latest time, its age in seconds, and whether that is within the limit; a table without times is not fresh."""
    out = df.agg(F.max(c(time)).alias("latest"))
    age = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("latest").cast("timestamp"))) / F.lit(1e6)
    return out.withColumn("age_seconds", age).withColumn("is_fresh", F.coalesce(F.col("age_seconds") <= minutes * 60, F.lit(False)))


def event_type_counts(df: DataFrame, column: str = "operation") -> DataFrame:
    return df.groupBy(c(column).alias("event_type")).agg(F.count("*").alias("events"))


def partition_balance(df: DataFrame, by: Sequence[str], small: int = 1000) -> DataFrame:
    """How even partitions are: their number, least, greatest and mean rows, how many are small, and whether one is skewed."""
    per = df.groupBy(*map(c, by)).agg(F.count("*").alias("n"))
    out = per.agg(F.count("*").alias("partitions"), F.min("n").alias("least_rows"), F.max("n").alias("most_rows"), F.avg("n").alias("mean_rows"), F.count(F.when(F.col("n") < small, 1)).alias("small_partitions"))
    return out.withColumn("is_skewed", F.coalesce(F.col("most_rows") > 10 * F.col("mean_rows"), F.lit(False)))


def table_health(snapshots: DataFrame, manifests: DataFrame, balance: DataFrame, now: Column, time: str = "made_current_at") -> DataFrame:
    """A score from 100: less for old snapshots, many manifests, a skewed partition and many small partitions."""
    s = snapshots.agg(F.count("*").alias("snapshots_count"), F.count(F.when(c(time) < now - F.expr("INTERVAL 7 DAYS"), 1)).alias("old_snapshots"), F.max(c(time)).alias("last_modified"))
    m = manifests.agg(F.count("*").alias("manifests_count"))
    j = s.join(F.broadcast(m)).join(F.broadcast(balance))
    old, man, small = F.col("old_snapshots"), F.col("manifests_count"), F.col("small_partitions")
    lost = (
        F.when(old > 5, F.least(F.lit(20), old * 2)).otherwise(0)
        + F.when(man > 100, F.least(F.lit(20), F.floor((man - 100) / 10))).otherwise(0)
        + F.when(F.col("is_skewed"), 15).otherwise(0)
        + F.when(small > 10, F.least(F.lit(10), F.floor(small / 2))).otherwise(0)
    )
    j = j.withColumn("health_score", (F.lit(100) - lost).cast("int"))
    return j.withColumn("health_level", F.when(F.col("health_score") < HEALTH_WARNING, "Poor").when(F.col("health_score") < HEALTH_GOOD, "Warning").otherwise("Good"))


def suite_summary(verdicts: DataFrame, passed: str = "passed") -> DataFrame:
    """checks, passed_checks, success_rate and level of a table of verdicts."""
    out = verdicts.agg(F.count("*").alias("checks"), F.count(F.when(c(passed), 1)).alias("passed_checks"))
    out = out.withColumn("success_rate", F.when(F.col("checks") > 0, F.col("passed_checks") / F.col("checks") * 100).otherwise(F.lit(0.0)))
    return out.withColumn("level", F.when(F.col("success_rate") >= SUITE_GOOD, "Good").when(F.col("success_rate") >= SUITE_WARNING, "Warning").otherwise("Poor"))


def as_result(check: Callable[[], DataFrame], name: str, verdict: str = "is_valid") -> dict:
    """The row of a check as a dictionary; an error becomes a false verdict with its text."""
    base = {"validation_type": name, "timestamp": datetime.now().isoformat()}
    try:
        return {**base, **check().first().asDict(recursive=True)}
    except Exception as e:
        return {**base, verdict: False, "error": str(e).splitlines()[0]}


def run_suite(
    spark: SparkSession, source: DataFrame, target: DataFrame, key: str | None = None, time: str | None = None, snapshots: DataFrame | None = None, manifests: DataFrame | None = None, partitions: Sequence[str] = ("year", "month"),
    sample_size: int = 1000, columns: Sequence[str] = (), source_time: str | None = None, loaded: str = "processing_time", log: DataFrame | None = None, offsets: DataFrame | None = None, operation: str = "operation",
) -> dict:
    """All checks there is data for, each guarded, and their summary.

    Counted in the rate: row count, sampling, checksum (of `columns`), combined lag (`source_time` on both sides) and
    freshness. Health, how far the log has been processed and the kinds of events are reported beside it.
    """
    key = default_key(source, key)
    results = {"row_count": as_result(lambda: row_count(source, target), "row_count"), "sampling": as_result(lambda: sample_match(source, target, key, sample_size), "sampling")}
    if snapshots is not None:
        health = as_result(lambda: table_health(snapshots, snapshots if manifests is None else manifests, partition_balance(target, partitions), F.current_timestamp()), "table_health", "healthy")
        results["table_health"] = {**health, "healthy": health.get("health_score", 0) >= HEALTH_WARNING}
    if columns:
        results["checksum"] = as_result(lambda: checksum_match(source, target, columns), "checksum")
    if source_time:
        lag = as_result(lambda: combined_lag(source, target, source_time, loaded), "combined_lag", "is_acceptable")
        results["combined_lag"] = {**lag, "is_valid": lag["is_acceptable"]}
    if log is not None and offsets is not None:
        results["message_tracking"] = as_result(lambda: message_lag(log, offsets).agg(F.count("*").alias("partitions"), F.coalesce(F.sum("behind"), F.lit(0)).alias("behind")), "message_tracking", "tracked")
    if operation in target.columns:
        kinds = F.map_from_entries(F.collect_list(F.struct(F.coalesce("event_type", F.lit("null")), "events")))  # a row for each kind
        results["event_types"] = as_result(lambda: event_type_counts(target, operation).agg(kinds.alias("events")), "event_types", "counted")
    if time:
        results["freshness"] = as_result(lambda: data_freshness(target, time, F.current_timestamp()), "freshness", "is_fresh")
    ok = [r.get("is_valid", r.get("is_fresh", False)) for n, r in results.items() if n not in ("table_health", "message_tracking", "event_types")]
    summary = suite_summary(spark.createDataFrame([(bool(x),) for x in ok], "passed boolean")).first().asDict()
    return {"results": results, "summary": summary}


def save_results(spark: SparkSession, results: dict, folder: str, table: str) -> str | None:
    """Write results as JSON under a name with a time stamp, to any file system Spark reaches; None if that fails."""
    try:
        files = Files(spark, folder)
        at = f"{files.root}/{table}_validation_{datetime.now():%Y%m%d_%H%M%S_%f}.json"
        return at if files.create(at, json.dumps(results, indent=2, default=str)) else None
    except Exception:  # what the file system says is a Java exception
        return None
