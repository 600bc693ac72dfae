"""Differences between two copies of data: rows missing on either side, and values that differ, field by field.

Both sides are brought together by range of the key, once: each partition holds the rows of its keys from both sides,
merged in key order, and numbers them. That number is the key's shared ordinal, dense within a partition and stable
once written. Each side's presence is a bitmap for each block of 32,768 ordinals, built by partial aggregation and
kept compressed. AND-NOT of two bitmaps marks the missing ordinals, AND the common ones; the written rows, aligned
by ordinal, are read against these marks block by block: a marked row is missing, or is compared column by column.

A side with several rows for a key is first reduced to one (`latest`), by a rank that is limited in each task
before the shuffle, so a key with a third of all rows is no burden. Marks are 12 KB for a block of 32,768 rows; they
are broadcast while they are few (`MARK_BLOCKS`), else joined by block, and nothing is collected.

Nulls and the like: rows without key are left out; two values differ unless equal or both null (NaN equals NaN);
an empty side makes every key of the other missing; columns of one side only are ignored, and columns may have
any names, since fields travel in a struct.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.columns import c, fresh, tie_break
from tidemark.functions.joins import checked_broadcast
from tidemark.session import work_dir

#: Bits of a block, as Spark's bitmap functions have them; blocks whose marks are broadcast (50 MB at most).
BLOCK, MARK_BLOCKS = 32_768, 4_096


def latest(df: DataFrame, key: str, by: str) -> DataFrame:
    """One row for each key: the one with the latest `by`; which of equals is fixed by an order over all columns."""
    rank = fresh(df.columns, "latest_rank")
    w = Window.partitionBy(c(key)).orderBy(c(by).desc_nulls_last(), *tie_break(df, [key, by]))
    return df.where(c(key).isNotNull()).withColumn(rank, F.row_number().over(w)).where(c(rank) == 1).drop(rank)


def aligned(spark: SparkSession, a: DataFrame, b: DataFrame, key: str, fields: Sequence[str], path: str) -> DataFrame:
    """ordinal, key, a, b: a row for each key of either side, with its rows of both (null where a side has none).

    Written once, as ordinals must not change when a task runs again.
    """
    row = lambda df: F.struct(*(c(f).alias(f"f{i}") for i, f in enumerate(fields)), F.lit(True).alias("present"))
    sides = {n: df.where(c(key).isNotNull()).select(c(key).alias("key"), row(df).alias(n)) for n, df in (("a", a), ("b", b))}
    both = sides["a"].unionByName(sides["b"], allowMissingColumns=True)
    # the range partitioning serves the grouping too; its rows come out in key order
    merged = both.repartitionByRange("key").groupBy("key").agg(F.first("a", ignorenulls=True).alias("a"), F.first("b", ignorenulls=True).alias("b"))
    merged.sortWithinPartitions("key").withColumn("ordinal", F.monotonically_increasing_id()).write.parquet(path)
    return spark.read.parquet(path)


def _pack(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for x in blocks:
        for s in ("a", "b"):
            x[s] = [None if v is None else zlib.compress(v, 1) for v in x[s]]
        yield x[["block", "a", "b"]]


def presence_bitmaps(rows: DataFrame) -> DataFrame:
    """block, a, b: compressed bitmaps of the ordinals each side has; null where it has none in the block."""
    at = F.expr(f"ordinal % {BLOCK}")
    bits = rows.groupBy(F.expr(f"ordinal DIV {BLOCK}").alias("block")).agg(*(F.bitmap_construct_agg(F.when(F.col(f"has_{s}"), at)).alias(s) for s in ("a", "b")))
    return bits.mapInPandas(_pack, "block bigint, a binary, b binary")


def _bits(v: bytes | None) -> np.ndarray:
    return np.zeros(BLOCK // 8, np.uint8) if v is None else np.frombuffer(zlib.decompress(v), np.uint8)


def _set_algebra(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for x in blocks:
        a, b = ([*map(_bits, x[s])] for s in ("a", "b"))
        marks = {"only_a": lambda p, q: p & ~q, "only_b": lambda p, q: q & ~p, "both": lambda p, q: p & q}
        yield pd.DataFrame({"block": x["block"], **{n: [f(p, q).tobytes() for p, q in zip(a, b, strict=True)] for n, f in marks.items()}})


def differences(spark: SparkSession, a: DataFrame, b: DataFrame, key: str, fields: Sequence[str], missing_in_a: str = "missing_in_a", missing_in_b: str = "missing_in_b", path: str | None = None) -> DataFrame:
    """key, field, value_a, value_b: a row for each key missing on a side (values null) and for each differing field.

    Both sides must have one row for each key (see `latest`).
    """
    path = path or work_dir(spark, "compare")
    rows = aligned(spark, a, b, key, fields, f"{path}/rows")
    present = rows.select("ordinal", F.col("a").isNotNull().alias("has_a"), F.col("b").isNotNull().alias("has_b"))
    presence_bitmaps(present).write.parquet(f"{path}/bitmaps")
    marks = spark.read.parquet(f"{path}/bitmaps").mapInPandas(_set_algebra, "block bigint, only_a binary, only_b binary, both binary")
    j = rows.withColumn("block", F.expr(f"ordinal DIV {BLOCK}")).join(checked_broadcast(marks, MARK_BLOCKS), "block")
    at = F.expr(f"CAST(ordinal % {BLOCK} AS INT)")
    # one byte of a mark, as a number, and its bit
    is_in = lambda m: F.getbit(F.conv(F.hex(F.substring(F.col(m), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int"), at % 8) == 1
    text = lambda x: x.cast("string") if x is not None else F.lit(None).cast("string")
    cell = lambda cond, name, va=None, vb=None: F.when(cond, F.struct(F.lit(name).alias("field"), text(va).alias("value_a"), text(vb).alias("value_b")))
    pairs = [(f, F.col(f"a.f{i}"), F.col(f"b.f{i}")) for i, f in enumerate(fields)]
    compared = F.array(*(cell(~va.eqNullSafe(vb), f, va, vb) for f, va, vb in pairs)) if pairs else F.array(cell(F.lit(False), ""))
    cells = F.when(is_in("both"), compared).when(is_in("only_a"), F.array(cell(F.lit(True), missing_in_b))).when(is_in("only_b"), F.array(cell(F.lit(True), missing_in_a)))
    out = j.select("key", F.array_compact(cells).alias("cells")).where(F.size("cells") > 0)
    return out.select(F.col("key").alias(key), F.inline("cells"))
