"""A deterministic workload of item operations: lists, reads, creations, updates and deletes in fixed proportions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: action: weight (fixed values of the load mix).
MIX = {"list": 3, "get": 4, "create": 2, "update": 2, "delete": 1}


def action(bucket: Column) -> Column:
    """The action of a bucket from 0 to 11."""
    out, top = None, 0
    for name, weight in MIX.items():
        top += weight
        out = F.when(bucket < top, name) if out is None else out.when(bucket < top, name)
    return out


def mix(df: DataFrame, number: Column) -> DataFrame:
    return df.withColumn("action", action(F.pmod(number, F.lit(sum(MIX.values())))))


def workload(spark: SparkSession, n: int, seed: int = 0, users: int = 10, partitions: int | None = None) -> DataFrame:
    """n operations; the same for the same seed, on any cluster."""
    df = spark.range(0, n, 1, partitions) if partitions else spark.range(n)
    h = F.xxhash64("id", F.lit(seed))
    return df.select(
        F.col("id").alias("operation_no"),
        action(F.pmod(h, F.lit(sum(MIX.values())))).alias("action"),
        F.pmod(F.xxhash64("id", F.lit(seed + 1)), F.lit(users)).cast("int").alias("user"),
        F.pmod(F.xxhash64("id", F.lit(seed + 2)), F.lit(9501)).cast("int").__add__(500).alias("price"),
        (F.pmod(F.xxhash64("id", F.lit(seed + 3)), F.lit(2)) == 0).alias("on_offer"),
        F.concat(F.lit("New Item "), F.col("id").cast("string")).alias("name"),
    )


def seed_items(spark: SparkSession, users: int = 10, per_user: int = 5) -> DataFrame:
    """The items every user starts with: price i x 1000, even ones on offer."""
    df = spark.range(users * per_user)
    i = F.pmod("id", F.lit(per_user)).cast("int")
    return df.select(F.format_string("Test Item %d-%d", (F.col("id") / per_user).cast("int"), i).alias("name"), (i * 1000).alias("price"), (i % 2 == 0).alias("on_offer"))
