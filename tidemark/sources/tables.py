"""Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.columns import as_timestamp


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the folder; times without zone become session times (UTC)."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return as_timestamp(df, *df.columns)
