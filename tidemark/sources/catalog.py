"""Tables in the session's catalog: namespaces, the items table and its ledgers, existence, removal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.schema import BATCHES, ITEMS, OFFSETS


def create_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}")


def namespaces(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW NAMESPACES")


def create_table(spark: SparkSession, name: str, schema: StructType, partitions: tuple[str, ...] = (), provider: str = "parquet") -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {provider}{by} TBLPROPERTIES ('parquet.compression' = 'snappy')")


def create_items(spark: SparkSession, name: str) -> None:
    create_table(spark, name, ITEMS, ("year", "month"))


def create_ledgers(spark: SparkSession, offsets: str, batches: str) -> None:
    create_table(spark, offsets, OFFSETS)
    create_table(spark, batches, BATCHES)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name} PURGE")
