"""Change logs as streams: Kafka where its package is there, a Parquet log for tests and replays.

The Parquet log stands in for a broker: its rows have topic, partition and offset, and reading it as a stream
keeps track of files. Options for Kafka are built here for both kinds of consumer:
at least once from the latest offset, exactly once from the earliest with committed reads only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.schema import LOG


def kafka_options(servers: str, topic: str, exactly_once: bool = True, starting: str | None = None, batch: int = 100) -> dict[str, str]:
    """Options of Spark's Kafka source. `starting`: JSON from ledger.starting_offsets, or earliest or latest."""
    out = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting or ("earliest" if exactly_once else "latest"), "maxOffsetsPerTrigger": str(batch), "failOnDataLoss": "true"}
    if exactly_once:
        out["kafka.isolation.level"] = "read_committed"
    return out


def kafka_stream(spark: SparkSession, **options: str) -> DataFrame:
    """The topic as rows of LOG; needs the Kafka package on the class path."""
    df = spark.readStream.format("kafka").options(**options).load()
    return df.selectExpr("topic", "partition", "offset", "timestamp AS append_time", "value")


def kafka_batch(spark: SparkSession, **options: str) -> DataFrame:
    """A bounded read of a topic, as the validator's consumer made it."""
    o = {k: v for k, v in options.items() if k != "maxOffsetsPerTrigger"} | {"endingOffsets": options.get("endingOffsets", "latest")}
    return spark.read.format("kafka").options(**o).load().selectExpr("topic", "partition", "offset", "timestamp AS append_time", "value")


def parquet_stream(spark: SparkSession, path: str, schema: StructType = LOG, files_per_trigger: int = 1, only: str | None = None) -> DataFrame:
    """The files of a folder (those whose name matches `only`, if given) as a stream."""
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", str(files_per_trigger))
    return (r.option("pathGlobFilter", only) if only else r).parquet(path)


def jdbc_table(spark: SparkSession, url: str, table: str, key: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 16, **options: str) -> DataFrame:
    """A source table over JDBC, read in key ranges when bounds are given; needs the database's driver."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if key and bounds:
        r = r.option("partitionColumn", key).option("lowerBound", str(bounds[0])).option("upperBound", str(bounds[1])).option("numPartitions", str(partitions))
    return r.load()


def connector_config(name: str, host: str, database: str, table: str = "public.items", prefix: str = "postgres-connector") -> dict:
    """The source connector's registration: initial snapshot, then changes, envelopes unwrapped, deletes rewritten, tombstones kept.

    Credentials come from the caller's environment when it is posted, never from here.
    """
    return {
        "name": name,
        "config": {
            "connector.class": "io.debezium.connector.postgresql.PostgresConnector",
            "database.hostname": host,
            "database.dbname": database,
            "plugin.name": "pgoutput",
            "publication.autocreate.mode": "filtered",
            "table.include.list": table,
            "snapshot.mode": "initial",
            "topic.prefix": prefix,
            "transforms": "unwrap",
            "transforms.unwrap.type": "io.debezium.transforms.ExtractNewRecordState",
            "transforms.unwrap.drop.tombstones": "false",
            "transforms.unwrap.delete.handling.mode": "rewrite",
        },
    }


def sink_config(name: str, topics: str, table: str = "items", catalog_uri: str = "", key: str = "id", tasks: int = 1) -> dict:
    """The sink connector's registration: upserts by key into a table, deletes by the flag that `__deleted` is renamed to."""
    return {
        "name": name,
        "config": {
            "tasks.max": str(tasks),
            "topics": topics,
            "tables": table,
            "catalog.uri": catalog_uri,
            "tables.default-id-columns": key,
            "tables.upsert-mode-enabled": "true",
            "tables.cdc-field": "_deleted",
            "transforms": "rename",
            "transforms.rename.type": "org.apache.kafka.connect.transforms.ReplaceField$Value",
            "transforms.rename.renames": "__deleted:_deleted",
        },
    }


def registration(config: dict, existing: list[str]) -> list[tuple[str, str, dict | None]]:
    """The REST calls that put a connector in place: one of that name is deleted first. (method, path, body)"""
    name = config["name"]
    drop = [("DELETE", f"/connectors/{name}", None)] if name in existing else []
    return [*drop, ("POST", "/connectors", config)]


def resume_options(servers: str, topic: str, ledger: DataFrame, **more) -> dict[str, str]:
    """Kafka options that start after the ledger's last committed offsets; from the earliest where it has none."""
    from tidemark.operators.ledger import resume_offsets, starting_offsets

    at = [tuple(r) for r in resume_offsets(ledger, topic).where("topic IS NOT NULL AND partition IS NOT NULL").collect()]  # a row for each partition
    return kafka_options(servers, topic, starting=starting_offsets(at) if at else None, **more)


def snapshot_then_changes(snapshot: DataFrame, changes: DataFrame, operation: str = "operation") -> DataFrame:
    """The initial snapshot tagged `r`, followed by the changes, as one relation."""
    from pyspark.sql import functions as F

    return snapshot.withColumn(operation, F.lit("r")).unionByName(changes, allowMissingColumns=True)
