"""Verdicts on connectors, from the JSON documents their REST interface gives.

Nulls and the like: a document that does not parse, or lacks the connector's state, is not running; an empty task
list counts as running; a missing lag metric is acceptable, as nothing says otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import c
from tidemark.operators.validate import LAG_MILLIS
from tidemark.schema import CONNECTOR_METRICS, CONNECTOR_STATUS


def connector_status(docs: DataFrame, name: str = "connector", document: str = "status") -> DataFrame:
    """name, connector_state, tasks, failed_tasks, running, failure (what the first failed task says)."""
    d = docs.select(c(name), F.from_json(c(document), CONNECTOR_STATUS).alias("s"))
    tasks = F.coalesce(F.col("s.tasks.state"), F.array().cast("array<string>"))
    return d.select(
        c(name),
        F.col("s.connector.state").alias("connector_state"),
        F.size(tasks).alias("tasks"),
        F.size(F.filter(tasks, lambda x: F.coalesce(x != "RUNNING", F.lit(True)))).alias("failed_tasks"),
        (F.coalesce(F.col("s.connector.state") == "RUNNING", F.lit(False)) & F.forall(tasks, lambda x: F.coalesce(x == "RUNNING", F.lit(False)))).alias("running"),
        F.get(F.filter("s.tasks", lambda x: F.coalesce(x["state"] != "RUNNING", F.lit(True))), F.lit(0))["trace"].alias("failure"),
    )


def all_running(status: DataFrame) -> DataFrame:
    return status.agg(F.coalesce(F.every("running"), F.lit(True)).alias("all_running"), F.count("*").alias("connectors"))


def replication_lag(docs: DataFrame, name: str = "connector", state: str = "state", metrics: str = "metrics") -> DataFrame:
    """name, lag_millis (the greatest of its tasks), is_acceptable."""
    lag = F.array_max(F.transform(F.from_json(c(metrics), CONNECTOR_METRICS).getField("tasks"), lambda t: t.getField("metrics").getField("lag-in-millis")))
    d = docs.select(c(name), c(state).alias("state"), lag.alias("lag_millis"))
    ok = F.coalesce(F.col("state") == "RUNNING", F.lit(False)) & F.coalesce(F.col("lag_millis") <= LAG_MILLIS, F.lit(True))
    return d.withColumn("is_acceptable", ok)
