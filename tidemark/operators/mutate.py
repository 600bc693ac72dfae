"""Create, read, update and delete on a table of rows, as whole-table transformations.

Each takes a table of requests, so any number of them is one job. A request that does not apply (a name taken, an
id missing) is given back by the function that tells them apart, as the service's errors 400 and 404 did.

Nulls and the like: null keys match nothing; of several requests for one key the one with the greatest values
counts (a stated tie-break); empty requests change nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import c
from tidemark.operators.merge import latest_per_key


def insert_if_absent(table: DataFrame, requests: DataFrame, name: str = "name") -> tuple[DataFrame, DataFrame]:
    """(the table with the new rows, requests refused because the name is taken). Null names are never taken."""
    new = latest_per_key(requests, name, [x for x in requests.columns if x != name]).where(c(name).isNotNull()).unionByName(requests.where(c(name).isNull()))
    names = table.select(c(name)).where(c(name).isNotNull()).distinct()
    return table.unionByName(new.join(names, name, "left_anti").select(*table.columns)), requests.join(names, name, "left_semi")


def update_by_key(table: DataFrame, requests: DataFrame, key: str = "id", columns: Sequence[str] = ("name", "description", "price", "on_offer")) -> tuple[DataFrame, DataFrame]:
    """(the table with columns overwritten, requests whose key is missing)."""
    r = latest_per_key(requests.where(c(key).isNotNull()), key, columns).select(c(key).alias("request_key"), F.struct(*(c(x) for x in columns)).alias("request"))
    j = table.join(r, c(key) == F.col("request_key"), "left")
    out = j.select(*(F.when(F.col("request").isNotNull(), F.col("request").getField(x)).otherwise(c(x)).alias(x) if x in columns else c(x) for x in table.columns))
    return out, requests.join(table.select(c(key)).where(c(key).isNotNull()).distinct(), key, "left_anti")


def delete_by_key(table: DataFrame, keys: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(what stays, the rows deleted, keys that were missing)."""
    ks = keys.select(c(key)).where(c(key).isNotNull()).distinct()
    return table.join(ks, key, "left_anti").select(*table.columns), table.join(ks, key, "left_semi").select(*table.columns), ks.join(table.select(c(key)), key, "left_anti")


def select_all(table: DataFrame) -> DataFrame:
    return table


def select_by_key(table: DataFrame, value, key: str = "id") -> DataFrame:
    return table.where(c(key) == F.lit(value))
