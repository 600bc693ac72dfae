"""Queries of the text problems, each through its operator over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import encode, packing, quality
from tidemark.session import work_dir
from tidemark.sources.tables import table

#: Of a container: tokens, documents, and attention cost (a full row of one text would cost CAPACITY squared).
CAPACITY, DOCUMENTS, ATTENTION = 4096, 128, 4096 * 4096 * 3 // 4


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode.token_ids(table(spark, d, "documents"))


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(spark, encode.token_counts(table(spark, d, "documents")), tokens=CAPACITY, documents=DOCUMENTS, attention=ATTENTION, path=work_dir(spark, "p8"))


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """How well the containers are filled."""
    by = p8_containers(spark, d).where("container IS NOT NULL").groupBy("container").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("k"))
    return by.agg(F.count("*").alias("containers"), F.sum("n").alias("tokens"), F.max("n").alias("most"), F.max("k").alias("most_documents"), (F.sum("n") / (F.count("*") * CAPACITY)).alias("filled"))


def p8_check(spark: SparkSession, d: str) -> DataFrame:
    """What is wrong with the containers: documents left out, changed in size or cut for no reason, containers above a capacity, and whether they are hardly more than a lower bound."""
    placed = p8_containers(spark, d)
    sizes = encode.token_counts(table(spark, d, "documents"))
    of = placed.groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("pieces"))
    j = sizes.join(of, "doc_id", "left")
    docs = j.agg(
        F.count("*").alias("documents"),
        F.count(F.when(F.col("n").isNull() | (F.col("n") != F.col("n_tokens")), 1)).alias("incomplete"),
        F.count(F.when((F.col("n_tokens") <= CAPACITY) & (F.col("pieces") > 1), 1)).alias("cut_short"),
    )
    by = placed.where("container IS NOT NULL").groupBy("container").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("k"), F.sum(F.col("n_tokens") * F.col("n_tokens")).alias("a"))
    over = lambda cond: F.count(F.when(cond, 1))
    bound = F.greatest(F.ceil(F.sum("t") / CAPACITY), F.ceil(F.sum("k") / DOCUMENTS))
    full = by.agg(over(F.col("t") > CAPACITY).alias("over_tokens"), over(F.col("k") > DOCUMENTS).alias("over_documents"), over((F.col("a") > ATTENTION) & (F.col("k") > 1)).alias("over_attention"), (F.count("*") <= bound * 1.02 + 1).alias("near_bound"))
    return docs.join(F.broadcast(full))  # one row each


def p9_statistics(spark: SparkSession, d: str) -> DataFrame:
    return quality.text_quality(table(spark, d, "documents"), table(spark, d, "common_words"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_statistics(spark, d).where("not_prose").select("doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p7_ids, p8_containers, p8_fill, p8_check, p9_found, p9_statistics)}

ORACLES: dict[str, str] = {
    "p8_check": "SELECT count(*) AS documents, 0::BIGINT AS incomplete, 0::BIGINT AS cut_short, 0::BIGINT AS over_tokens, 0::BIGINT AS over_documents, 0::BIGINT AS over_attention, true AS near_bound FROM documents",
}
