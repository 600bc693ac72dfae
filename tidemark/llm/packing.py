"""Filling fixed-capacity containers with texts, measured in tokens.

A container has three capacities: tokens, documents, and attention cost (the sum of squared lengths). Containers
are filled one after another by vector best-fit: of all items that fit the residual in every capacity the next is
the one that leaves the least weighted norm of the residual (`rule="norm"`), or that has the greatest weighted
dot product with it (`rule="dot"`). An item's needs follow from its length, so candidates are the distinct
lengths still there: at most `tokens` of them, however many items there are.

Only texts longer than the capacity are cut, into pieces of exactly the capacity and a rest; whole pieces are
containers of their own and never meet others. A piece whose attention cost alone is above that capacity cannot be
cut for it, so it has a container of its own too: the limit holds for every container of more than one piece. All other items are spread by hash over shards of about
`shard_tokens` tokens, each filled in one task; containers that end up less than `full` are opened again and
their items packed anew, in shards of the same size, so that of all shards' rests one remains. The two rounds
cost one shuffle each of (id, piece, length).

Nulls and the like: a null, empty or otherwise token-less text takes no container and comes back with a null one
and length 0; equal or null ids are packed as different items (each written row has its own number); sizes must not be negative (they are refused); an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import c
from tidemark.session import work_dir


def fill(lengths: np.ndarray, tokens: int, documents: int, attention: int, weights: Sequence[float] = (1.0, 0.05, 0.05), rule: str = "norm") -> np.ndarray:
    """The container number of each item; every length must be between 1 and `tokens`."""
    order = np.argsort(lengths, kind="stable")
    sizes, first, count = np.unique(lengths[order], return_index=True, return_counts=True)
    left, used = count.copy(), np.zeros(len(sizes), np.int64)
    need = np.stack((sizes / tokens, np.full(len(sizes), 1 / documents), sizes.astype(float) ** 2 / attention))
    w = np.asarray(weights)[:, None]
    weighted = w * need
    out = np.empty(len(lengths), np.int64)
    container, remaining = 0, len(lengths)
    live = np.flatnonzero(left)
    while remaining:
        r_tok, r_doc, r_att = tokens, documents, attention
        while r_doc > 0:
            hi = np.searchsorted(sizes[live], min(r_tok, int(r_att**0.5 + 1e-9)), side="right")
            if hi == 0:
                break
            at = live[:hi]
            rest = np.array([[r_tok / tokens], [r_doc / documents], [r_att / attention]])
            score = (weighted[:, at] * rest).sum(0) if rule == "dot" else -(w * (rest - need[:, at]) ** 2).sum(0)
            s = at[hi - 1 - int(np.argmax(score[::-1]))]  # the longest of equals
            n = int(sizes[s])
            # as long as the same length stays the only choice, take it at once
            k = min(int(left[s]), r_doc, r_tok // n, r_att // (n * n)) if hi == 1 else 1
            out[order[first[s] + used[s] : first[s] + used[s] + k]] = container
            used[s] += k
            left[s] -= k
            remaining -= k
            r_tok, r_doc, r_att = r_tok - k * n, r_doc - k, r_att - k * n * n
            if not left[s]:
                live = live[live != s]
        container += 1
    return out


def _packed(items: DataFrame, shards: int, salt: int, limits: tuple, weights: Sequence[float], rule: str) -> DataFrame:
    """Items with their container's number; every shard is filled in one task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if parts:
            x = pd.concat(parts, ignore_index=True).sort_values(["item_row", "piece"], kind="stable", ignore_index=True)
            for shard, rows in x.groupby("shard", sort=True):
                n = rows["n_tokens"].to_numpy(np.int64)
                where = fill(n, *limits, weights=weights, rule=rule)
                filled = np.bincount(where, weights=n)[where].astype(np.int64)
                yield pd.DataFrame({"id": rows["id"], "piece": rows["piece"], "n_tokens": n, "item_row": rows["item_row"], "container": (np.int64(salt) << 56) | (np.int64(shard) << 28) | where, "filled": filled})

    kind = items.schema["id"].dataType.simpleString()
    placed = items.withColumn("shard", F.pmod(F.xxhash64(F.lit(salt), "item_row", "piece"), F.lit(shards)).cast("int")).repartitionById(shards, F.col("shard"))
    return placed.mapInPandas(run, f"id {kind}, piece int, n_tokens bigint, item_row bigint, container bigint, filled bigint")


def pack(spark: SparkSession, sizes: DataFrame, item: str = "doc_id", size: str = "n_tokens", tokens: int = 4096, documents: int = 256, attention: int | None = None, weights: Sequence[float] = (1.0, 0.05, 0.05), rule: str = "norm", shard_tokens: int = 4_000_000, full: float = 0.98, path: str | None = None) -> DataFrame:
    """item, piece, start, n_tokens, container: where every item, or every piece of one too long, goes."""
    attention = tokens * tokens if attention is None else attention
    if min(tokens, documents, attention) < 1:
        raise ValueError("every capacity must be at least 1")
    path = path or work_dir(spark, "pack")
    sizes.select(c(item).alias("id"), F.coalesce(c(size), F.lit(0)).cast("bigint").alias("n"), F.monotonically_increasing_id().alias("item_row")).write.parquet(f"{path}/sizes")
    all_items = spark.read.parquet(f"{path}/sizes")
    rest = F.col("n") % tokens
    shared = (rest > 0) & (rest * rest <= attention)
    least, rest_tokens, rest_items = all_items.agg(F.min("n"), F.sum(F.when(shared, rest)), F.count(F.when(shared, 1))).first()
    if least is not None and least < 0:
        raise ValueError("sizes below 0")
    none = all_items.where("n = 0").select("id", F.lit(0).alias("piece"), F.lit(0).cast("bigint").alias("n_tokens"), F.lit(None).cast("string").alias("container"))
    whole = all_items.where(f"n >= {tokens}").select("id", F.explode(F.sequence(F.lit(0), F.expr(f"CAST(n DIV {tokens} - 1 AS INT)"))).alias("piece"), F.lit(tokens).cast("bigint").alias("n_tokens"), "item_row")
    whole = whole.select("id", "piece", "n_tokens", F.concat(F.lit("w"), F.col("item_row").cast("string"), F.lit("-"), F.col("piece").cast("string")).alias("container"))
    rests = all_items.where(rest > 0).select("id", F.expr(f"CAST(n DIV {tokens} AS INT)").alias("piece"), rest.alias("n_tokens"), "item_row", shared.alias("shared"))
    alone = rests.where("NOT shared").select("id", "piece", "n_tokens", F.concat(F.lit("a"), F.col("item_row").cast("string")).alias("container"))
    rests = rests.where("shared").drop("shared")

    def shards(t: int | None, n: int | None) -> int:
        return max(1, -(-(t or 0) // shard_tokens), -(-(n or 0) // 500_000))

    limits = (tokens, documents, attention)
    _packed(rests, shards(rest_tokens, rest_items), 1, limits, weights, rule).write.parquet(f"{path}/round1")
    first = spark.read.parquet(f"{path}/round1")
    open_ = F.col("filled") < full * tokens
    t2, n2 = first.where(open_).agg(F.sum("n_tokens"), F.count("*")).first()
    again = first
    if n2:
        second = _packed(first.where(open_).select("id", "piece", "n_tokens", "item_row"), shards(t2, n2), 2, limits, weights, rule)
        again = first.where(~open_).unionByName(second)
    mixed = again.select("id", "piece", "n_tokens", F.concat(F.lit("m"), F.hex("container")).alias("container"))
    out = mixed.unionByName(whole).unionByName(alone).unionByName(none)
    return out.select(F.col("id").alias(item), "piece", (F.col("piece").cast("bigint") * tokens).alias("start"), "n_tokens", "container")
