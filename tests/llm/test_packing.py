from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm.packing import fill, pack

KIND = "doc_id bigint, n_tokens bigint, container string"


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_fill_keeps_every_limit(rule):
    rng = np.random.default_rng(1)
    n = rng.integers(1, 101, 3000)
    at = fill(n, 100, 7, 4000 + 6000, rule=rule)
    assert np.bincount(at, weights=n).max() <= 100
    assert np.bincount(at).max() <= 7 and np.bincount(at).min() >= 1
    assert np.bincount(at, weights=n.astype(float) ** 2).max() <= 10_000
    assert n.sum() / (100 * (at.max() + 1)) > 0.95


def test_fill_against_the_best_for_few_items():
    from itertools import product

    rng = np.random.default_rng(2)
    for _ in range(20):
        n = rng.integers(1, 11, 6)
        best = min(len(set(p)) for p in product(range(6), repeat=6) if all(sum(x for x, b in zip(n, p, strict=True) if b == k) <= 10 for k in range(6)))
        assert fill(n, 10, 99, 100).max() + 1 <= best + 1


def test_attention_limit_binds():
    at = fill(np.array([5] * 40 + [10]), 20, 99, 100)
    assert np.bincount(at).max() == 4 and at[-1] not in at[:-1]


def check(got, sizes, tokens, documents):
    per, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append((r.piece, r.start, r.n_tokens))
        if r.container is None:
            assert r.n_tokens == 0
        else:
            per[r.container].append(r.n_tokens)
    for d, n in sizes.items():
        p = sorted(pieces[d])
        assert sum(x[2] for x in p) == (n or 0) and [x[0] for x in p] == list(range(len(p)))
        assert all(x[2] == tokens for x in p[:-1]) and all(x[1] == x[0] * tokens for x in p)
        assert len(p) == max(1, -(-(n or 0) // tokens))  # cut only beyond the capacity
    assert all(sum(v) <= tokens and len(v) <= documents for v in per.values())
    return sum(map(sum, per.values())) / (tokens * max(1, len(per)))


def test_whole_tables(spark, at):
    rng = np.random.default_rng(3)
    sizes = {i: int(x) for i, x in enumerate(np.clip(rng.lognormal(4, 1.2, 4000), 0, 5000))}
    sizes |= {9001: 0, 9002: None, 9003: 1024, 9004: 1025, 9005: 1023, 9006: 40_000}
    df = spark.createDataFrame([(i, n, "clash") for i, n in sizes.items()], KIND)
    got = pack(spark, df, tokens=1024, documents=64, shard_tokens=40_000, path=at).collect()
    assert check(got, sizes, 1024, 64) > 0.98


def test_equal_ids_are_items_of_their_own(spark, at):
    df = spark.createDataFrame([(1, 600, ""), (1, 600, ""), (None, 600, "")], KIND)
    got = pack(spark, df, tokens=1000, path=at).collect()
    assert len(got) == 3 and len({r.container for r in got}) == 3


def test_edges(spark, at):
    assert pack(spark, spark.createDataFrame([], KIND), path=f"{at}/a").count() == 0
    with pytest.raises(ValueError):
        pack(spark, spark.createDataFrame([(1, -1, "")], KIND), path=f"{at}/b")
    with pytest.raises(ValueError):
        pack(spark, spark.createDataFrame([(1, 1, "")], KIND), tokens=10, attention=0, path=f"{at}/c")
    same = spark.createDataFrame([(i, 1, "") for i in range(1000)], KIND)
    got = pack(spark, same, tokens=100, documents=10, path=f"{at}/d").collect()
    assert len({r.container for r in got}) == 100


@pytest.mark.parametrize("n", [1000, 2500])
def test_equal_and_null_ids_of_a_whole_container(spark, at, n):
    df = spark.createDataFrame([(1, n, ""), (1, n, ""), (None, n, ""), (None, n, "")], KIND)
    per = defaultdict(int)
    for r in pack(spark, df, tokens=1000, path=at).collect():
        per[r.container] += r.n_tokens
    assert max(per.values()) == 1000 and sum(per.values()) == 4 * n


def test_equal_ids_are_spread_over_shards(spark, at):
    df = spark.createDataFrame([(1, 100, "")] * 400, KIND)
    pack(spark, df, tokens=1000, shard_tokens=10_000, path=at)
    shards = spark.read.parquet(f"{at}/round1").selectExpr("(container >> 28) & 268435455 AS s").groupBy("s").count().collect()
    assert len(shards) == 4 and max(r["count"] for r in shards) < 200


def test_attention_binds_in_whole_tables(spark, at):
    rng = np.random.default_rng(4)
    sizes = [int(x) for x in rng.integers(1, 1000, 600)]
    df = spark.createDataFrame([(i, n, "") for i, n in enumerate(sizes)], KIND)
    limit = 500_000
    per = defaultdict(list)
    for r in pack(spark, df, tokens=1000, documents=50, attention=limit, path=at).collect():
        per[r.container].append(r.n_tokens)
    assert sorted(n for v in per.values() for n in v) == sorted(sizes)
    assert all(sum(v) <= 1000 and len(v) <= 50 for v in per.values())
    assert all(sum(n * n for n in v) <= limit for v in per.values() if len(v) > 1)
    alone = [n for n in sizes if n * n > limit]
    assert alone and sum(len(v) == 1 and v[0] ** 2 > limit for v in per.values()) == len(alone)
    # without the limit some containers of several pieces would be above it
    free = defaultdict(list)
    for r in pack(spark, df, tokens=1000, documents=50, path=f"{at}/free").collect():
        free[r.container].append(r.n_tokens)
    assert any(len(v) > 1 and sum(n * n for n in v) > limit for v in free.values())
