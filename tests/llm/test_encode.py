import os

import pytest

from tests.conftest import rows
from tidemark.llm import encode
from tidemark.llm.encode import token_counts, token_ids, vocabulary_path

pytestmark = pytest.mark.skipif(not os.path.exists(vocabulary_path()), reason="no vocabulary")
KIND = "doc_id bigint, text string, ids string, n_tokens int"
DATA = [(1, "the shop was closed"), (2, ""), (3, None), (4, " \t\n"), (5, "the shop was closed"), (5, "a"), (None, "b"), (7, "wort " * 60_000 + "x" * 70_000)]


def test_ids_and_counts(spark):
    df = spark.createDataFrame([(*x, "clash", 0) for x in DATA], KIND)
    got = token_ids(df).collect()
    by = {(r.doc_id, len(r.ids)) for r in got}
    assert len(got) == len(DATA) and (2, 0) in by and (3, 0) in by
    ids = {r.doc_id: list(r.ids) for r in got if r.doc_id in (1, 4, 7)}
    whole = encode.Encoder(encode.read_ranks(vocabulary_path()))
    assert ids == {i: whole.encode(t) for i, t in DATA if i in (1, 4, 7)}
    assert rows(token_counts(df)) == sorted(((r.doc_id, len(r.ids)) for r in got), key=str)


def test_empty_table(spark):
    assert token_ids(spark.createDataFrame([], KIND)).collect() == []


def test_pieces_beyond_the_cache(monkeypatch):
    ranks = encode.read_ranks(vocabulary_path())
    texts = [f"word{i} other{i * 7}" for i in range(500)]
    want = encode.Encoder(ranks).encode_all(texts)
    monkeypatch.setattr(encode, "CACHE", 50)
    monkeypatch.setattr(encode, "TOGETHER", 100)
    monkeypatch.setattr(encode, "RUN", 3)
    assert encode.Encoder(ranks).encode_all(texts) == want
    assert [encode.Encoder(ranks).encode(t) for t in texts[:20]] == want[:20]


def test_a_file_that_is_no_vocabulary(spark, monkeypatch):
    monkeypatch.setattr(encode, "MAX_VOCABULARY", 10)
    with pytest.raises(ValueError):
        token_ids(spark.createDataFrame([], KIND))
