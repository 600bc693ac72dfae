"""Encoding of a whole corpus with a public tokenizer.

Texts are split by the tokenizer's pattern and each distinct piece of a batch is merged once by the segment tree
of `bpe`; the vocabulary is read once on the driver and broadcast (its size is checked: `MAX_VOCABULARY`).
Batches go through Arrow, so this is a narrow map without a shuffle.

Nulls and the like: a null or an empty text gives an empty list; blank text is encoded as it is; texts of any
length are encoded whole, in runs of pieces, so memory is bounded by the batch and not by one text's pieces;
rows with equal or null ids are all kept; lone surrogates cannot occur in Spark strings. Only the id and the text
column are read, whatever other columns there are.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import c
from tidemark.llm.bpe import PairRanks, merge_packed, read_ranks

#: How the public byte-level vocabularies split text before merging (a fixed value of the tokenizer).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same for texts of ASCII characters only, which the standard library splits in half the time.
ASCII_PATTERN = r"""'(?:[stmd]|re|ve|ll)| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"""
MAX_VOCABULARY = 64 * 1024 * 1024
#: Pieces a worker remembers, and the longest it does; pieces it looks at together; characters it looks at together.
CACHE, CACHED_LENGTH, RUN, TOGETHER = 200_000, 48, 200_000, 1_000_000

_loaded: dict[int, Encoder] = {}


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Where the environment keeps public vocabularies; set TOKENIZERS_DIR for another place."""
    folder = os.environ.get("TOKENIZERS_DIR")
    if not folder:
        try:
            import public_tokenizers

            return public_tokenizers.path(name)
        except ImportError:
            folder = "/opt/tokenizers"
    return os.path.join(folder, name)


class Encoder:
    """Encodes texts with a vocabulary; remembers the tokens of a bounded number of pieces, as 32-bit integers in bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.ranks = PairRanks(ranks)
        self.general = regex.compile(pattern)
        self.ascii = re.compile(ASCII_PATTERN) if pattern == PATTERN else self.general
        self.known: dict[str, bytes] = {}

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Tokens of pieces that are not remembered; those too long to remember come back."""
        new = [p for p in pieces if p not in self.known]
        if not new:
            return {}
        if len(self.known) + len(new) > CACHE:
            self.known.clear()
            new = list(pieces)
        packed = merge_packed([p.encode("utf-8", "replace") for p in new], self.ranks)
        self.known.update((p, t) for p, t in zip(new, packed, strict=True) if len(p) <= CACHED_LENGTH)
        return {p: t for p, t in zip(new, packed, strict=True) if len(p) > CACHED_LENGTH}

    def _joined(self, pieces: list[str], long: dict[str, bytes]) -> bytes:
        known = self.known
        return b"".join([known[p] if p in known else long[p] for p in pieces] if long else map(known.__getitem__, pieces))

    def packed(self, texts: list[str | None]) -> list[bytes]:
        """The tokens of each text, four bytes each; distinct pieces of neighbouring texts are merged together."""
        out: list[bytes] = []
        lo = 0
        while lo < len(texts):
            hi, size = lo, 0
            while hi < len(texts) and (hi == lo or size + len(texts[hi] or "") <= TOGETHER):
                size += len(texts[hi] or "")
                hi += 1
            if size > TOGETHER:
                out.append(self._one(texts[lo]))
            else:
                split = [[] if not t else (self.ascii if t.isascii() else self.general).findall(t) for t in texts[lo:hi]]
                long = self._learn({p for s in split for p in s})
                out += [self._joined(s, long) for s in split]
            lo = hi
        return out

    def _one(self, text: str) -> bytes:
        """A text of any length, in runs of pieces."""
        out: list[bytes] = []
        it = (self.ascii if text.isascii() else self.general).finditer(text)
        while run := [m.group() for m in islice(it, RUN)]:
            out.append(self._joined(run, self._learn(set(run))))
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self._one(text), np.int32).tolist()

    def encode_all(self, texts: list[str | None]) -> list[list[int]]:
        return [np.frombuffer(x, np.int32).tolist() for x in self.packed(texts)]


def _encoder(shared) -> Encoder:
    """The worker's encoder of a broadcast vocabulary; kept between tasks."""
    key = shared.id if hasattr(shared, "id") else shared._id if hasattr(shared, "_id") else id(shared)
    if key not in _loaded:
        _loaded.clear()
        ranks, pattern = shared.value
        _loaded[key] = Encoder(ranks, pattern)
    return _loaded[key]


def _vocabulary(spark: SparkSession, path: str | None, pattern: str):
    path = path or vocabulary_path()
    if os.path.getsize(path) > MAX_VOCABULARY:
        raise ValueError(f"{path} is larger than a vocabulary may be ({MAX_VOCABULARY} bytes)")
    return spark.sparkContext.broadcast((read_ranks(path), pattern))


def _map(df: DataFrame, doc_id: str, text: str, path: str | None, pattern: str, counts: bool) -> DataFrame:
    shared = _vocabulary(df.sparkSession, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for b in batches:
            for lo in range(0, b.num_rows, 2000):
                part = b.slice(lo, 2000)
                ids = encoder.packed(part.column(1).to_pylist())
                sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
                if counts:
                    got = pa.array(sizes)
                else:
                    ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                    got = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), got], ["id", "out"])

    kind = df.schema[doc_id].dataType.simpleString()
    one = df.select(c(doc_id).alias("id"), c(text).cast("string").alias("text"))
    return one.mapInArrow(run, f"id {kind}, out {'bigint' if counts else 'array<int>'}")


def token_ids(df: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, pattern: str = PATTERN) -> DataFrame:
    """doc_id, ids: the tokens of each text, without special tokens."""
    return _map(df, doc_id, text, path, pattern, False).select(F.col("id").alias(doc_id), F.coalesce("out", F.array().cast("array<int>")).alias("ids"))


def token_counts(df: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, pattern: str = PATTERN) -> DataFrame:
    """doc_id, n_tokens: how many tokens each text has."""
    return _map(df, doc_id, text, path, pattern, True).select(F.col("id").alias(doc_id), F.col("out").alias("n_tokens"))
