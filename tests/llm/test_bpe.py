import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import bpe
from tidemark.llm.bpe import SHORT, PairRanks, merge_many, merge_one, read_ranks
from tidemark.llm.encode import vocabulary_path

#: A small vocabulary: all bytes, and merges with overlaps and chains.
TOKENS = [bytes([b]) for b in range(256)] + [b"ab", b"bc", b"abc", b"aa", b"aaaa", b"cab", b"abab", b"aab", b"bb", b"bbc"]
SMALL = {t: i for i, t in enumerate(TOKENS)}


def plain(piece, ranks):
    """The rule as it stands: merge the leftmost of the least-ranked adjacent pairs until there is none."""
    parts = [bytes([b]) for b in piece]
    while True:
        best = min(((ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks), default=None)
        if best is None:
            return [ranks[p] for p in parts]
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@pytest.fixture(scope="module")
def small():
    return PairRanks(SMALL)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abcx", max_size=40).map(str.encode), max_size=60))
def test_both_forms_against_the_rule(pieces):
    ranks = PairRanks(SMALL)
    want = [plain(p, SMALL) for p in pieces]
    assert [merge_one(p, ranks) for p in pieces] == want
    assert merge_many(pieces, ranks) == want


def test_many_short_pieces_go_through_arrays(small):
    pieces = [bytes(97 + (i * j) % 3 for j in range(i % SHORT + 1)) for i in range(2000)]
    assert merge_many(pieces, small) == [plain(p, SMALL) for p in pieces]


def test_edges(small):
    assert merge_many([], small) == [] and merge_many([b""], small) == [[]]
    assert merge_one(b"", small) == [] and merge_one(b"x", small) == [ord("x")]


def test_a_very_long_piece_takes_little_time(small):
    got = merge_one(b"abc" * 100_000, small)
    assert got == [SMALL[b"abc"]] * 100_000


def test_public_vocabulary_against_another_implementation():
    tiktoken = pytest.importorskip("tiktoken")
    path = vocabulary_path()
    if not os.path.exists(path):
        pytest.skip("no vocabulary")
    from tidemark.llm.encode import PATTERN, Encoder

    ranks = read_ranks(path)
    other = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["", " ", "Hello  world!\n\n\tthe 1234 it's we'll", "naïve café — “x”", "数据里的名字不一样", "👩‍🔧🎉", "a" * 5000, "<|endoftext|>", "ab\x00\x07﻿‮", "x" * 40 + "1" * 40 + " " * 40 + " 　é"]
    mine = Encoder(ranks)
    assert mine.encode_all(texts) == [other.encode_ordinary(t) for t in texts]
    assert [mine.encode(t) for t in texts] == [other.encode_ordinary(t) for t in texts]
    assert [other.decode(mine.encode(t)) for t in texts] == texts


@settings(max_examples=500, deadline=None)
@given(st.text(st.characters(max_codepoint=127), max_size=60))
def test_both_patterns_split_ascii_alike(text):
    import re

    import regex

    from tidemark.llm.encode import ASCII_PATTERN, PATTERN

    assert re.findall(ASCII_PATTERN, text) == regex.findall(PATTERN, text)


def test_every_ascii_character_between_others():
    import re

    import regex

    from tidemark.llm.encode import ASCII_PATTERN, PATTERN

    for a in map(chr, range(128)):
        for b in ("", "a", "1", " ", "  ", "\n", "'", "'s", "\x1c", "_"):
            for t in (a + b, b + a, b + a + b, a + b + a):
                assert re.findall(ASCII_PATTERN, t) == regex.findall(PATTERN, t), repr(t)


def test_long_pieces_across_the_leaves_of_the_tree():
    r = random.Random(8)
    ranks = {bytes([b]): b for b in range(256)}
    for _ in range(300):
        a, b = r.choice(list(ranks)), r.choice([x for x in ranks if len(x) < 4])
        if len(a + b) < 9 and set(a + b) <= set(b"abcd") or r.random() < 0.05:
            ranks.setdefault(a + b, len(ranks))
    for x in (b"ab", b"bc", b"abc", b"cd", b"abab", b"aa", b"aaaa"):
        ranks.setdefault(x, len(ranks))
    pairs = bpe.PairRanks(ranks)
    for n in (63, 64, 65, 127, 128, 129, 200, 700):
        piece = bytes(r.choice(b"abcd") for _ in range(n))
        assert bpe.merge_one(piece, pairs) == plain(piece, ranks)


def plain(piece, ranks):
    t = [bytes([b]) for b in piece]
    while True:
        best = min(((ranks[t[i] + t[i + 1]], i) for i in range(len(t) - 1) if t[i] + t[i + 1] in ranks), default=None)
        if best is None:
            return [ranks[x] for x in t]
        i = best[1]
        t[i : i + 2] = [t[i] + t[i + 1]]


def test_a_vocabulary_too_large_is_refused():
    with pytest.raises(ValueError):
        bpe.PairRanks({**{bytes([b]): b for b in range(256)}, b"ab": 1 << 22})
