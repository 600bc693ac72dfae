"""Byte-level pair merges by a segment tree over the ranks of adjacent pairs.

A piece of text is a row of byte tokens. The leaves of the tree hold, for each token, the rank of its pair with
the next live token (none: infinite); an inner node holds the least rank below it, at equal ranks the leftmost.
So the root is the next merge. A merge changes at most three leaves (the pair, the token it swallowed and the
pair before it), each updated along one path to the root. It ends when the root is infinite.

Two forms give the same result: `merge_one` for a single piece, of any length, in n log n steps, whose leaves hold
the least of several neighbouring positions, as memory counts there; and
`merge_many`, which keeps the trees of many short pieces in one array and takes a merge in all of them at once.
"""

from __future__ import annotations

import base64
from array import array

import numpy as np

_NONE = np.int64(1) << 62
_POS = 40
_MASK = (1 << _POS) - 1
#: A pair's number is its first token in these steps, and its second; tokens are below 2^_PAIR, and ranks below 2^22.
_PAIR = 31
#: Positions below one leaf of the tree of a single piece.
LEAF = 64
#: Pieces up to so many bytes are merged together in arrays.
SHORT = 32


def read_ranks(path: str) -> dict[bytes, int]:
    """token -> rank, of a file with a base64 token and a rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


class PairRanks:
    """Which two adjacent tokens merge, and into which; the merged token's id is the pair's rank."""

    def __init__(self, ranks: dict[bytes, int]):
        if max(ranks.values(), default=0) >= 1 << 22:
            raise ValueError("a vocabulary of more than 4,194,304 tokens")
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.pairs: dict[int, int] = {}
        get = ranks.get
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = get(token[:i]), get(token[i:])
                if a is not None and b is not None:
                    self.pairs[a << _PAIR | b] = rank
        # open addressing, so that an array of pairs is looked up in a few steps
        self.bits = max(4, int(len(self.pairs) * 3).bit_length())
        size = 1 << self.bits
        keys, values = np.full(size, -1, np.int64), np.full(size, _NONE, np.int64)
        todo_k = np.fromiter(self.pairs.keys(), np.int64, len(self.pairs))
        todo_v = np.fromiter(self.pairs.values(), np.int64, len(self.pairs))
        at = self._slot(todo_k)
        while len(todo_k):
            free = keys[at] == -1
            slots, first = np.unique(at[free], return_index=True)
            take = np.flatnonzero(free)[first]
            keys[slots], values[slots] = todo_k[take], todo_v[take]
            left = np.ones(len(todo_k), bool)
            left[take] = False
            todo_k, todo_v, at = todo_k[left], todo_v[left], (at[left] + 1) & (size - 1)
        self.keys, self.values = keys, values

    def _slot(self, k: np.ndarray) -> np.ndarray:
        h = k.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs; _NONE where a pair doesn't merge or a part is missing (below 0)."""
        k = a << _PAIR | b
        out = np.full(len(k), _NONE, np.int64)
        todo = np.flatnonzero((a >= 0) & (b >= 0))
        at = self._slot(k[todo])
        while len(todo):
            there = self.keys[at]
            hit = there == k[todo]
            out[todo[hit]] = self.values[at[hit]]
            go = ~hit & (there != -1)
            todo, at = todo[go], (at[go] + 1) & (len(self.keys) - 1)
        return out


def merge_one(piece: bytes, ranks: PairRanks) -> list[int]:
    """A single piece of any length. A leaf of the tree holds the least of `LEAF` positions, so a byte takes about 20 bytes of memory."""
    n = len(piece)
    tok = array("i", ranks.byte[np.frombuffer(piece, np.uint8)].astype(np.int32).tobytes())
    if n < 2:
        return tok.tolist()
    get, none = ranks.pairs.get, int(_NONE)
    first = ranks.byte[np.frombuffer(piece, np.uint8)]
    leaves = -(-n // LEAF)
    low = np.full(leaves * LEAF, _NONE, np.int64)
    for lo in range(0, n - 1, 1 << 20):  # in runs, so that no more than a run is looked up at once
        hi = min(n - 1, lo + (1 << 20))
        r = ranks.lookup(first[lo:hi], first[lo + 1 : hi + 1])
        low[lo:hi] = np.where(r == _NONE, _NONE, (r << _POS) | np.arange(lo, hi))
    del first
    size = 1 << (leaves - 1).bit_length()
    tree = [none] * (2 * size)
    tree[size : size + leaves] = low.reshape(leaves, LEAF).min(axis=1).tolist()
    low = array("q", low.tobytes())
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    nxt, prv = array("i", np.arange(1, n + 1, dtype=np.int32).tobytes()), array("i", np.arange(-1, n - 1, dtype=np.int32).tobytes())

    def put(i: int, value: int) -> None:
        was, low[i] = low[i], value
        leaf = i // LEAF
        i = leaf + size
        if value <= tree[i]:
            v = value
        elif was == tree[i]:
            v = min(low[leaf * LEAF : (leaf + 1) * LEAF])
        else:
            return
        while i:
            if tree[i] == v:
                return
            tree[i] = v
            i >>= 1
            a, b = tree[2 * i], tree[2 * i + 1]
            v = a if a < b else b

    def rank(i: int, j: int) -> int:
        r = get(tok[i] << _PAIR | tok[j])
        return none if r is None else r << _POS | i

    while (top := tree[1]) != none:
        i = top & _MASK
        j = nxt[i]
        tok[i], tok[j] = top >> _POS, -1
        k = nxt[i] = nxt[j]
        if k < n:
            prv[k] = i
        put(j, none)
        put(i, rank(i, k) if k < n else none)
        if (h := prv[i]) >= 0:
            put(h, rank(h, i))
    return [t for t in tok if t >= 0]


def _merge_class(pieces: list[bytes], width: int, ranks: PairRanks) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of at most `width` bytes (a power of two): their tokens one after another, and how many each has."""
    m = len(pieces)
    lengths = np.fromiter(map(len, pieces), np.int64, m)
    data = np.frombuffer(b"".join(pieces), np.uint8)
    inside = np.arange(width) < lengths[:, None]
    tok = np.full((m, width + 1), -1, np.int64)
    tok[:, :width][inside] = ranks.byte[data]
    tree = np.full((m, 2 * width), _NONE, np.int64)
    r = ranks.lookup(tok[:, :width].ravel(), tok[:, 1:].ravel()).reshape(m, width)
    tree[:, width:] = np.where(r == _NONE, _NONE, (r << _POS) | np.arange(width))
    level = width
    while level > 1:
        half = level >> 1
        np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2], out=tree[:, half:level])
        level = half
    nxt = np.tile(np.arange(1, width + 2), (m, 1))
    np.minimum(nxt, lengths[:, None], out=nxt)
    prv = np.tile(np.arange(-1, width), (m, 1))
    rows = np.flatnonzero(tree[:, 1] != _NONE)
    while len(rows):
        top = tree[rows, 1]
        i = top & _MASK
        j = nxt[rows, i]
        k = nxt[rows, j]
        tok[rows, i] = top >> _POS
        tok[rows, j] = -1
        nxt[rows, i] = k
        prv[rows, k] = i
        h = prv[rows, i]
        end = k >= lengths[rows]
        # three leaves change: j dies, i pairs with k, h pairs with i
        both_a = np.concatenate((tok[rows, i], np.where(h >= 0, tok[rows, h], -1)))
        both_b = np.concatenate((np.where(end, -1, tok[rows, k]), tok[rows, i]))
        new = ranks.lookup(both_a, both_b)
        pos = np.concatenate((i, h))
        new = np.where(new == _NONE, _NONE, (new << _POS) | np.maximum(pos, 0))
        has = h >= 0
        tree[rows, width + j] = _NONE
        tree[rows, width + i] = new[: len(rows)]
        tree[rows[has], width + h[has]] = new[len(rows) :][has]
        r3 = np.concatenate((rows, rows, rows[has]))
        n3 = np.concatenate((j, i, h[has])) + width
        n3 >>= 1
        while n3[0]:
            tree[r3, n3] = np.minimum(tree[r3, 2 * n3], tree[r3, 2 * n3 + 1])
            n3 >>= 1
        rows = rows[tree[rows, 1] != _NONE]
    live = (tok[:, :width] >= 0) & inside
    return tok[:, :width][live], live.sum(axis=1)


def merge_packed(pieces: list[bytes], ranks: PairRanks) -> list[bytes]:
    """Tokens of each piece, as 32-bit integers in bytes."""
    out: list[bytes] = [b""] * len(pieces)
    classes: dict[int, list[int]] = {}
    for x, p in enumerate(pieces):
        n = len(p)
        if n > SHORT:
            out[x] = array("i", merge_one(p, ranks)).tobytes()
        else:
            classes.setdefault(max(2, 1 << max(0, n - 1).bit_length()), []).append(x)
    for width, at in classes.items():
        if len(at) < 16:
            for x in at:
                out[x] = array("i", merge_one(pieces[x], ranks)).tobytes()
            continue
        for lo in range(0, len(at), 8192):
            some = at[lo : lo + 8192]
            flat, counts = _merge_class([pieces[x] for x in some], width, ranks)
            data, begin = flat.astype(np.int32).tobytes(), 0
            for x, end in zip(some, (np.cumsum(counts) * 4).tolist(), strict=True):
                out[x] = data[begin:end]
                begin = end
    return out


def merge_many(pieces: list[bytes], ranks: PairRanks) -> list[list[int]]:
    """Tokens of each piece."""
    return [np.frombuffer(x, np.int32).tolist() for x in merge_packed(pieces, ranks)]
