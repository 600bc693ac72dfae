"""Per-document text quality statistics, and the structural profile nearest to each document.

A text is cut into blocks: runs of lines of one layout (plain lines, entries of a list, a row of entries, cells of
a table, machine lines). Each block gives three distributions: token kinds (function words of the languages
known, other words, very short words, numbers, mixed tokens), character classes, and layout; and its function words
give a fourth: how far they, as a distribution, are from those of the document's language. A block belongs to
the profile with the least weighted sum of Jensen-Shannon divergences from them; profiles are those of prose and
of lists, tables, machine output and several kinds of junk (`PROFILES`). A document is assigned the profile that
holds most of its characters, and is not prose when profiles other than prose hold more than half of them. What
lies in prose blocks but repeats one fragment over and over (one sentence, or a run of any period) isn't prose; it is
looked for where enough tokens come again for it to change on which side of one half the document is.

A language's profile is how often each of its function words comes in the documents of that language, counted over
all documents in a first pass (a document's language there is the one whose word list is nearest); every word of the
list has a small share besides. The language of a document is the one whose profile is nearest to its function words.

Layout counts least: without it (its weight 0) the divergences alone find 91 % of the cases found with it in the
tables of TESTDATA, and 99.7 % of what they find is among those.

Basic counts go along: words, mean word length, symbol ratio, share of lines that end in punctuation, share of
common words, share of the commonest fragment (a text that repeats one fragment over and over is junk however
prose-like the fragment is).

Both passes are narrow maps through Arrow; the first gives a row for each language and word from each task, which are
summed. The list of common words (a few hundred, checked to be at most `MAX_WORDS`) and the profiles are broadcast.

Nulls and the like: null, empty and blank texts have counts of 0, profile `empty`, and are never a case; texts are
read whole; equal texts get equal rows; rows with null or equal ids are kept; common words may be empty, then only
the built-in ones count; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import c

MAX_WORDS = 100_000

#: Function words of languages that a list of common words may lack.
MORE_WORDS = {
    "nl": "de het een en van in op is dat die niet aan met voor er om te ook als bij maar nog naar dan uit door over zijn was werd ze we hij had heeft hebben alle al daarna niets moet zo wie waarom weer terwijl die deze dit kan hun",
    "it": "il lo la i gli le un una uno di del della dei delle da dal dalla in nel nella a al alla su sul e ed o ma che non per con si se è era sono ha hanno ho chi cui come più anche dopo quando ancora perché questa questo ogni senza fosse alle agli",
}

_WORD = re.compile(r"[^\W\d_]+")
_BULLET = re.compile(r"\s*(?:[-*+•–—→▪◦‣·☐☑✓✔●○■□►»]|o(?= )|\[[ xX]?\]|\(?(?:\d{1,3}|[a-zA-Z]|[ivxIVX]{1,4})[.)\]]|\[\w{1,3}\])\s+(?:\[[ xX]\]\s+)?(?=\S)")
_LEADER = re.compile(r"(?:\.{4,}|…{2,}|_{4,})\s*\d+\s*$")
_PAIR = re.compile(r"\s*[\w.\-]{1,30}\s*[:=](?:\s|$)")
_LOG = re.compile(r"\s*(?:\[?\d{4}-\d\d-\d\d[T ]\d\d:\d\d|\[?\d\d:\d\d:\d\d|(?:\S+ )?(?:INFO|WARN|WARNING|ERROR|DEBUG|TRACE|FATAL)\b)|.*\b\w+=\S+ \w+=")
_JSON = re.compile(r"\s*[\[{].*\":|\s*</?t[adhr]")
_CJK = re.compile(r"[\u3040-\u30ff\u3400-\u9fff]")
_SPECIAL = re.compile(r"<\|[^|<>]*\|>")
_ENDS = re.compile(r"[.!?]\s+|[。！？\n]")
_GAP = re.compile(r"\S {2,}(?=\S)")
_O_BULLETS = re.compile(r"^(?:\s*[-+•]|\s+o)\s", re.M)
_STOP = (".", "!", "?", "…", "。", "！", "？", ":", ";", '"', "”", "»", ")")
_ROWS = (" · ", " / ", " > ", " | ", " • ", " → ", " – ", "; ", ", ")

LAYOUTS = ("plain", "entry", "row", "cells", "machine")
_KINDS, _CLASSES = 5, 8
#: How much the divergences of token kinds, character classes and layout count, and that of function words.
WEIGHTS, FUNCTION_WEIGHT = (1.0, 1.0, 0.3), 0.5
#: How far a block's function words are from those of its language in each structure (prose, list, table, machine, junk).
FUNCTIONS_FAR = (0.25, 0.75, 0.95, 0.95, 0.95)
#: Words of a block at which its function words count for half; in a single sentence they say little.
SURE_WORDS = 20
#: Occurrences that a language's word list stands for beside those counted.
PRIOR = 50

#: name: structure, token kinds (function, word, short word, number, mixed), character classes (letters, digits,
#: space, sentence marks, structural marks, CJK, stray, other), layout; each a share of characters.
_PLAIN = (1, 0, 0, 0, 0)
PROFILES = {
    "prose": ("prose", (0.27, 0.65, 0.02, 0.02, 0.04), (0.79, 0.01, 0.17, 0.03, 0, 0, 0, 0), _PLAIN),
    "prose, few function words": ("prose", (0.1, 0.86, 0.02, 0.01, 0.01), (0.79, 0.01, 0.17, 0.03, 0, 0, 0, 0), _PLAIN),
    "prose with references": ("prose", (0.19, 0.48, 0.02, 0.03, 0.28), (0.72, 0.07, 0.12, 0.04, 0.05, 0, 0, 0), _PLAIN),
    "prose without spaces": ("prose", (0.15, 0.8, 0, 0.05, 0), (0, 0.04, 0.01, 0, 0, 0.9, 0.05, 0), _PLAIN),
    "prose without spaces, marked": ("prose", (0.1, 0.6, 0, 0.05, 0.25), (0.15, 0.1, 0.03, 0.02, 0.02, 0.63, 0.05, 0), _PLAIN),
    "entries": ("list", (0.1, 0.62, 0.03, 0.05, 0.2), (0.74, 0.06, 0.15, 0.02, 0.03, 0, 0, 0), (0, 1, 0, 0, 0)),
    "row of entries": ("list", (0.1, 0.62, 0.03, 0.05, 0.2), (0.74, 0.06, 0.15, 0.03, 0.02, 0, 0, 0), (0, 0, 1, 0, 0)),
    "cells": ("table", (0.01, 0.3, 0.01, 0.2, 0.48), (0.5, 0.25, 0.1, 0.05, 0.1, 0, 0, 0), (0, 0, 0, 1, 0)),
    "framed cells": ("table", (0.01, 0.2, 0.01, 0.1, 0.68), (0.25, 0.12, 0.25, 0.28, 0.1, 0, 0, 0), (0, 0, 0, 1, 0)),
    "cells of numbers": ("table", (0, 0.01, 0, 0.97, 0.02), (0, 0.77, 0.23, 0, 0, 0, 0, 0), (0, 0, 0, 1, 0)),
    "machine lines": ("machine", (0.01, 0.1, 0.01, 0.1, 0.78), (0.5, 0.3, 0.08, 0.05, 0.07, 0, 0, 0), (0, 0, 0, 0, 1)),
    "objects": ("machine", (0, 0.02, 0, 0.02, 0.96), (0.5, 0.12, 0.12, 0.18, 0.08, 0, 0, 0), (0, 0, 0, 0, 1)),
    "words without sentences": ("junk", (0.005, 0.96, 0.03, 0.005, 0), (0.86, 0, 0.13, 0.01, 0, 0, 0, 0), _PLAIN),
    "numbers": ("junk", (0, 0, 0, 1, 0), (0, 0.85, 0.15, 0, 0, 0, 0, 0), _PLAIN),
    "hexadecimal": ("junk", (0, 0, 0, 0.02, 0.98), (0.37, 0.61, 0.02, 0, 0, 0, 0, 0), _PLAIN),
    "encoded data": ("junk", (0, 0, 0, 0, 1), (0.81, 0.16, 0, 0, 0.03, 0, 0, 0), _PLAIN),
    "wrong decoding": ("junk", (0, 0.1, 0.05, 0, 0.85), (0.34, 0.01, 0.01, 0, 0, 0, 0.64, 0), _PLAIN),
    "wrong decoding, twice": ("junk", (0, 0.1, 0.05, 0, 0.85), (0.5, 0, 0.01, 0, 0, 0, 0.49, 0), _PLAIN),
    "bytes": ("junk", (0, 0, 0, 0, 1), (0.34, 0.05, 0.01, 0.05, 0.15, 0, 0.4, 0), _PLAIN),
    "pictures": ("junk", (0, 0, 0, 0, 1), (0, 0, 0.08, 0.2, 0, 0, 0, 0.72), _PLAIN),
    "symbols": ("junk", (0, 0, 0, 0, 1), (0, 0, 0.08, 0.16, 0.76, 0, 0, 0), _PLAIN),
    "broken characters": ("junk", (0.08, 0.08, 0.08, 0.02, 0.74), (0.41, 0.04, 0.18, 0.1, 0.2, 0, 0.07, 0), _PLAIN),
}
STRUCTURES = ("prose", "list", "table", "machine", "junk")
#: From so many fragments on, a text whose commonest fragment has this share is junk; so is one whose words, on
#: average, come this often and are this few.
REPEATS, REPEATED, WORD_REPEATS, FEW_WORDS = 5, 0.85, 6, 30
#: Lines of so few words on average, without marks of sentences, are entries.
ENTRY_WORDS = 8.5
#: Tokens of a stretch that is looked for in periodic runs, and how often it may come in one period.
_GRAM, _IN_PERIOD = 3, 4
_CACHE = 300_000


def _byte_classes() -> np.ndarray:
    """letters, digits, space, sentence marks, structural marks, CJK, stray Latin-1 and replacement, other."""
    t = np.full(256, 7, np.uint8)
    for b in range(128):
        ch = chr(b)
        t[b] = 0 if ch.isalpha() else 1 if ch.isdigit() else 2 if ch.isspace() else 3 if ch in ".,'\"!?()-" else 4
    t[0x80:0xC0] = 8  # bytes that continue a character
    t[0xC3:0xE0] = 0
    t[0xC2] = 6
    t[0xE0:0xE3] = 3
    t[0xE3:0xEA] = 5
    t[0xEF] = 6
    return t


_TABLE = _byte_classes()


class Lexicon:
    """Function words by language. counts: how often each word of a language comes in its documents, if that is known."""

    def __init__(self, words: list[tuple[str, str]], counts: dict[tuple[str, str], int] | None = None):
        langs: dict[str, set[str]] = {k: set(v.split()) for k, v in MORE_WORDS.items()}
        for lang, word in words:
            langs.setdefault(lang, set()).add(word.lower())
        self.languages = sorted(langs)
        self.spaced = frozenset(w for k, v in langs.items() for w in v if not _CJK.search(w))
        self.unspaced = sorted({w for v in langs.values() for w in v if _CJK.search(w)})
        words_ = sorted({w for v in langs.values() for w in v})
        self.index = {w: i for i, w in enumerate(words_)}
        self.profiles = np.array([[w in langs[k] for w in words_] for k in self.languages], float)
        self.profiles /= np.maximum(self.profiles.sum(1, keepdims=True), 1)
        if counts:
            self.profiles *= PRIOR
            at = {k: i for i, k in enumerate(self.languages)}
            for (lang, word), n in counts.items():
                self.profiles[at[lang], self.index[word]] += n
            self.profiles /= np.maximum(self.profiles.sum(1, keepdims=True), 1e-12)

    def far(self, counts: np.ndarray, language: str) -> float:
        """How far these counts of function words are from a language's profile, from 0 to 1; 1 if there are none."""
        at = np.flatnonzero(counts)
        if not len(at):
            return 1.0
        p, q = counts[at] / counts.sum(), self.profiles[self.languages.index(language), at]
        m = (p + q) / 2
        return float(((p * np.log2(p / m)).sum() + (q * np.log2(np.where(q > 0, q, 1) / m)).sum() + 1 - q.sum()) / 2)

    def language(self, counts: np.ndarray) -> str | None:
        """The language whose function words are nearest to these counts of them, by Jensen-Shannon divergence.

        Words that a text lacks add the same to a language's divergence each, so only those it has are looked at.
        """
        at = np.flatnonzero(counts)
        if not len(at):
            return None
        p, q = counts[at] / counts.sum(), self.profiles[:, at]
        m = (p + q) / 2
        a = (p * np.log2(p / m)).sum(axis=1)
        b = (q * np.log2(np.where(q > 0, q, 1) / m)).sum(axis=1) + 1 - q.sum(axis=1)
        return self.languages[int(np.argmin(a + b))]


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Divergences of each row of p from each row of q, from 0 to 1."""
    m = (p[:, None] + q[None]) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p[:, None] > 0, p[:, None] * np.log2(p[:, None] / m), 0).sum(-1)
        b = np.where(q[None] > 0, q[None] * np.log2(q[None] / m), 0).sum(-1)
    return np.maximum((a + b) / 2, 0)


def layout(line: str, letter_o: bool = True) -> int:
    """Which layout a line has; -1 for a rule without content, which goes with its neighbours.

    letter_o: whether an `o` at the start is a bullet in this text (it is a word in some languages).
    """
    if "<|" in line:
        line = _SPECIAL.sub("", line)
    n = len(line.split())
    if not n:
        return 0
    first = line.lstrip()[0]
    if first in "{[<" and _JSON.match(line):
        return 3 if first == "<" else 4
    if (first.isdigit() or first == "[" or "=" in line or "INFO" in line or "WARN" in line or "ERROR" in line or "DEBUG" in line or "TRACE" in line or "FATAL" in line) and _LOG.match(line):
        return 4
    if not first.isalnum() and not any(ch.isalnum() for ch in line):
        return -1 if len(line) >= 3 and len(set(line.strip())) <= 4 else 0
    if ("...." in line or "……" in line or "____" in line) and _LEADER.search(line):
        return 1
    for sep, least in (("\t", 1), ("|", 2)):
        if (k := line.count(sep)) >= least and n / (k + 1) <= 4:
            return 3
    if n <= 12 and (m := _BULLET.match(line)) and (letter_o or m.group().strip() != "o") and len(line[m.end() :].split()) <= 9:
        return 1
    if "  " in line and (k := len(_GAP.findall(line))) and n / (k + 1) <= 3.5 and (k > 1 or not _CJK.search(line)):
        return 3
    for sep in (",", ";"):
        if (k := line.count(sep)) >= 2 and (k := k - line.count(sep + " ")) >= 2 and n / (k + 1) <= 3:
            return 3
    if n <= 7 and _PAIR.match(line):
        return 1
    for sep in _ROWS:
        if (k := line.count(sep)) >= 3 and n / (k + 1) <= 10:
            stops = line.count(". ")
            if sep not in (", ", "; ") and stops * 3 <= k or k >= 4 and n / (k + 1) <= (6.5 if k < 6 else 8) and stops * 4 <= k:
                return 2
    return 0


class Block:
    __slots__ = ("at", "lines", "size")

    def __init__(self, at: int):
        self.at, self.lines, self.size = at, [], 0


def blocks(text: str) -> list[Block]:
    out: list[Block] = []
    letter_o = bool(_O_BULLETS.search(text))
    lines = [ln for ln in text.splitlines() if ln.strip()]
    layouts = [layout(ln, letter_o) for ln in lines]
    # one entry, or one row of cells, among lines of another layout is a line that looks like it
    for kind in (1, 3):
        if len(lines) > 1 and layouts.count(kind) == 1 and layouts.count(-1) == 0 and len(lines[at := layouts.index(kind)].split()) <= 12:
            layouts[at] = 0
    for line, at in zip(lines, layouts, strict=True):
        if at < 0:
            at = out[-1].at if out and out[-1].at else 3
        if not out or out[-1].at != at:
            out.append(Block(at))
        out[-1].lines.append(line)
        out[-1].size += len(line)
    return out


_TRIM = ".,;:!?\"'()[]{}<>«»“”‘’„¿¡…—–-*#_`。，、！？「」"
_JOINED = re.compile(r"[^\W\d_]+(?:[’'‘\-‐\u00ad\u200b\u200d\ufeff][^\W\d_]+)+")
#: A token's number holds its kind, its length, its letters and which function word it is (0: none), in these steps.
_LENGTH, _LETTERS, _FUNCTION = 8, 8 << 20, 8 << 32


class _Kinds(dict):
    """Token -> number; remembers a bounded number of tokens."""

    def __init__(self, index: dict[str, int]):
        super().__init__()
        self.index = index

    def __missing__(self, token: str) -> int:
        v = self._number(token)
        if len(token) <= 40:
            if len(self) > _CACHE:
                self.clear()
            self[token] = v
        return v

    def _number(self, token: str) -> int:
        n = min(len(token), (1 << 20) - 1)
        size = _LENGTH * n
        word = token.strip(_TRIM)
        letters = _LETTERS * min(len(word), 4095)
        if word.isalpha():
            f = self.index.get(word.lower())
            if f is not None:
                return size + letters + _FUNCTION * (f + 1)
            return (2 if n <= 2 else 1) + size + letters
        if not word:
            return 4 + size
        if word[0].isdigit() and word.replace(".", "").replace(",", "").replace("%", "").isdigit():
            return 3 + size
        if word[0].isalpha() and _JOINED.fullmatch(word):
            f = next((self.index[p] for p in _WORD.findall(word.lower()) if p in self.index), None)
            return (1 if f is None else _FUNCTION * (f + 1)) + size + letters
        return 4 + size


def _shares(x: np.ndarray) -> np.ndarray:
    return x / max(x.sum(), 1e-12)


class _Measured:
    """Counts of one block."""

    __slots__ = ("at", "chars", "functions", "kinds", "letters", "top", "words")


class Quality:
    """Measures texts with a lexicon."""

    def __init__(self, words: list[tuple[str, str]], counts: dict[tuple[str, str], int] | None = None):
        self.lexicon = Lexicon(words, counts)
        self.kinds = _Kinds({w: i for w, i in self.lexicon.index.items() if w in self.lexicon.spaced})
        self.unspaced = [(w, self.lexicon.index[w]) for w in self.lexicon.unspaced]
        self.names = list(PROFILES)
        self.structure = np.array([STRUCTURES.index(p[0]) for p in PROFILES.values()])
        self.functions_far = np.array([[1 - FUNCTIONS_FAR[s], FUNCTIONS_FAR[s]] for s in self.structure])
        self.profiles = [np.array([_shares(np.array(p[k], float)) for p in PROFILES.values()]) for k in (1, 2, 3)]

    def functions(self, text: str) -> np.ndarray:
        """How often each function word comes in a text."""
        tokens = text.split()
        codes = np.fromiter(map(self.kinds.__getitem__, tokens), np.int64, len(tokens))
        out = np.bincount(codes // _FUNCTION, minlength=len(self.lexicon.index) + 1)[1:]
        if not text.isascii() and len(_CJK.findall(text)) > 0.1 * len(text):
            for w, i in self.unspaced:
                out[i] += text.count(w)
        return out

    def _block(self, b: Block, text: str, tokens: list[str]) -> _Measured:
        m = _Measured()
        codes = np.fromiter(map(self.kinds.__getitem__, tokens), np.int64, len(tokens))
        kind, sizes, letters = codes & 7, (codes // _LENGTH) & ((1 << 20) - 1), (codes // _LETTERS) & 4095
        for i in np.flatnonzero(sizes >= 4095):  # too long for the token's number
            sizes[i] = len(tokens[i])
            letters[i] = len(tokens[i].strip(_TRIM)) if letters[i] else 0
        m.kinds = np.bincount(kind, weights=sizes, minlength=_KINDS)
        m.words, m.letters = int((kind <= 2).sum()), int(letters.sum())
        m.functions = np.bincount(codes // _FUNCTION, minlength=len(self.lexicon.index) + 1)[1:]
        m.chars = np.bincount(_TABLE[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)], minlength=9)[:8].astype(float)
        if m.chars[5] > 0.1 * m.chars.sum() and _CJK.search(text):
            # without spaces every character counts as a word; the words of the list are looked for as they are
            n = len(_CJK.findall(text))
            for w, i in self.unspaced:
                m.functions[i] += text.count(w)
            f = min(n, int(sum(len(w) * m.functions[i] for w, i in self.unspaced)))
            marked = sum(len(t) for t in tokens if not _CJK.search(t))
            m.kinds = np.array([f, n - f, 0, sum(ch.isdigit() for ch in text), marked], float)
            m.words, m.letters = n, n
        lines = len(b.lines)
        if b.at == 0 and lines >= 3 and m.chars[5] < 0.1 * m.chars.sum() and len(tokens) / lines <= ENTRY_WORDS:
            sentences = text.count(". ") + sum(ln.rstrip().endswith((".", "!", "?")) for ln in b.lines)
            if len(tokens) > 5 * lines:
                sentences += text.count(", ") / 2
            if sentences * 5 < lines and len(tokens) > lines:
                b.at = 1
        m.at = np.zeros(len(LAYOUTS))
        m.at[b.at] = 1
        return m

    def measure(self, texts: list[str | None]) -> dict[str, list]:
        """Values of COLUMNS, by name."""
        found, measured, repeats, words = [], [], [], []
        for t in texts:
            bs = blocks(t) if t else []
            found.append(bs)
            parts = ["\n".join(b.lines) for b in bs]
            tokens = [p.split() for p in parts]
            ms = [self._block(b, p, k) for b, p, k in zip(bs, parts, tokens, strict=True)]
            measured.append(ms)
            words.append(tokens)
            repeats.append(self._repeats("\n".join(parts), tokens, ms) if bs else (0.0, False))
        every = [m for ms in measured for m in ms]
        functions = np.array([sum((m.functions for m in ms), np.zeros(len(self.lexicon.index))) for ms in measured])
        languages = [self.lexicon.language(f) for f in functions]
        if every:
            vectors = [np.array([getattr(m, k) for m in every], float) for k in ("kinds", "chars", "at")]
            far = sum(w * jensen_shannon(v / np.maximum(v.sum(1, keepdims=True), 1e-12), p) for w, v, p in zip(WEIGHTS, vectors, self.profiles, strict=True))
            apart = np.array([1.0 if k is None else self.lexicon.far(m.functions, k) for ms, k in zip(measured, languages, strict=True) for m in ms])
            sure = np.array([m.words / (m.words + SURE_WORDS) for m in every])
            far = far + FUNCTION_WEIGHT * sure[:, None] * jensen_shannon(np.stack([1 - apart, apart], 1), self.functions_far)
            nearest = np.argmin(far, axis=1)
        rows, i = [], 0
        for bs, ms, (top, again), f, language, tokens in zip(found, measured, repeats, functions, languages, words, strict=True):
            if not bs:
                rows.append((0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, None, "empty", "empty", 0.0, 0, False))
                continue
            size, distance = np.zeros(len(self.names)), 0.0
            for b in bs:
                size[nearest[i]] += b.size
                distance += b.size * float(far[i, nearest[i]])
                i += 1
            total = size.sum()
            by = np.bincount(self.structure, weights=size, minlength=len(STRUCTURES))
            prose = 0.0 if again else float(by[0] / total)
            plain = [k for k, s in enumerate(nearest[i - len(bs) : i]) if self.structure[s] == 0]
            if prose and (share := self._repeated("\n".join(ln for k in plain for ln in bs[k].lines), [tokens[k] for k in plain], 1 - 0.5 / prose)):
                prose *= 1 - share
                if prose < 0.5:
                    again = by[0] * share >= by[1:].max()
            structure = STRUCTURES[int(np.argmax(by))]
            chars, n_words = sum(m.chars for m in ms), sum(m.words for m in ms)
            marks = float(chars[[4, 6, 7]].sum() / max(1.0, chars.sum() - chars[2]))
            n_lines = sum(len(b.lines) for b in bs)
            stops = sum(ln.rstrip().endswith(_STOP) for b in bs for ln in b.lines) / n_lines
            rows.append((n_words, sum(m.letters for m in ms) / max(1, n_words), marks, stops, float(f.sum()) / max(1, n_words), top, distance / total, language, "one fragment, repeated" if again else self.names[int(np.argmax(size))], "junk" if again and structure == "prose" else structure, prose, int(total), prose < 0.5))
        return {n: list(v) for (n, _), v in zip(COLUMNS, zip(*rows, strict=True), strict=True)} if rows else {n: [] for n, _ in COLUMNS}

    @staticmethod
    def _repeated(text: str, split: list[list[str]], least: float) -> float:
        """The share of a text's characters that its commonest fragment has, or that lie in periodic runs.

        Runs are looked for only if tokens that come `REPEATS` times or more, which alone can be in one, have more than
        the share `least`.
        """
        cjk = not text.isascii() and len(_CJK.findall(text)) > 0.1 * len(text)
        top, fragments = 0.0, _ENDS.split(text)
        if len(fragments) >= REPEATS:
            count = Counter(f for f in (x.strip(_TRIM + " ") for x in fragments) if f)
            most = max((len(f) * k for f, k in count.items() if k >= REPEATS), default=0)
            top = most / max(1, sum(len(f) * k for f, k in count.items()))
        tokens = [ch for ch in text if not ch.isspace()] if cjk else split[0] if len(split) == 1 else [x for t in split for x in t]
        again = [(t, k) for t, k in Counter(tokens).items() if k >= REPEATS]
        if len(tokens) < REPEATS + _GRAM or sum(len(t) * k for t, k in again) <= least * sum(map(len, tokens)):
            return top
        number = {t: i for i, (t, _) in enumerate(again)}
        # a stretch of tokens that comes at least REPEATS times at equal distances lies in a run; rarer tokens are in none
        ids = np.fromiter(map(number.get, tokens, repeat(-1)), np.int64, len(tokens))
        n = len(ids) - _GRAM + 1
        gram, often = np.zeros(n, np.int64), np.ones(n, bool)
        for k in range(_GRAM):
            often &= ids[k : n + k] >= 0
            gram = gram * np.int64(6364136223846793005) + ids[k : n + k] + 1
        order = np.flatnonzero(often)
        if len(order) < REPEATS:
            return top
        order = order[np.argsort(gram[order], kind="stable")]
        gram = gram[order]
        starts = np.zeros(len(ids), bool)
        for m in range(1, _IN_PERIOD + 1):  # the stretch may come several times in a period
            span = m * (REPEATS - 1)
            if len(order) <= span:
                break
            steps = [order[k * m + m : len(order) - span + k * m + m] - order[k * m : len(order) - span + k * m] for k in range(REPEATS - 1)]
            run = gram[span:] == gram[:-span]
            for x in steps[1:]:
                run &= x == steps[0]
            at = np.flatnonzero(run)
            for k in range(REPEATS):
                starts[order[at + k * m]] = True
        inside = starts.copy()
        for k in range(1, _GRAM):
            inside[k:] |= starts[:-k]
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        return max(top, float(sizes[inside].sum() / sizes.sum()))

    @staticmethod
    def _repeats(whole: str, tokens: list[list[str]], ms: list[_Measured]) -> tuple[float, bool]:
        """The share of the commonest fragment (sentence or line), and whether the text is one fragment over and over."""
        cjk = sum(m.chars[5] for m in ms) > 0.1 * sum(m.chars.sum() for m in ms)
        text = whole.replace("\n", ". ").replace("! ", ". ").replace("? ", ". ")
        if cjk:
            text = text.replace("。", ". ").replace("？", ". ").replace("！", ". ")
        fragments = text.split(". ")
        n = len(fragments)
        top = 0.0
        if n >= REPEATS:
            fragments = [f for f in map(str.strip, fragments) if f]
            fragments[-1:] = [fragments[-1].rstrip(".!?")] if fragments else []
            n = len(fragments)
            top = max(Counter(fragments).values()) / n if n >= REPEATS else 0.0
        units = len(whole) if cjk else sum(map(len, tokens))
        distinct = len(set(whole)) if cjk else len(set().union(*tokens))
        return top, top >= REPEATED or (distinct <= FEW_WORDS and units >= WORD_REPEATS * distinct)


COLUMNS = (
    ("n_words", "bigint"), ("mean_word_length", "double"), ("symbol_ratio", "double"), ("punctuated_lines", "double"), ("common_words", "double"), ("top_fragment", "double"),
    ("divergence", "double"), ("language", "string"), ("profile", "string"), ("structure", "string"), ("prose_share", "double"), ("characters", "bigint"), ("not_prose", "boolean"),
)


_ARROW = {"bigint": pa.int64(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_()}


def function_counts(df: DataFrame, words: list[tuple[str, str]], text: str = "text") -> dict[tuple[str, str], int]:
    """(language, word) -> how often the function word comes in all documents of the language."""
    shared = df.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = Quality(shared.value)
        lexicon, total = q.lexicon, {}
        for b in batches:
            for t in b.column(0).to_pylist():
                if t and (k := lexicon.language(f := q.functions(t))):
                    total[k] = total[k] + f if k in total else f
        names = list(lexicon.index)
        got = [(k, names[i], int(f[i])) for k, f in total.items() for i in np.flatnonzero(f)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in got], pa.string()), pa.array([r[1] for r in got], pa.string()), pa.array([r[2] for r in got], pa.int64())], ["lang", "word", "n"])

    counted = df.select(c(text).cast("string").alias("text")).where("text IS NOT NULL").mapInArrow(run, "lang string, word string, n bigint")
    return {(r[0], r[1]): r[2] for r in counted.groupBy("lang", "word").agg(F.sum("n")).collect()}  # at most the words of each language


def text_quality(df: DataFrame, common_words: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The id and COLUMNS of every row."""
    words = [(r[0], r[1]) for r in common_words.select("lang", "word").where("lang IS NOT NULL AND word IS NOT NULL").distinct().limit(MAX_WORDS + 1).collect()]
    if len(words) > MAX_WORDS:
        raise ValueError(f"more than {MAX_WORDS} common words")
    words.sort()
    shared = df.sparkSession.sparkContext.broadcast((words, function_counts(df, words, text)))
    kind = df.schema[doc_id].dataType.simpleString()
    one = df.select(c(doc_id).alias("id"), c(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = Quality(*shared.value)
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                got = q.measure(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(got[n], _ARROW[k]) for n, k in COLUMNS)], ["id", *(n for n, _ in COLUMNS)])

    return one.mapInArrow(run, f"id {kind}, " + ", ".join(f"{n} {k}" for n, k in COLUMNS)).withColumnRenamed("id", doc_id)
