"""Pre-tokens of byte-level BPE vocabularies, found for a slice of texts at once.

The split is the public pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``,
worked out on arrays of code points: runs of letters, of numbers, of other signs and of white space, a blank joined to
the run after it, and the short endings after an apostrophe cut off. Strings of special tokens cut a text into pieces.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex

from tidemill.llm.words import run_hashes

LETTER, NUMBER, OTHER, SPACE = 1, 2, 3, 4
_classes: list[np.ndarray] = []
_POINT = np.random.default_rng(77).integers(1, 2**63, 2**16, dtype=np.uint64) | np.uint64(1)


def char_classes() -> np.ndarray:
    """Class of every code point."""
    if not _classes:
        every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
        points = np.frombuffer(every.encode("utf-32-le"), np.uint32)
        kinds = np.full(0x110000, OTHER, np.uint8)
        for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
            for m in regex.finditer(pattern, every):
                kinds[points[m.start() : m.end()]] = kind
        _classes.append(kinds)
    return _classes[0]


class Known:
    """Numbers kept by hash: a short table of new ones before a sorted array; emptied beyond ``most``, so memory is bounded."""

    def __init__(self, most: int = 3_000_000, recent: int = 60_000):
        self.most, self.most_recent = most, recent
        self.clear()

    def clear(self) -> None:
        self.hashes, self.values = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.recent: dict[int, int] = {}

    def __len__(self) -> int:
        return len(self.hashes) + len(self.recent)

    def get(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 where unknown."""
        look = self.recent.get
        out = np.array([look(h, -1) for h in hashes.tolist()], np.int64)
        if len(self.hashes):
            open_ = np.flatnonzero(out < 0)
            wanted = hashes[open_]
            at = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
            out[open_] = np.where(self.hashes[at] == wanted, self.values[at], -1)
        return out

    def put(self, hashes: np.ndarray, values: np.ndarray) -> None:
        self.recent.update(zip(hashes.tolist(), values.tolist()))
        if len(self.recent) > self.most_recent:
            keys = np.concatenate([self.hashes, np.fromiter(self.recent.keys(), np.uint64, len(self.recent))])
            values = np.concatenate([self.values, np.fromiter(self.recent.values(), np.int64, len(self.recent))])
            order = np.argsort(keys, kind="stable")
            self.hashes, self.values = keys[order], values[order]
            self.recent.clear()

    @property
    def full(self) -> bool:
        return len(self) > self.most


@dataclass
class Split:
    """``joined[starts[i]:ends[i]]`` is pre-token i, of text ``owner[i]``, with hash ``hashes[i]``.

    A special token has ``special[i]`` > 0: its place in the given list, from 1.
    """

    joined: str
    starts: np.ndarray
    ends: np.ndarray
    owner: np.ndarray
    hashes: np.ndarray
    special: np.ndarray


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct hashes, place of the first of each, for each hash its place among the distinct ones)."""
    back, found = pd.factorize(hashes)
    first = np.empty(len(found), np.int64)
    first[back[::-1]] = np.arange(len(hashes) - 1, -1, -1)
    return found, first, back


def split(texts: list[str], specials: list[str] | None = None) -> Split:
    pieces, owner, special = texts, np.arange(len(texts)), None
    if specials and any(s in "\0".join(texts) for s in specials):
        cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(specials, key=len, reverse=True)) + ")")
        pieces, owners, marks = [], [], []
        for i, text in enumerate(texts):
            for k, piece in enumerate(cut.split(text)):
                if piece:
                    pieces.append(piece)
                    owners.append(i)
                    marks.append(specials.index(piece) + 1 if k % 2 else 0)
        owner, special = np.array(owners, np.int64), np.array(marks, np.int64)
    joined = "".join(pieces)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(points)
    first = np.zeros(len(pieces) + 1, np.int64)
    np.cumsum([len(p) for p in pieces], out=first[1:])
    if not n:
        none = np.zeros(0, np.int64)
        return Split(joined, none, none, none, np.zeros(0, np.uint64), none)
    kind = char_classes().take(points, mode="clip")
    edge = np.zeros(n + 1, bool)  # the limits of pieces
    edge[first] = True
    begin = np.empty(n + 1, bool)  # where pre-tokens begin
    begin[0] = begin[n] = True
    begin[1:n] = kind[1:] != kind[:-1]
    begin |= edge
    # white space before something else in its piece: its last character goes its own way, a blank to what follows
    last = np.flatnonzero((kind == SPACE)[: n - 1] & begin[1:n] & ~edge[1:n])
    begin[last] = True
    blank = last[points[last] == 32]
    begin[blank + 1] = False
    # an apostrophe alone, not after a joined blank, with one of the endings
    quote = np.flatnonzero(points[: n - 1] == 39)
    quote = quote[begin[quote] & begin[quote + 1] & ~edge[quote + 1] & (kind[quote + 1] == LETTER)]
    if len(quote):
        follow = points[quote + 1]
        one = quote[np.isin(follow, [ord(c) for c in "stmd"])]
        rest = quote[quote + 2 < n]
        rest = rest[~edge[rest + 2]]
        pair = points[rest + 1].astype(np.int64) * 2**21 + points[rest + 2]
        two = rest[np.isin(pair, [ord(a) * 2**21 + ord(b) for a, b in ("re", "ve", "ll")])]
        for found, width in ((one, 1), (two, 2)):
            begin[found + 1] = False
            begin[found + 1 + width] = True
    if special is not None and special.any():
        for piece in np.flatnonzero(special):
            begin[first[piece] + 1 : first[piece + 1]] = False
    limits = np.flatnonzero(begin)
    starts, ends = limits[:-1], limits[1:]
    values = _POINT.take(points, mode="wrap")
    if points.max() > 0xFFFF:
        values += (points >> np.uint32(16)).astype(np.uint64)
    piece = np.searchsorted(first, starts, side="right") - 1
    marks = special[piece] if special is not None else np.zeros(len(starts), np.int64)
    return Split(joined, starts, ends, owner[piece], run_hashes(values, starts, ends), marks)
