"""Words and word shingles of whole texts as 64-bit numbers, for a slice of texts at a time.

A word is a run of bytes other than the space and 0x09-0x0D, with A-Z lower-cased. A document's shingles are its
distinct runs of five words; with fewer words the whole sequence is its only one; without words it has none. Two
different shingles get the same number with a chance of about 2**-60, as with any 64-bit hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tidemill.llm.shared import utf8

WIDTH = 5
BLOCK = 1_000_000

_random = np.random.default_rng(20260701)
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
#: Everything but letters; bytes of signs beyond ASCII count as letters.
NOT_LETTERS = np.ones(256, bool)
NOT_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
_BASE = 0x9E3779B97F4A7C15 | 5
_PLACE = _random.integers(1, 2**63, WIDTH, dtype=np.uint64) | np.uint64(1)
_powers: list[np.ndarray] = []


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK + 4096)
        inverse = pow(_BASE, -1, 2**64)
        tables = []
        for base in (_BASE, inverse):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        _powers[:] = tables
    return _powers[0], _powers[1]


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run ``values[start:end]`` of 64-bit numbers: a polynomial, so one running sum serves all runs."""
    up, down = _power_tables(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _PLACE[0])


def spans(texts: pa.Array, gaps: np.ndarray, stems: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes outside ``gaps`` (a table of 256): (hash, begin and end in the bytes of all texts, ``first`` with those
    of text i at ``first[i]:first[i+1]``). With ``stems`` the hash has a column for the whole run and one for its first so
    many bytes each."""
    raw, offsets = utf8(texts)
    hashes, begins, limits, at = [], [], [], 0
    while at < len(raw):  # in blocks, cut after a space or between texts, so that memory stays bounded
        end = at + BLOCK
        if end >= len(raw):
            end = len(raw)
        else:
            while True:
                spaces = np.flatnonzero(gaps[raw[at:end]])
                limit = offsets[np.searchsorted(offsets, end, side="right") - 1]
                cut = max(at + int(spaces[-1]) + 1 if len(spaces) else at, int(limit))
                if cut > at or end == len(raw):
                    end = cut if cut > at else end
                    break
                end = min(len(raw), at + 2 * (end - at))  # one word longer than the block
        part = raw[at:end]
        solid = ~gaps[part]
        edge = np.zeros(len(part) + 1, bool)
        inside = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, end, side="right")] - at
        edge[inside] = True
        edge[0] = edge[-1] = True
        before = np.empty(len(part), bool)
        before[0], before[1:] = False, solid[:-1]
        starts = np.flatnonzero(solid & (~before | edge[:-1]))
        after = np.empty(len(part), bool)
        after[-1], after[:-1] = False, solid[1:]
        ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
        if len(starts):
            values = _BYTE[part]
            found = run_hashes(values, starts, ends)
            if stems:
                found = np.column_stack([found, *[run_hashes(values, starts, np.minimum(starts + k, ends)) + np.uint64(k) for k in stems]])
            hashes.append(found)
            begins.append(starts + at)
            limits.append(ends + at)
        at = end
    if not hashes:
        none = np.zeros(0, np.int64)
        return np.zeros((0, 1 + len(stems)) if stems else 0, np.uint64), none, none, np.zeros(len(offsets), np.int64)
    begins = np.concatenate(begins)
    return np.concatenate(hashes), begins, np.concatenate(limits), np.searchsorted(begins, offsets)


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, ``first`` with the words of text i at ``first[i]:first[i+1]``)."""
    hashes, _, _, first = spans(texts, _SPACE)
    return hashes, first


def runs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every shingle in order, repeats included, ``first`` with those of text i at ``first[i]:first[i+1]``)."""
    h, first = words(texts)
    n = len(h)
    out = np.zeros(n, np.uint64)
    for i in range(WIDTH):
        out[: max(0, n - WIDTH + 1)] += h[i : max(i, n - WIDTH + 1 + i)] * _PLACE[i]
    out = mixed(out, WIDTH)
    keep = np.ones(n + 1, bool)
    size = np.diff(first)
    for back in range(1, WIDTH):  # the last four words of a text begin no shingle
        keep[first[1:][size >= back] - back] = False
    for i in np.flatnonzero((size > 0) & (size < WIDTH)).tolist():
        begin, end = int(first[i]), int(first[i + 1])
        with np.errstate(over="ignore"):
            short = np.uint64(end - begin) * _PLACE[-1]
            for k in range(begin, end):
                short = short * _PLACE[k - begin] + h[k]
        out[begin] = mixed(np.array([short], np.uint64), end - begin)[0]
        keep[begin] = True
    keep[n] = False
    place = np.zeros(n + 1, np.int64)
    np.cumsum(keep[:n], out=place[1:])
    return out[keep[:n]], place[first]


def shingles(texts: pa.Array):
    """For each text the hashes of its distinct shingles, ascending."""
    h, first = runs(texts)
    for begin, end in zip(first[:-1].tolist(), first[1:].tolist()):
        yield np.unique(h[begin:end])


def shingle_texts(text: str) -> set[bytes]:
    """The distinct shingles themselves."""
    found = text.encode("utf-8").translate(_LOWER).split(None)
    if len(found) < WIDTH:
        return {b" ".join(found)} if found else set()
    return {b" ".join(found[i : i + WIDTH]) for i in range(len(found) - WIDTH + 1)}
