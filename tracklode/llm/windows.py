"""Hashes of word windows over whole Arrow batches at once, without a Python loop over words.

A slice holds some rows' bytes one after the other. Words are found by a table of white space; a word's hash is a sum
of its bytes times powers of an odd number, and a range of words is hashed the same way from its words' hashes. Two
families, with other multipliers at both steps, give hashes that share nothing: together they are 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from tracklode.llm.common import CACHES, only

#: Odd multipliers of the families: for bytes, and for words.
FAMILIES = ((0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93), (0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F))
#: Bytes that are looked at together; one longer row is taken whole.
SLICE = 1 << 20
#: Bytes hashed at a time, so that tables of 8 bytes for each stay small; one longer word is taken whole.
SPAN = 1 << 18
#: Low bits of an order value that hold the position. No text of a row has 2**31 bytes.
PLACE = np.uint64(31)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd number, and of its inverse, mod 2**64."""
    known = _POWERS.get(base)
    if known is None or len(known[0]) < n:
        size, pair = max(n, SPAN + 1), []
        for k in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, k, np.uint64)
            steps[0] = 1
            pair.append(np.cumprod(steps))
        known = tuple(pair)
        if size <= 1 << 21:
            _POWERS[base] = known
            CACHES["windows"] = _POWERS.clear
    return known


def mixed(v: np.ndarray, by: int) -> np.ndarray:
    v = (v ^ (v >> np.uint64(32))) * np.uint64(by)
    v = (v ^ (v >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return v ^ (v >> np.uint64(32))


@dataclass
class Words:
    """Words of rows ``first`` to ``first + len(row_end) - 1`` of a batch: byte ranges, and where each row's words end."""

    data: np.ndarray
    first: int
    start: np.ndarray
    end: np.ndarray
    row_start: np.ndarray
    row_end: np.ndarray

    def hashes(self, family: int) -> np.ndarray:
        """A 64-bit hash of each word."""
        base, by = FAMILIES[family]
        out = np.zeros(len(self.start), np.uint64)
        i = 0
        while i < len(out):
            low = int(self.start[i])
            j = max(i + 1, int(np.searchsorted(self.end, low + SPAN, "right")))
            high = int(self.end[j - 1])
            power, inverse = powers(base, high - low + 1)
            total = np.zeros(high - low + 1, np.uint64)
            np.cumsum((self.data[low:high].astype(np.uint64) + np.uint64(1)) * power[: high - low], out=total[1:])
            a, b = self.start[i:j] - low, self.end[i:j] - low
            out[i:j] = mixed((total[b] - total[a]) * inverse[a], by)
            i = j
        return out

    def row_of(self, at: np.ndarray) -> np.ndarray:
        """Row, counted from ``first``, of the words at these positions."""
        return np.searchsorted(self.row_end, at, "right")


def ranges(hashes: np.ndarray, start: np.ndarray, end: np.ndarray, family: int) -> np.ndarray:
    """A 64-bit hash of each range of words."""
    base, by = FAMILIES[family][1], FAMILIES[1 - family][0]
    power, inverse = powers(base, len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * power[: len(hashes)], out=total[1:])
    return mixed((total[end] - total[start]) * inverse[start], by)


def sliced(column: pa.Array, lower: bool = False) -> Iterator[Words]:
    """The words of a binary column without nulls, some rows at a time; with ``lower`` A to Z are taken for a to z."""
    only("windows")
    column = column.cast(pa.large_binary())
    _, offsets, values = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE, "right")) - 1)
        low, high = int(offsets[i]), int(offsets[j])
        part, rows = data[low:high], offsets[i : j + 1] - low
        part = _LOWER[part] if lower else part
        blank = _BLANK[part]
        before = np.empty(len(part), bool)
        if len(part):
            before[0] = True
            before[1:] = blank[:-1]
            before[rows[:-1][rows[:-1] < len(part)]] = True
        start = np.flatnonzero(before & ~blank)
        after = np.empty(len(part), bool)
        if len(part):
            after[-1] = True
            after[:-1] = blank[1:]
            ends = rows[1:] - 1
            after[ends[ends >= 0]] = True
        # an empty row's end is the end of the row before, which is marked anyway
        end = np.flatnonzero(after & ~blank) + 1
        bounds = np.searchsorted(start, rows)
        yield Words(part, i, start, end, bounds[:-1], bounds[1:])
        i = j


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    step, n = 1, len(x) - width + 1
    while 2 * step <= width:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    return np.minimum(x[:n], x[width - step : width - step + n])


def blocks(words: Words, hashes: np.ndarray, window: int, core: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``anchor, place, first, count`` of the runs of windows of one row with one anchor.

    A window's anchor is the range of ``core`` words inside it whose hash comes first, the leftmost of equal ones;
    ``place`` is where it begins, ``first`` the run's first window.
    """
    n = len(hashes)
    none = np.zeros(0, np.int64)
    if n < window:
        return np.zeros(0, np.uint64), none, none, none
    at = np.arange(n - core + 1)
    anchor = ranges(hashes, at, at + core, 0)
    order = (anchor >> PLACE << PLACE) | at.astype(np.uint64)
    place = (sliding_min(order, window - core + 1) & ((np.uint64(1) << PLACE) - np.uint64(1))).astype(np.int64)
    inside = np.arange(len(place)) + window <= words.row_end[words.row_of(np.arange(len(place)))]
    # runs end where the anchor changes and where windows leave their row
    fresh = np.append(True, (place[1:] != place[:-1]) | (inside[1:] != inside[:-1]))
    start = np.flatnonzero(fresh)
    count = np.diff(np.append(start, len(place)))
    good = inside[start]
    start, count = start[good], count[good]
    return anchor[place[start]], place[start], start, count


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """The distinct hashes of each row's runs of ``size`` lower-cased words, in order; a row of fewer words has one, of all of
    them, and a row without words none."""
    out = []
    for words in sliced(column, lower=True):
        hashes, count = words.hashes(0), words.row_end - words.row_start
        made = np.where(count > size, count - size + 1, np.minimum(count, 1))
        start = np.repeat(words.row_start, made) + np.arange(made.sum()) - np.repeat(np.cumsum(made) - made, made)
        found = ranges(hashes, start, np.minimum(start + size, np.repeat(words.row_end, made)), 0)
        out += map(np.unique, np.split(found, np.cumsum(made)[:-1]))
    return out
