"""Words of many texts at once, as byte ranges and 64-bit hashes in NumPy arrays.

All word rules of these operators are rules on single ASCII characters, and every byte of
a longer UTF-8 character belongs to a word, so words can be found on bytes.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

from tasteloom.llm.base import utf8

SPACES = b" \t\n\x0b\x0c\r"
#: Bytes hashed at once; a block ends between words.
BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


@dataclass(frozen=True)
class Rule:
    """Which bytes make words, and whether A-Z counts as a-z."""

    alphanumeric: bool
    lower: bool

    def members(self) -> np.ndarray:
        found = np.ones(256, bool)
        if self.alphanumeric:
            found[:128] = False
            for first, last in (("0", "9"), ("A", "Z"), ("a", "z")):
                found[ord(first) : ord(last) + 1] = True
        else:
            found[list(SPACES)] = False
        return found


ALPHANUMERIC = Rule(True, True)
SPACED_LOWER = Rule(False, True)
SPACED = Rule(False, False)


@dataclass
class Words:
    """``starts`` and ``ends`` are byte offsets; row r has the words ``rows[r]:rows[r + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    hashes: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.rows)


@cache
def _powers(n: int, base: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        step = np.uint64(pow(base, done, 1 << 64))
        more = min(done, n - done)
        out[done : done + more] = out[:more] * step
        done += more
    return out


@cache
def _letters(lower: bool) -> np.ndarray:
    """A random odd number for every byte."""
    table = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
    if lower:
        table[ord("A") : ord("Z") + 1] = table[ord("a") : ord("z") + 1]
    return table


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a hash over all bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def _power(n: int, base: int) -> np.ndarray:
    size = 1 << max(10, int(n - 1).bit_length())
    return _powers(size, base)[:n]


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for every range of ``values``, equal for equal ranges wherever they stand."""
    n = len(values)
    if n == 0:
        return np.zeros(len(starts), np.uint64)
    inverse = pow(_BASE, -1, 1 << 64)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(values * _power(n, _BASE), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _power(n + 1, inverse)[starts])


def words(column: pa.Array, rule: Rule) -> Words:
    data, offsets = utf8(column)
    inside = rule.members()[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    rows = np.searchsorted(starts, offsets)
    hashes = np.empty(len(starts), np.uint64)
    table, at = _letters(rule.lower), 0
    while at < len(starts):
        low = starts[at]
        end = max(int(np.searchsorted(ends, low + BLOCK, side="right")), at + 1)
        block = table[data[low : ends[end - 1]]]
        hashes[at:end] = range_hashes(block, starts[at:end] - low, ends[at:end] - low)
        at = end
    return Words(data, starts, ends, rows, hashes)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words, over row limits too; see ``gram_rows``."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if k > 4:
        at = np.arange(n)
        return range_hashes(hashes, at, at + k)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out += hashes[i : i + n] * np.uint64(pow(_BASE, i + 1, 1 << 64))
    return mixed(out)


def row_of(rows: np.ndarray) -> np.ndarray:
    """The row of every word."""
    return np.repeat(np.arange(len(rows) - 1), np.diff(rows))


def inside_rows(rows: np.ndarray, k: int) -> np.ndarray:
    """For every word whether ``k`` words from it on belong to its row."""
    left = np.repeat(rows[1:], np.diff(rows)) - np.arange(rows[-1])
    return left >= k
