"""Word shingles of a text as 64-bit hashes, computed over byte arrays.

Words are runs of characters other than U+0020 and U+0009 to U+000D, with A-Z lower-cased. A
shingle is five words in a row; a text with one to four words is one shingle. The hash of a shingle
is a polynomial over its bytes (words joined by one space), taken from prefix sums, so no
word is handled in Python.
"""

from __future__ import annotations

import numpy as np

WIDTH = 5
_P = 0x9E3779B97F4A7C15
_INVERSE = pow(_P, -1, 1 << 64)
_BYTE = np.random.default_rng(2024).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
#: Bytes hashed at a time; a longer text goes in parts that overlap by one shingle.
_PART = 1 << 18


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


_tables: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``n`` powers or more of the base and of its inverse."""
    if not _tables or len(_tables[0]) < n:
        size = max(n, _PART + 1024)
        _tables[:] = [_powers(_P, size), _powers(_INVERSE, size)]
    return _tables[0], _tables[1]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Hash of every shingle of the whole text, in order; repeats stay."""
    joined = b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())
    if not joined:
        return np.empty(0, np.uint64)
    a = np.frombuffer(joined, np.uint8)
    gaps = np.flatnonzero(a == 32)
    starts, ends = np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(a)]))
    k = min(width, len(starts))
    starts, ends = starts[: len(starts) - k + 1], ends[k - 1 :]
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        # shingles whose bytes lie in one part; a shingle longer than a part gets its own
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + _PART, "right")))
        base = starts[lo]
        part = a[base : ends[hi - 1]]
        power, inverse = powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * power[: len(part)], out=sums[1:])
        s, e = starts[lo:hi] - base, ends[lo:hi] - base
        out[lo:hi] = (sums[e] - sums[s]) * inverse[s]
        lo = hi
    return _mix(out)


def shingle_set(text: str | None) -> np.ndarray:
    """Distinct shingle hashes, ascending."""
    return np.unique(shingle_hashes(text))
