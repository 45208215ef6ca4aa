"""Words and word windows of whole texts as 64-bit hashes, computed over UTF-8 bytes with numpy.

A word is a run of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are lower-cased: digits, a-z and every
non-ASCII character. All bytes of a non-ASCII character are 0x80 or more, so the rule holds byte by byte.
"""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(20240116)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True
BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)
WINDOW_BASE = np.uint64(0xD6E8FEB86659FD93)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    have = _powers.get(int(base))
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        out = []
        for b in (base, inverse):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = (out[0], out[1])
        if size <= 1 << 22:
            _powers[int(base)] = have
    return have[0][:n], have[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def range_sums(values: np.ndarray, base: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """(sums, inverse powers): the hash of values[i:j] is (sums[j] - sums[i]) * inverse[i]."""
    p, inv = powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * p[:-1], out=sums[1:])
    return sums, inv


def words(data: np.ndarray, off: np.ndarray):
    """(start byte, end byte, hash, text number) of every word; ``off`` are the texts' offsets in ``data``."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64), z
    low = LOWER[data]
    w = IS_WORD[low]
    first, last = w.copy(), w.copy()
    first[1:] &= ~w[:-1]
    last[:-1] &= ~w[1:]
    edges = off[(off > 0) & (off < n)]
    first[edges] = w[edges]
    last[edges - 1] = w[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums, inv = range_sums(BYTE_VALUE[low], BASE)
    h = mix((sums[ends] - sums[starts]) * inv[starts])
    return starts, ends, h, np.searchsorted(off, starts, "right") - 1


def spoken(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts' lower-cased words, a blank after each (bytes and offsets): equal for equal word sequences."""
    low = LOWER[data]
    starts, ends, _, text = words(data, off)
    many = ends - starts + 1
    said = np.full(int(many.sum()), 32, np.uint8)
    inner = np.ones(len(said), bool)
    inner[np.cumsum(many) - 1] = False
    said[inner] = low[IS_WORD[low]]
    return said, np.concatenate(([0], np.cumsum(np.bincount(text, weights=many, minlength=len(off) - 1)))).astype(np.int64)


def windows(h: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` words that stay within a text, and the number of each one's first word."""
    if len(h) < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    sums, inv = range_sums(h, WINDOW_BASE)
    at = np.flatnonzero(text[: len(h) - size + 1] == text[size - 1 :])
    return mix((sums[at + size] - sums[at]) * inv[at]), at


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted union of half-open intervals; touching ones become one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def cut(data: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start byte, end byte, text number) of the runs of bytes for which the table ``is_word`` holds; none crosses texts."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    w = is_word[data]
    first, last = w.copy(), w.copy()
    first[1:] &= ~w[:-1]
    last[:-1] &= ~w[1:]
    edges = off[(off > 0) & (off < n)]
    first[edges] = w[edges]
    last[edges - 1] = w[edges - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(off, starts, "right") - 1


def gathered(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes ``data[s : s + n]`` of all (s, n), one after the other."""
    ends = np.cumsum(lengths)
    return data[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]
