"""Suffix arrays by induced sorting, and permuted common prefixes, over one shard's bytes.

The sort is the linear one that classifies suffixes as S or L, sorts the leftmost-smaller (LMS) substrings,
names them, recurses on the string of names and induces all other suffixes from the sorted LMS ones. Induction
goes bucket by bucket; what one bucket's waiting entries induce is dealt to its buckets in one numpy step (a
stable sort by first symbol keeps the order that one-by-one induction has). Where the alphabet is nearly as
large as the string, as in recursion, plain loops are faster and are used instead.
"""

from __future__ import annotations

import numpy as np


def _s_types(t: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one; the last symbol is the unique smallest."""
    n = len(t)
    s = np.ones(n, bool)
    if n > 1:
        up, differs = t[:-1] < t[1:], np.flatnonzero(t[:-1] != t[1:])
        at = np.searchsorted(differs, np.arange(n - 1))  # the last symbol differs from the one before it
        s[:-1] = up[differs[at]]
    return s


def _deal(sa: np.ndarray, ptr: np.ndarray, t: np.ndarray, j: np.ndarray, way: int) -> None:
    """Put suffixes ``j`` at their buckets' pointers, in their order, upwards (1) or downwards (-1)."""
    if len(j) <= 8:
        for x in j.tolist():
            c = t[x]
            if way < 0:
                ptr[c] -= 1
                sa[ptr[c]] = x
            else:
                sa[ptr[c]] = x
                ptr[c] += 1
        return
    c = t[j]
    o = np.argsort(c, kind="stable")
    c, j = c[o], j[o]
    first = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1])))
    size = np.diff(np.append(first, len(c)))
    rank = np.arange(len(c)) - np.repeat(first, size)
    sa[ptr[c] + rank if way > 0 else ptr[c] - 1 - rank] = j
    ptr[c[first]] += way * size


def _induce_waves(t: np.ndarray, s: np.ndarray, lms: np.ndarray, counts: np.ndarray) -> np.ndarray:
    n = len(t)
    sa = np.zeros(n, np.int32)
    ends = np.cumsum(counts)
    heads = ends - counts
    own = np.searchsorted(t[lms], np.arange(len(counts) + 1))  # lms in order of first symbol
    ptr = heads.copy()
    used = np.flatnonzero(counts).tolist()
    for c in used:
        done = int(heads[c])
        while done < (upto := int(ptr[c])):
            j = sa[done:upto] - 1
            done = upto
            j = j[j >= 0]
            _deal(sa, ptr, t, j[~s[j]], 1)
        if own[c] < own[c + 1]:
            j = lms[own[c] : own[c + 1]] - 1
            _deal(sa, ptr, t, j[j >= 0], 1)
    l_end, ptr = ptr, ends.copy()
    for c in reversed(used):
        done = int(ends[c])
        while done > (upto := int(ptr[c])):
            j = sa[upto:done][::-1] - 1
            done = upto
            j = j[j >= 0]
            _deal(sa, ptr, t, j[s[j]], -1)
        j = sa[heads[c] : l_end[c]][::-1] - 1
        j = j[j >= 0]
        _deal(sa, ptr, t, j[s[j]], -1)
    sa[0] = n - 1
    return sa


def _induce_loops(t: np.ndarray, s: np.ndarray, lms: np.ndarray, counts: np.ndarray) -> np.ndarray:
    n, text, small = len(t), t.tolist(), s.tolist()
    ends = np.cumsum(counts)
    heads = ends - counts
    sa = [-1] * n
    tail = ends.tolist()
    for x in reversed(lms.tolist()):
        c = text[x]
        tail[c] -= 1
        sa[tail[c]] = x
    head = heads.tolist()
    for i in range(n):
        j = sa[i] - 1
        if j >= 0 and not small[j]:
            c = text[j]
            sa[head[c]] = j
            head[c] += 1
    tail = ends.tolist()
    for i in range(n - 1, -1, -1):
        j = sa[i] - 1
        if j >= 0 and small[j]:
            c = text[j]
            tail[c] -= 1
            sa[tail[c]] = j
    sa[0] = n - 1
    return np.array(sa, np.int32)


def suffix_array(t: np.ndarray, k: int) -> np.ndarray:
    """Suffix array of ``t`` (symbols below ``k``), whose last symbol is 0 and occurs nowhere else."""
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int32)
    s = _s_types(t)
    counts = np.bincount(t, minlength=k)
    induce = _induce_waves if n > 100 * np.count_nonzero(counts) else _induce_loops
    is_lms = np.zeros(n, bool)
    is_lms[1:] = s[1:] & ~s[:-1]
    at = np.flatnonzero(is_lms).astype(np.int32)
    sa = induce(t, s, at[np.argsort(t[at], kind="stable")], counts)
    if len(at) == 1:
        return sa
    found = sa[is_lms[sa]]  # LMS substrings in order
    size = np.zeros(n, np.int32)
    size[at[:-1]] = np.diff(at) + 1
    size[at[-1]] = 1
    # neighbours are equal if all symbols are; types then follow from the symbols up to the closing LMS position
    a, b = found[:-1], found[1:]
    new = size[a] != size[b]
    live, step = np.flatnonzero(~new), 0
    while len(live):
        live = live[step < size[a[live]]]
        x, y = a[live] + step, b[live] + step
        other = (t[x] != t[y]) | (s[x] != s[y])
        new[live[other]] = True
        live, step = live[~other], step + 1
    names = np.zeros(n, np.int32)
    names[found] = np.concatenate(([0], np.cumsum(new)))
    reduced, kinds = names[at], int(new.sum()) + 1
    if kinds == len(at):
        order = np.empty(len(at), np.int32)
        order[reduced] = np.arange(len(at), dtype=np.int32)
    else:
        order = suffix_array(reduced, kinds)
    return induce(t, s, at[order], counts)


def repeats(t: np.ndarray, sa: np.ndarray, size: int) -> np.ndarray:
    """Of each suffix, in text order: whether it shares ``size`` symbols (a multiple of 8) with a neighbour in ``sa``.

    The permuted array links each suffix to the one before it in order; common prefixes are compared in
    text order, eight symbols at a time, up to ``size``.
    """
    n = len(t)
    out = np.zeros(n, bool)
    if n <= size:
        return out
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    eight = np.lib.stride_tricks.sliding_window_view(np.concatenate((t.astype(np.uint8), np.zeros(8, np.uint8))), 8)
    eight = np.ascontiguousarray(eight).view(np.uint64).ravel()
    i = np.flatnonzero((before >= 0) & (before <= n - size))
    i = i[i <= n - size]
    j = before[i]
    for step in range(0, size, 8):
        same = eight[i + step] == eight[j + step]
        i, j = i[same], j[same]
    out[i] = True
    out[j] = True
    return out
