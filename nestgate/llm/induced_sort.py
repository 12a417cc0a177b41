"""Suffix arrays of one shard by induced sorting, and permuted common prefixes.

Suffixes are classified as smaller (S) or larger (L) than their right neighbour;
leftmost-smaller (LMS) substrings are sorted by induction and named, the suffixes
of the string of names are sorted, and their order induces the order of all
suffixes.  Buckets are scanned in waves: all entries of a bucket that are known at
once induce their left neighbours together, in scan order.  Names, whose buckets
are too small for waves, are sorted by doubling: what is still equal is ordered by
the ranks one, two, four ... names on, at most log2(names) times.
"""

from __future__ import annotations

import numpy as np

DENSE = 48       # mean bucket size from which waves beat a plain scan


def _put(sa, ptr, j, ch, down):
    """Adds suffixes ``j`` to the buckets of their symbols ``ch``, in order."""
    n = len(j)
    if not n:
        return
    order = np.argsort(ch, kind="stable")
    ch, j = ch[order], j[order]
    cut = np.flatnonzero(ch[1:] != ch[:-1]) + 1
    first = np.concatenate(([0], cut))
    size = np.diff(np.concatenate((first, [n])))
    symbol = ch[first]
    rank = np.arange(n) - np.repeat(first, size)
    base = np.repeat(ptr[symbol], size)
    if down:
        sa[base - 1 - rank] = j
        ptr[symbol] -= size
    else:
        sa[base + rank] = j
        ptr[symbol] += size


def _induce(t, small, counts, lms):
    """All suffixes from the LMS suffixes ``lms`` (in the wanted order)."""
    n, k = len(t), len(counts)
    ends = np.cumsum(counts)
    starts = ends - counts
    sa = np.full(n, -1, np.int32)
    tail = ends.copy()
    _put(sa, tail, lms[::-1], t[lms[::-1]], True)
    head = starts.copy()
    for c in range(k):
        done = starts[c]
        while done < head[c]:
            j = sa[done:head[c]] - 1
            done = head[c]
            j = j[j >= 0]
            j = j[~small[j]]
            _put(sa, head, j, t[j], False)
        if tail[c] < ends[c]:
            j = sa[tail[c]:ends[c]] - 1
            j = j[j >= 0]
            _put(sa, head, j, t[j], False)
    tail = ends.copy()
    sa[0], tail[0] = n - 1, 0
    for c in range(k - 1, -1, -1):
        done = ends[c]
        while tail[c] < done:
            j = sa[tail[c]:done][::-1] - 1
            done = tail[c]
            j = j[j >= 0]
            j = j[small[j]]
            _put(sa, tail, j, t[j], True)
        if starts[c] < head[c]:
            j = sa[starts[c]:head[c]][::-1] - 1
            j = j[j >= 0]
            j = j[small[j]]
            _put(sa, tail, j, t[j], True)
    return sa


def _induce_scan(t, small, counts, lms):
    """The same by a plain scan, for strings whose buckets are small."""
    n = len(t)
    ends = np.cumsum(counts)
    starts = ends - counts
    sa = [-1] * n
    text, is_small = t.tolist(), small.tolist()
    tail = ends.tolist()
    for j in lms[::-1].tolist():
        c = text[j]
        tail[c] -= 1
        sa[tail[c]] = j
    head = starts.tolist()
    for i in range(n):
        j = sa[i] - 1
        if j >= 0 and not is_small[j]:
            c = text[j]
            sa[head[c]] = j
            head[c] += 1
    tail = ends.tolist()
    sa[0], tail[0] = n - 1, 0
    for i in range(n - 1, -1, -1):
        j = sa[i] - 1
        if j >= 0 and is_small[j]:
            c = text[j]
            tail[c] -= 1
            sa[tail[c]] = j
    return np.array(sa, np.int32)


def _by_doubling(names: np.ndarray) -> np.ndarray:
    """Suffix array of ``names``, whose last symbol is the smallest and occurs nowhere else."""
    n = len(names)
    sa = np.argsort(names, kind="stable")
    new = np.ones(n, bool)                                   # an equal group starts here
    new[1:] = names[sa[1:]] != names[sa[:-1]]
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    slots = np.flatnonzero(~(new & np.append(new[1:], True)))     # places of groups of two or more
    length = 1
    while len(slots):
        at = sa[slots]
        key = rank[at] * n + rank[at + length]               # equal so far, so neither reaches the end
        order = np.argsort(key)
        at, key = at[order], key[order]
        sa[slots] = at
        new = np.ones(len(at), bool)
        new[1:] = key[1:] != key[:-1]
        rank[at] = np.maximum.accumulate(np.where(new, slots, 0))
        slots = slots[~(new & np.append(new[1:], True))]
        length *= 2
    return sa.astype(np.int32)


def suffix_array(t: np.ndarray, k: int) -> np.ndarray:
    """Suffix array of ``t`` (symbols below ``k``) whose last symbol is 0 and occurs nowhere else."""
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int32)
    # types: that of the next position with a different right neighbour
    step = np.sign(np.diff(t.astype(np.int32)))
    known = np.where(step != 0, np.arange(n - 1), n)
    nearest = np.minimum.accumulate(known[::-1])[::-1]
    small = np.ones(n, bool)
    small[:-1] = step[np.minimum(nearest, n - 2)] > 0
    lms = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(np.int32)
    counts = np.bincount(t, minlength=k)
    induce = _induce if n >= DENSE * k else _induce_scan
    m = len(lms)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    sa = induce(t, small, counts, lms)
    ranked = sa[is_lms[sa]]
    # names: adjacent LMS substrings with the same symbols share one
    size = np.ones(n, np.int32)
    size[lms[:-1]] = np.diff(lms) + 1
    a, b = ranked[:-1], ranked[1:]
    same = size[a] == size[b]
    at, length = np.flatnonzero(same), 0
    while len(at):
        equal = t[a[at] + length] == t[b[at] + length]
        same[at[~equal]] = False
        length += 1
        at = at[equal]
        at = at[size[a[at]] > length]
    name = np.concatenate(([0], np.cumsum(~same))).astype(np.int32)
    if name[-1] + 1 < m:
        of = np.empty(n, np.int32)
        of[ranked] = name
        below, names = of[lms], int(name[-1]) + 1
        lms = lms[suffix_array(below, names) if m >= DENSE * names else _by_doubling(below)]
    else:
        lms = ranked
    return induce(t, small, counts, lms)


def shard_string(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The parts one after the other as symbols, each closed by a separator, and their starts."""
    joined = b"\0".join(parts) + b"\0"
    t = np.frombuffer(joined, np.uint8).astype(np.uint16) + np.uint16(2)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    starts = np.cumsum(sizes) - sizes
    t[starts + sizes - 1] = 1
    return np.concatenate((t, np.zeros(1, np.uint16))), starts


def permuted_prefixes(t: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """For every position the common prefix (up to ``most``) with the suffix before it in the order.

    In text order the value falls by one at most from a position to the next, so positions whose
    left neighbour reached beyond ``most`` need no comparison up to that length.
    """
    n = len(t)
    phi = np.full(n, -1, np.int32)
    phi[sa[1:]] = sa[:-1]
    wide = np.concatenate((t, np.zeros(most + 4, t.dtype))).view(np.uint16)
    words = np.lib.stride_tricks.as_strided(wide.view(np.uint8), (n + most, 8), (2, 1), writeable=False)
    # four symbols at once
    four = np.empty(n + most, np.uint64)
    for i in range(0, n + most, 1 << 20):
        four[i:i + (1 << 20)] = np.ascontiguousarray(words[i:i + (1 << 20)]).view(np.uint64).ravel()
    out = np.zeros(n, np.int32)
    at, length = np.flatnonzero(phi >= 0), 0
    while length < most and len(at):
        equal = four[at + length] == four[phi[at] + length]
        out[at[equal]] = length + 4
        at = at[equal]
        length += 4
    out = np.minimum(out, most)
    # the last few symbols of positions that stopped inside a group of four
    short = np.flatnonzero((out < most) & (phi >= 0))
    for _ in range(3):
        more = wide[short + out[short]] == wide[phi[short] + out[short]]
        short = short[more]
        out[short] += 1
    return out
