"""Suffix arrays by induced sorting, and permuted longest common prefixes.

Over a small alphabet both inducing passes go bucket by bucket: what a bucket induces is placed at once,
as the targets lie in later buckets or in the same bucket's next batch. The reduced string of names is
sorted by the same algorithm as long as its alphabet is small; names are mostly nearly as many as the
string is long, its buckets would then hold single suffixes, and ranks of tied suffixes are doubled
instead, in at most a third of the text's length.
"""

from __future__ import annotations

import numpy as np

SMALL_ALPHABET = 1024


def _types(s: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next (the sentinel counts as such)."""
    n = len(s)
    rise = np.sign(np.diff(s.astype(np.int32)))
    at = np.where(rise != 0, np.arange(n - 1), n - 1)
    at = np.minimum.accumulate(at[::-1])[::-1]
    out = np.ones(n, bool)
    out[:-1] = np.append(rise, 1)[at] > 0
    return out


def _induce(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray, k: int) -> np.ndarray:
    """The suffix array that the leftmost smaller suffixes induce, given in their order."""
    n = len(s)
    count = np.bincount(s, minlength=k)
    end = np.cumsum(count)
    start = end - count
    sa = np.full(n, -1, np.int32)
    seeds_of = np.bincount(s[lms], minlength=k)
    seeds_at = np.cumsum(seeds_of) - seeds_of
    seeds = lms[np.argsort(s[lms], kind="stable")]
    head = start.copy()

    def place(j: np.ndarray, forward: bool) -> None:
        c = s[j]
        order = np.argsort(c, kind="stable")
        c = c[order]
        own = np.bincount(c, minlength=k)
        within = np.arange(len(c)) - (np.cumsum(own) - own)[c]
        if forward:
            sa[head[c] + within] = j[order]
            head[:] += own
        else:
            sa[tail[c] - 1 - within] = j[order]
            tail[:] -= own

    used = np.flatnonzero(count).tolist()
    for c in used:
        done = start[c]
        while done < head[c]:  # larger suffixes of this bucket, which may induce more of it
            j = sa[done : head[c]] - 1
            done = int(head[c])
            j = j[j >= 0]
            j = j[~smaller[j]]
            if len(j):
                place(j, True)
        if seeds_of[c]:
            j = seeds[seeds_at[c] : seeds_at[c] + seeds_of[c]] - 1
            j = j[j >= 0]
            j = j[~smaller[j]]
            if len(j):
                place(j, True)
    larger_end = head.copy()
    tail = end.copy()
    sa[0] = n - 1
    tail[s[n - 1]] = start[s[n - 1]]
    for c in reversed(used):
        done = int(end[c]) if c != s[n - 1] else int(start[c])
        while done > tail[c]:
            j = sa[tail[c] : done][::-1] - 1
            done = int(tail[c])
            j = j[j >= 0]
            j = j[smaller[j]]
            if len(j):
                place(j, False)
        j = sa[start[c] : larger_end[c]][::-1] - 1
        if c == s[n - 1]:
            j = np.asarray([n - 2], np.int32)
        j = j[j >= 0]
        j = j[smaller[j]]
        if len(j):
            place(j, False)
    return sa


def _names(s: np.ndarray, lms: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, int]:
    """A name for each leftmost smaller substring, in text order; order: their positions, sorted."""
    length = np.zeros(len(s), np.int64)
    length[lms[:-1]] = np.diff(lms) + 1
    a, b = order[:-1], order[1:]
    same = (length[a] == length[b]) & (length[a] > 0)
    live, k = np.flatnonzero(same), 0
    while len(live):
        equal = s[a[live] + k] == s[b[live] + k]
        same[live[~equal]] = False
        k += 1
        live = live[equal]
        live = live[length[a[live]] > k]
    name = np.concatenate([[0], np.cumsum(~same)])
    out = np.zeros(len(s), np.int32)
    out[order] = name
    return out[lms], int(name[-1]) + 1


def _doubled(s: np.ndarray) -> np.ndarray:
    """Suffixes in order for a large alphabet: ranks by ever longer prefixes, of those that are still tied."""
    n = len(s)
    order = np.argsort(s, kind="stable")
    first = np.flatnonzero(np.diff(s[order], prepend=-1))
    rank = np.zeros(n, np.int64)  # the place of the first suffix that is tied with it
    rank[order] = np.repeat(first, np.diff(np.append(first, n)))
    tied = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
    span = 1
    while len(tied):
        key = rank[tied] << 32 | rank[np.minimum(tied + span, n - 1)]
        order = np.argsort(key)
        tied, key = tied[order], key[order]
        group = key >> 32
        at = np.arange(len(tied))
        start = np.maximum.accumulate(np.where(np.diff(key, prepend=-1) != 0, at, 0))
        base = np.maximum.accumulate(np.where(np.diff(group, prepend=-1) != 0, at, 0))
        rank[tied] = group + start - base
        tied = tied[np.bincount(start, minlength=len(tied))[start] > 1]
        span *= 2
    sa = np.empty(n, np.int32)
    sa[rank] = np.arange(n, dtype=np.int32)
    return sa


def suffix_array(s: np.ndarray, k: int) -> np.ndarray:
    """Suffixes in order; s: symbols below k, the last one the only 0."""
    s = s.astype(np.uint16 if k <= 1 << 16 else np.int32)
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int32)
    if k > SMALL_ALPHABET:
        return _doubled(s.astype(np.int64))
    smaller = _types(s)
    first = smaller.copy()
    first[0] = False
    first[1:] &= ~smaller[:-1]
    lms = np.flatnonzero(first).astype(np.int32)
    sa = _induce(s, smaller, lms, k)
    order = sa[first[sa]]
    names, kinds = _names(s, lms, order)
    if kinds < len(lms):
        order = lms[suffix_array(names, kinds)]
    return _induce(s, smaller, order, k)


def common_prefixes(s: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(plcp, phi): by text position, how much a suffix shares with the one before it in order, and that one (-1: none).

    A value is one less than its left neighbour's wherever both suffixes have the same symbol before
    them, so only the others, whose sum is small, are found by comparing."""
    n = len(s)
    phi = np.empty(n, np.int32)
    phi[sa[0]] = -1
    phi[sa[1:]] = sa[:-1]
    own = np.flatnonzero((phi <= 0) | (s[np.arange(n) - 1] != s[phi - 1]) | (np.arange(n) == 0))
    # eight bytes a step: symbols as single bytes, a 0 byte where a symbol is too large is never reached
    raw = np.zeros(2 * n + 16, np.uint8)
    raw[: 2 * n].view("<u2")[:] = s
    words = np.ndarray((n,), "<u8", raw.tobytes(), 0, (2,))
    plcp = np.zeros(n, np.int32)
    live = own[phi[own] >= 0]
    shift = np.zeros(len(live), np.int64)
    while len(live):
        a, b = live + shift, phi[live] + shift
        x = words[np.minimum(a, n - 1)] ^ words[np.minimum(b, n - 1)]
        end = x != 0
        low = x[end] & (~x[end] + np.uint64(1))
        plcp[live[end]] = shift[end] + (np.log2(low.astype(float)).astype(np.int64) >> 4)
        live, shift = live[~end], shift[~end] + 4
    last = np.zeros(n, np.int64)
    last[own] = own
    last = np.maximum.accumulate(last)
    return plcp[last] - (np.arange(n) - last).astype(np.int32), phi
