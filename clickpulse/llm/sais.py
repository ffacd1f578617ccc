"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

Induced sorting reads the array once from the left and once from the right and
puts, for each suffix met, the one a symbol longer at the next place of its bucket.
Here stretches of the array are read at once: as far as no suffix of the stretch
puts another one inside it, the order of the places is that of single steps.
"""

from __future__ import annotations

import numpy as np

_MOST = 1 << 16
#: Named texts up to this length are sorted directly; longer ones by induced sorting again.
_DIRECT = 1 << 17


def _types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one (the last, the sentinel, is)."""
    n = len(text)
    smaller = np.ones(n, bool)
    if n > 1:
        less = text[:-1] < text[1:]
        decided = np.append(text[:-1] != text[1:], True)
        where = np.where(decided, np.arange(n), n)
        next_decided = np.minimum.accumulate(where[::-1])[::-1]
        smaller = np.append(less, True)[next_decided]
    return smaller


def _ranks(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(rank of each entry among equal symbols, distinct symbols, their counts)``."""
    n = len(symbols)
    order = symbols.argsort(kind="stable")
    ordered = symbols[order]
    first = np.ones(n, bool)
    np.not_equal(ordered[1:], ordered[:-1], out=first[1:])
    head = first.nonzero()[0]
    count = np.empty(len(head), np.int64)
    count[:-1] = head[1:] - head[:-1]
    count[-1:] = n - head[-1:]
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n) - head.repeat(count)
    return rank, ordered[head], count


def _induce(text: np.ndarray, sa: np.ndarray, kind: np.ndarray, places: np.ndarray, step: int) -> None:
    """Fill ``sa`` with the suffixes of ``kind``, read in direction ``step`` (1 or -1) from bucket ``places`` on."""
    n = len(sa)
    at = 0 if step == 1 else n - 1
    size = 1024
    while 0 <= at < n:
        stop = min(n, at + size) if step == 1 else max(-1, at - size)
        part = sa[at:stop] if step == 1 else sa[at : stop if stop >= 0 else None : -1]
        live = (part > 0).nonzero()[0]
        before = part[live] - 1
        chosen = kind[before]
        live, before = live[chosen], before[chosen]
        done = abs(stop - at)
        if len(before):
            symbols = text[before]
            # The first new place of a symbol is where its bucket stands: read no further than to the nearest one.
            near = int(((places[symbols] - at) * step).min())
            if near < done:
                done = near
                keep = int(np.searchsorted(live, done))
                before, symbols = before[:keep], symbols[:keep]
            if len(before) == 1:
                c = symbols[0]
                sa[places[c]] = before[0]
                places[c] += step
            elif len(before):
                rank, distinct, count = _ranks(symbols)
                sa[places[symbols] + step * rank] = before
                places[distinct] += step * count
            size = min(_MOST, max(64, 2 * done))
        else:
            size = min(_MOST, 2 * size)
        at += step * done


def _direct(names: np.ndarray) -> np.ndarray:
    """Suffix array by doubling the compared length."""
    rank, width = names, 1
    n = len(names)
    while True:
        later = np.zeros(n, np.int64)
        later[: max(n - width, 0)] = rank[width:] + 1
        key = rank * (n + 2) + later
        order = np.argsort(key)
        rank = np.zeros(n, np.int64)
        rank[order[1:]] = np.cumsum(np.diff(key[order]) != 0)
        width *= 2
        if rank[order[-1]] == n - 1 or width > n:
            return order


def suffix_array(text: np.ndarray, size: int) -> np.ndarray:
    """Suffix array of ``text`` over symbols below ``size``; its last symbol is 0 and occurs nowhere else."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    smaller = _types(text)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1  # leftmost smaller ones
    count = np.bincount(text, minlength=size)
    tails = np.cumsum(count)
    heads = tails - count

    def induced(sorted_lms: np.ndarray) -> np.ndarray:
        sa = np.full(n, -1, np.int64)
        # Bucket tails, in the given order.
        rank, _, _ = _ranks(text[sorted_lms][::-1])
        sa[tails[text[sorted_lms]] - 1 - rank[::-1]] = sorted_lms
        _induce(text, sa, ~smaller, heads.copy(), 1)
        # The smaller ones are put anew from the right, the larger ones stay.
        kept = sa.copy()
        kept[(sa >= 0) & smaller[sa]] = -1
        kept[0] = n - 1
        _induce(text, kept, smaller, tails - 1, -1)
        return kept

    sa = induced(lms)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = sa[is_lms[sa]]

    # Name the substrings between leftmost smaller suffixes; neighbours in the order are compared symbol by symbol.
    ends = np.append(lms[1:], n - 1)
    length = np.zeros(n, np.int64)
    length[lms] = ends - lms + 1
    a, b = order[:-1], order[1:]
    same = length[a] == length[b]
    pairs = np.flatnonzero(same)
    if len(pairs):
        width = length[a[pairs]]
        start = np.cumsum(width) - width
        inside = np.arange(int(width.sum())) - np.repeat(start, width)
        differ = text[np.repeat(a[pairs], width) + inside] != text[np.repeat(b[pairs], width) + inside]
        same[pairs] = ~np.logical_or.reduceat(differ, start)
    names = np.concatenate([[0], np.cumsum(~same)])
    if names[-1] + 1 < len(lms):
        named = np.zeros(n, np.int64)
        named[order] = names
        rest = named[lms]
        order = lms[_direct(rest) if len(rest) <= _DIRECT else suffix_array(rest, int(names[-1]) + 1)]
    return induced(order)


def permuted_lcp(text: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each position, the symbols its suffix shares with the one before it in the array (``text`` of uint8).

    Only suffixes whose predecessor is not also preceded by the same symbol are
    compared; the value of any other is one less than that of the position before.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    position = np.arange(n)
    free = (before < 0) | (position == 0) | (before == 0)
    inner = np.flatnonzero(~free)
    free[inner] = text[inner - 1] != text[before[inner] - 1]
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    word = np.zeros(n + 1, np.uint64)
    for k in range(8):
        word[:n] |= padded[k : k + n].astype(np.uint64) << np.uint64(8 * k)
    shared = np.zeros(n, np.int64)
    live = np.flatnonzero(free & (before >= 0))
    a, b = live.copy(), before[live]
    while len(live):
        differ = word[np.minimum(a, n)] ^ word[np.minimum(b, n)]
        equal = (differ == 0) & (a + 8 < n) & (b + 8 < n)
        low = differ & (~differ + np.uint64(1))
        octets = np.where(differ == 0, 8, np.bitwise_count(low - np.uint64(1)).astype(np.int64) // 8)
        shared[live] += np.where(equal, 8, octets)
        live, a, b = live[equal], a[equal] + 8, b[equal] + 8
    # The sentinel is unique, so no match runs past the end.
    chain = np.where(free, shared + position, 0)
    return np.maximum(np.maximum.accumulate(chain) - position, 0)
