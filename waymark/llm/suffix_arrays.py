"""Suffix arrays by induced sorting, and permuted common prefixes, with whole-array operations.

Suffixes are classified; leftmost-smaller (LMS) substrings are sorted by inducing and named; the string of names is
sorted in turn; then all suffixes are induced from the sorted LMS suffixes. Inducing goes bucket by bucket: what a
bucket's suffixes induce, they induce in order, so each bucket is a few array operations, with one more round for
every repeat of its symbol. The string of names has as many symbols as names, for which buckets don't pay; its
recursion sorts pairs of ranks of doubling span.
"""

from __future__ import annotations

import numpy as np


def classified(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the next one. The last symbol is unique and smallest."""
    n = len(text)
    rise = np.sign(np.diff(text.astype(np.int32)))
    at = np.where(rise != 0, np.arange(n - 1), n)
    nearest = np.minimum.accumulate(at[::-1])[::-1]
    small = np.ones(n, bool)
    small[:-1] = np.where(nearest < n, rise[np.minimum(nearest, n - 2)] > 0, False)
    return small


def _dealt(places: np.ndarray, text: np.ndarray, queues: list[list[np.ndarray]]) -> None:
    """Appends positions to the queues of their symbols, in order."""
    if not len(places):
        return
    order = np.argsort(text[places], kind="stable")
    places = places[order]
    symbols = text[places]
    cut = np.flatnonzero(np.diff(symbols)) + 1
    for part in np.split(places, cut):
        queues[text[part[0]]].append(part)


def induced(text: np.ndarray, small: np.ndarray, lms: np.ndarray, symbols: int) -> np.ndarray:
    """The suffix array that follows from LMS suffixes in the order given."""
    own: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    _dealt(lms, text, own)
    large: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    empty = np.zeros(0, np.int64)

    def spread(places, symbol, wanted, queues):
        """Puts the predecessors of ``places`` in their queues; returns those of the same symbol."""
        before = places[places > 0] - 1
        before = before[small[before] == wanted]
        same = text[before] == symbol
        _dealt(before[~same], text, queues)
        return before[same]

    done_large = []
    for symbol in range(symbols):
        parts, current = [], np.concatenate(large[symbol]) if large[symbol] else empty
        while len(current):
            parts.append(current)
            current = spread(current, symbol, False, large)
        done_large.append(np.concatenate(parts) if parts else empty)
        if own[symbol]:
            spread(np.concatenate(own[symbol]), symbol, False, large)
    rest: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    out = []
    for symbol in range(symbols - 1, -1, -1):
        parts, current = [], np.concatenate(rest[symbol]) if rest[symbol] else empty
        while len(current):
            parts.append(current)
            current = spread(current, symbol, True, rest)
        if symbol == 0:
            parts = [np.array([len(text) - 1])]
        spread(done_large[symbol][::-1], symbol, True, rest)
        out.append(np.concatenate([done_large[symbol], *(p[::-1] for p in parts[::-1])]))
    return np.concatenate(out[::-1])


def _names(text: np.ndarray, order: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Ranks of LMS substrings sorted as ``order``; equal ones share a rank. ``size`` is by position."""
    a, b = order[:-1], order[1:]
    same = size[a] == size[b]
    live, k = np.flatnonzero(same), 0
    while len(live):
        live = live[size[a[live]] > k]
        equal = text[a[live] + k] == text[b[live] + k]
        same[live[~equal]] = False
        live, k = live[equal], k + 1
    return np.concatenate(([0], np.cumsum(~same)))


def _doubled(rank: np.ndarray) -> np.ndarray:
    """The order of all suffixes of a string of ranks."""
    n, k = len(rank), 1
    rank = rank.astype(np.int64)
    while True:
        after = np.zeros(n, np.int64)
        after[:-k] = rank[k:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        rank[order] = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        if rank[order[-1]] == n - 1:
            return order
        k *= 2


def suffix_array(text: np.ndarray, symbols: int) -> np.ndarray:
    """Positions of all suffixes in order; ``text`` holds 0 .. symbols - 1, with one 0, at its end."""
    small = classified(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(lms) > 1:
        sorted_once = induced(text, small, lms, symbols)
        is_lms = np.zeros(len(text), bool)
        is_lms[lms] = True
        order = sorted_once[is_lms[sorted_once]]
        size = np.zeros(len(text), np.int64)
        size[lms[:-1]] = np.diff(lms) + 1
        size[lms[-1]] = 1
        names = _names(text, order, size)
        if names[-1] == len(lms) - 1:
            lms = order
        else:
            of = np.zeros(len(text), np.int64)
            of[order] = names
            lms = lms[_doubled(of[lms])]
    return induced(text, small, lms, symbols)


def common_prefixes(text: np.ndarray, order: np.ndarray, stop: int) -> np.ndarray:
    """Of each position, the length it has in common with the suffix before it in ``order``; none goes past a symbol
    up to ``stop``.

    In text order a value is one less than the one before it, unless the symbols before both suffixes differ; only
    those irreducible values are computed by comparison.
    """
    n = len(text)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    at = np.arange(n)
    first = before < 0
    known = (at > 0) & (before > 0)
    reducible = np.zeros(n, bool)
    reducible[known] = (text[at[known] - 1] == text[before[known] - 1]) & (text[at[known] - 1] > stop)
    plain = np.flatnonzero(~reducible & ~first)
    value = np.zeros(n, np.int64)
    live, k = plain, 0
    while len(live):
        a, b = live + k, before[live] + k
        inside = np.maximum(a, b) < n
        live, a, b = live[inside], a[inside], b[inside]
        equal = (text[a] == text[b]) & (text[a] > stop)
        live, k = live[equal], k + 1
        value[live] = k
    last = np.maximum.accumulate(np.where(reducible, 0, at))
    return np.where(reducible, value[last] - (at - last), value)
