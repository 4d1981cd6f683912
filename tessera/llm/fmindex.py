"""An FM-index over sequences of integers: a wavelet matrix of packed bits over the BWT.

Suffixes are sorted to a depth of DEPTH symbols, which is as far as patterns are followed.
"""

from __future__ import annotations

import numpy as np

DEPTH = 64
#: Windows of a query that are searched one after another; longer queries are cut, so that none is long.
PIECE = 32
_MASKS = (np.uint64(1) << np.arange(64, dtype=np.uint64)) - np.uint64(1)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, sigma: int):
        self.bits = max(1, int(sigma - 1).bit_length())
        self.words, self.ranks, self.zeros = [], [], []
        row = symbols
        for level in range(self.bits - 1, -1, -1):
            bit = ((row >> level) & 1).astype(np.uint8)
            padded = np.zeros((len(bit) // 64 + 1) * 64, np.uint8)
            padded[: len(bit)] = bit
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            self.words.append(words)
            self.ranks.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))])[:-1])
            self.zeros.append(int(len(bit) - bit.sum()))
            row = np.concatenate([row[bit == 0], row[bit == 1]])
        #: where each symbol's run begins in the last order
        self.first = self._down(np.arange(sigma), np.zeros(sigma, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k in range(self.bits):
            word = at >> 6
            ones = self.ranks[k][word] + np.bitwise_count(self.words[k][word] & _MASKS[at & 63])
            at = np.where((symbol >> (self.bits - 1 - k)) & 1, self.zeros[k] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often symbol stands before at."""
        return self._down(symbol, at) - self.first[symbol]


class FMIndex:
    """text: symbols from 1 up; separators are ordinary symbols that no pattern has."""

    def __init__(self, text: np.ndarray, sigma: int):
        text = np.append(text, 0)
        order, rank = suffix_order(text)
        self.n = len(text)
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        self.tree = WaveletMatrix(text[order - 1], sigma)

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of the suffixes that begin with symbol and go on as those from low to high."""
        both = self.tree.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high])) + np.tile(self.starts[symbol], 2)
        return both[: len(low)], both[len(low) :]


def suffix_order(text: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first `depth` symbols, by doubling, and their ranks."""
    rank, width = text.astype(np.int64), 1
    while True:
        after = np.zeros_like(rank)
        after[:-width] = rank[width:] + 1
        key = rank * (int(after.max()) + 1) + after
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank = np.empty_like(rank)
        rank[order] = new
        width *= 2
        if width >= depth or width >= len(text) or new[-1] == len(text) - 1:
            return order, rank


def repeated_spans(index: FMIndex, text: np.ndarray, begins: np.ndarray, ends: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each query text[begin:end] that are unions of windows with two or more occurrences in the index.

    All queries go on in step. Each is read from right to left: a backward search from an end
    follows the longest repeated factor (its matching statistic, cut at DEPTH). Where that factor is
    stopped, no window that holds the stopping factor repeats; a short factor at the left of the next
    window, if it has one occurrence, rules out all windows that hold it.
    Returns query, begin and end of the spans, relative to text.
    """
    who, low_at, high_at = [], [], []
    pieces = np.maximum(0, -(-(ends - begins - window + 1) // PIECE))
    query = np.repeat(np.arange(len(begins)), pieces)
    first = begins[query] + PIECE * (np.arange(len(query)) - np.repeat(pieces.cumsum() - pieces, pieces))
    end = np.minimum(ends[query], first + PIECE + window - 1)
    stop = np.maximum(first, end - DEPTH)
    probe = np.zeros(len(query), np.int64)  # 0: follows the longest factor; else the length of a probe
    goal = end.copy()  # the end to go on from if the probes don't rule it out
    at = end.copy()
    low, high = np.zeros(len(query), np.int64), np.full(len(query), index.n)
    while len(query):
        lo, hi = index.step(text[at - 1], low, high)
        twice = hi - lo >= 2
        low, high = np.where(twice, lo, low), np.where(twice, hi, high)
        at = at - twice
        event = ~twice | (at <= stop)
        if not event.any():
            continue
        i = np.flatnonzero(event)
        ok, s, e, p, f = twice[i], at[i], end[i], probe[i], first[i]
        long = p == 0
        found = long & (e - s >= window)
        who.append(query[i[found]])
        low_at.append(s[found])
        high_at.append(e[found])
        nxt_end, nxt_probe = e.copy(), p.copy()
        # a factor that was followed: on to the window that begins just before it
        nxt_goal = np.where(long, np.minimum(e - 1, s + window - 1), goal[i])
        nxt_probe = np.where(long, np.where(ok, 0, 4), p)
        # a probe with one occurrence: on to windows that end before its end
        out = ~long & ~ok
        nxt_goal = np.where(out, e - 1, nxt_goal)
        nxt_probe = np.where(out, 4, nxt_probe)
        # a probe with more: a longer one, or the whole window
        nxt_probe = np.where(~long & ok, np.where(p * 2 < window, p * 2, 0), nxt_probe)
        left = nxt_goal - window
        nxt_end = np.where(nxt_probe > 0, left + nxt_probe, nxt_goal)
        done = (left < f) | (long & ok & (s <= f))
        probe[i], goal[i], end[i], at[i] = nxt_probe, nxt_goal, nxt_end, nxt_end
        stop[i] = np.where(nxt_probe > 0, left, np.maximum(f, nxt_end - DEPTH))
        low[i], high[i] = 0, index.n
        if done.any():
            keep = np.ones(len(query), bool)
            keep[i[done]] = False
            query, first, end, stop, probe, goal, at, low, high = (x[keep] for x in (query, first, end, stop, probe, goal, at, low, high))
    none = np.empty(0, np.int64)
    return tuple(np.concatenate(x) if x else none for x in (who, low_at, high_at))
