"""A trie of word triples in Elias-Fano levels, with quantised probabilities, searched by context.

A trie holds whole contexts: a context is a key (the last word, and a class of its history), below it lie
its successors (the words seen after it) and its predecessors (the words seen before it), and below a
predecessor the positions of words *within the successors of the context*, so deep levels have a small
universe.  Every level is one monotone sequence for all contexts together; a search for a child is a
search for the next value at or above a number, which all queries do at once.

The levels lie in one flat buffer and are read in place, from a memory map or any other buffer.

Probabilities are those of interpolated absolute discounting, in the back-off form: p(w | u, c) is stored
for triples seen, else it is backoff(u, c) times p(w | c), which is stored for pairs seen, else
backoff(c) times p(w).  What is stored is -log10 p in 16 bits, ``STEP`` codes per decade.
"""

from __future__ import annotations

import mmap

import numpy as np

STEP = 4096
MOST_CODE = (1 << 16) - 1
DISCOUNT = 0.75
# Searches done at once: their numbers stay in the processor's cache.
BLOCK = 1 << 16
ONES, HIGHS = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
# BIT[b, k]: position of the k-th set bit of the byte b.
BIT = np.zeros((256, 8), np.uint64)
for _b in range(256):
    _set = [k for k in range(8) if _b >> k & 1]
    BIT[_b, : len(_set)] = _set


def code_of(p: np.ndarray) -> np.ndarray:
    """-log10 p in whole steps."""
    return np.minimum(np.rint(-np.log10(p) * STEP), MOST_CODE).astype(np.int64)


def _byte_sums(x: np.ndarray) -> np.ndarray:
    """Set bits of each word's bytes, added up from the lowest byte."""
    s = x - ((x >> np.uint64(1)) & np.uint64(0x5555555555555555))
    s = (s & np.uint64(0x3333333333333333)) + ((s >> np.uint64(2)) & np.uint64(0x3333333333333333))
    return ((s + (s >> np.uint64(4))) & np.uint64(0x0F0F0F0F0F0F0F0F)) * ONES


def select_in_word(x: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Position of the ``k``-th (from 0) set bit of each word."""
    s, k = _byte_sums(x), k.astype(np.uint64)
    full = (((k * ONES) | HIGHS) - s) & HIGHS
    byte = ((full >> np.uint64(7)) * ONES) >> np.uint64(56) << np.uint64(3)
    before = ((s << np.uint64(8)) >> byte) & np.uint64(255)
    return (byte + BIT[((x >> byte) & np.uint64(255)).astype(np.int64), (k - before).astype(np.int64)]).astype(np.int64)


class EliasFano:
    """A non-decreasing sequence of whole numbers below ``universe``: low bits packed, high bits in unary.

    Lives in ``words``, a slice of a buffer: [n, low bits, words of low, words of high, low..., high..., ranks...].
    """

    def __init__(self, words: np.ndarray):
        self.n, self.l, n_low, n_high = (int(v) for v in words[:4])
        self.low, self.high = words[4 : 4 + n_low], words[4 + n_low : 4 + n_low + n_high]
        # Set bits before each word of ``high``, and zeros, which need not be stored.
        self.ones = words[4 + n_low + n_high : 5 + n_low + 2 * n_high].view(np.int64)
        self.zeros = np.arange(n_high + 1) * 64 - self.ones
        self.size = 5 + n_low + 2 * n_high

    @classmethod
    def pack(cls, values: np.ndarray, universe: int) -> np.ndarray:
        n = len(values)
        universe = max(int(universe), 1)
        l = max(0, (universe // max(n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        low = np.zeros((n * l + 63) // 64 + 1 if l else 0, np.uint64)
        if l:
            part = values & np.uint64((1 << l) - 1)
            at = np.arange(n, dtype=np.uint64) * np.uint64(l)
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            np.bitwise_or.at(low, word, part << bit)
            over = bit + np.uint64(l) > np.uint64(64)
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - bit[over]))
        n_bits = n + (universe >> l) + 2
        bits = np.zeros((n_bits + 63) // 64 * 64, np.uint8)
        bits[(values >> np.uint64(l)).astype(np.int64) + np.arange(n)] = 1
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        ones = np.concatenate([[0], np.cumsum(bits.reshape(-1, 64).sum(1, dtype=np.int64))])
        return np.concatenate([np.array([n, l, len(low), len(high)], np.uint64), low, high, ones.astype(np.uint64)])

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.l:
            return np.zeros(len(i), np.int64)
        at = i.astype(np.uint64) * np.uint64(self.l)
        word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        value = self.low[word] >> bit
        over = bit > np.uint64(0)
        value |= np.where(over, self.low[np.minimum(word + 1, len(self.low) - 1)] << ((np.uint64(64) - bit) & np.uint64(63)), np.uint64(0))
        return (value & np.uint64((1 << self.l) - 1)).astype(np.int64)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        """The values at the places ``i``."""
        word = np.searchsorted(self.ones, i, side="right") - 1
        at = word * 64 + select_in_word(self.high[word], i - self.ones[word])
        return (at - i) << self.l | self._lows(i)

    def _bucket(self, h: np.ndarray) -> np.ndarray:
        """How many values have high bits below ``h``: set bits before the ``h``-th zero."""
        k = np.maximum(h - 1, 0)
        word = np.minimum(np.searchsorted(self.zeros, k, side="right") - 1, len(self.high) - 1)
        at = word * 64 + select_in_word(~self.high[word], k - self.zeros[word])
        return np.where(h > 0, at - k, 0)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the first value at or above ``x``, whether it equals ``x``), for ``x`` below the universe."""
        h, low = x >> self.l, x & ((1 << self.l) - 1)
        lo, stop = self._bucket(h), self._bucket(h + 1)
        # Buckets hold about one value: only the searches still open go into the next round.
        open_ = np.flatnonzero(lo < stop)
        first, hi, want = lo[open_], stop[open_], low[open_]
        while len(open_):
            mid = (first + hi) >> 1
            below = self._lows(mid) < want
            first, hi = np.where(below, mid + 1, first), np.where(below, hi, mid)
            lo[open_] = first
            more = first < hi
            open_, first, hi, want = open_[more], first[more], hi[more], want[more]
        same = lo < stop
        same[same] = self._lows(lo[same]) == low[same]
        return lo, same


class Trie:
    """The levels of one shard, opened in place.

    ``contexts`` keys; ``succ``, ``pred`` children as context * universe + word; ``succ_at``, ``pred_at``,
    ``pair_at`` where the children of a context start, and its stretch of the deepest level; ``deep``
    positions among successors, per predecessor.
    """

    LEVELS = ("contexts", "succ", "pred", "succ_at", "pred_at", "pair_at", "deep")
    CODES = ("context_backoff", "succ_code", "pred_backoff", "deep_code")

    def __init__(self, buffer):
        words = np.frombuffer(buffer, np.uint64)
        self.universe, at = int(words[0]), 1
        for name in self.LEVELS:
            level = EliasFano(words[at:])
            setattr(self, name, level)
            at += level.size
        for name in self.CODES:
            n = int(words[at])
            size = (n + 3) // 4
            setattr(self, name, words[at + 1 : at + 1 + size].view(np.uint16)[:n])
            at += 1 + size
        self.size = at * 8

    @classmethod
    def pack(cls, key: np.ndarray, u: np.ndarray, w: np.ndarray, n: np.ndarray, p1: np.ndarray, universe: int) -> bytes:
        """The levels from counted triples (context, predecessor, successor, n), and p(w) of each triple's w.

        ``universe`` is above all ids, which start from 0.  Triples may come in any order; repeats add up.
        """
        contexts, c = np.unique(key, return_inverse=True)
        succ, s = np.unique(c * universe + w, return_inverse=True)
        pred, p = np.unique(c * universe + u, return_inverse=True)
        s_c, p_c = succ // universe, pred // universe
        many_s, many_p = np.bincount(s_c, minlength=len(contexts)), np.bincount(p_c, minlength=len(contexts))
        starts = [np.concatenate([[0], np.cumsum(v)]) for v in (many_s, many_p, many_s * many_p)]
        place = starts[2][c] + (p - starts[1][c]) * many_s[c] + (s - starts[0][c])
        deep, d = np.unique(place, return_inverse=True)
        n_c, n_s, n_p, n_d = (np.bincount(i, n, len(v)) for i, v in ((c, contexts), (s, succ), (p, pred), (d, deep)))
        below, after, word_p1 = np.empty(len(deep), np.int64), np.empty(len(deep), np.int64), np.empty(len(succ))
        below[d], after[d], word_p1[s] = p, s, p1
        context_backoff = DISCOUNT * many_s / n_c
        p2 = (n_s - DISCOUNT) / n_c[s_c] + context_backoff[s_c] * word_p1
        pred_backoff = DISCOUNT * np.bincount(below, minlength=len(pred)) / n_p
        p3 = (n_d - DISCOUNT) / n_p[below] + pred_backoff[below] * p2[after]
        levels = [
            (contexts, int(contexts[-1]) + 1 if len(contexts) else 1), (succ, len(contexts) * universe), (pred, len(contexts) * universe),
            *[(v, int(v[-1]) + 1) for v in starts], (deep, int(starts[2][-1]))]
        parts = [np.array([universe], np.uint64), *[EliasFano.pack(v, most) for v, most in levels]]
        for p_ in (context_backoff, p2, pred_backoff, p3):
            codes = np.zeros((len(p_) + 3) // 4 * 4, np.uint16)
            codes[: len(p_)] = code_of(p_)
            parts += [np.array([len(p_)], np.uint64), codes.view(np.uint64)]
        return np.concatenate(parts).tobytes()

    @classmethod
    def mapped(cls, packed: bytes) -> Trie:
        """A trie over an anonymous memory map: outside the Python heap, and no file on the worker."""
        held = mmap.mmap(-1, max(len(packed), 1))
        held.write(packed)
        return cls(held)

    def codes(self, key: np.ndarray, u: np.ndarray, w: np.ndarray, q1: np.ndarray) -> np.ndarray:
        """-log10 p(w | u, key) of many triples, in steps; ``q1`` is the code of p(w).  A negative id is an unknown word."""
        blocks = range(0, max(len(key), 1), BLOCK)
        return np.concatenate([self._codes(*(x[i : i + BLOCK] for x in (key, u, w, q1))) for i in blocks])

    def _codes(self, key: np.ndarray, u: np.ndarray, w: np.ndarray, q1: np.ndarray) -> np.ndarray:
        # Triples that follow each other in one context, or also share the predecessor, search for it once.
        new_key = np.diff(key, prepend=-2) != 0
        run, key = np.cumsum(new_key) - 1, key[new_key]
        contexts, known = self._find(self.contexts, key, key >= 0)
        c, in_c = contexts[run], known[run]
        s, in_s = self._find(self.succ, c * self.universe + w, in_c & (w >= 0))
        new = new_key | (np.diff(u, prepend=-2) != 0)
        p, in_p = self._find(self.pred, c[new] * self.universe + u[new], in_c[new] & (u[new] >= 0))
        pair = np.cumsum(new) - 1
        p, in_p = p[pair], in_p[pair]
        out = q1.copy()
        out[in_c] += self.context_backoff[c[in_c]]
        out[in_s] = self.succ_code[s[in_s]]
        out[in_p] += self.pred_backoff[p[in_p]]
        both = np.flatnonzero(in_s & in_p)
        run, s, p = run[both], s[both], p[both]
        starts = np.zeros((4, len(key)), np.int64)
        found = contexts[known]
        if len(found):
            starts[:, known] = self.pair_at[found], self.pred_at[found], self.succ_at[found], self.succ_at[found + 1]
        pairs, preds, first, last = starts[:, run]
        at = pairs + (p - preds) * (last - first) + (s - first)
        t, found = self._find(self.deep, at, np.ones(len(at), bool))
        out[both[found]] = self.deep_code[t[found]]
        return out

    @staticmethod
    def _find(level: EliasFano, x: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place, found = np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        if level.n:
            top = int(level[np.array([level.n - 1])][0])
            ok = np.flatnonzero(valid & (x <= top))
            place[ok], found[ok] = level.successor(x[ok])
        return place, found
