"""A compressed FM-index over sequences of words: suffix order, wavelet matrix, backward search.

The index holds passages, each with a document number. For every place of a passage that is searched, the
question is how long a match with a smaller document starts there, up to ``window`` words: a window is found
if some passage of a smaller document holds it. What is kept are the bits of the wavelet matrix with their
running counts, and per row of the suffix order the borders of its class of ``window - 1`` words and the
smallest document of its class of ``window`` words. The suffix order itself is dropped.
"""

from __future__ import annotations

import numpy as np

#: Passages that are searched in step; bounds the memory of a search.
BATCH = 4096


def suffix_ranks(symbols: np.ndarray, n_ends: int) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Order of all suffixes, by doubling, and the ranks by their first 1, 2, 4, ... symbols.

    ``symbols`` below ``n_ends`` occur once each (the ends of passages), so no comparison goes past an end.
    """
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    ranks, length = {1: rank}, 1
    order = np.argsort(rank)
    while rank.max(initial=0) < n - 1:
        follow = np.zeros(n, np.int64)
        follow[:-length] = rank[length:] + 1
        key = rank * (n + 1) + follow
        order = np.argsort(key)
        sorted_key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        length *= 2
        ranks[length] = rank
    return order, ranks


class WaveletMatrix:
    """Counts of a symbol before a place, in one step per bit of the symbol."""

    def __init__(self, sequence: np.ndarray, n_symbols: int):
        self.bits, self.before, self.zeros = [], [], []
        self.levels = max(1, int(n_symbols - 1).bit_length())
        for level in range(self.levels - 1, -1, -1):
            bit = ((sequence >> level) & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            words = np.zeros(len(bit) // 64 + 1, np.uint64)
            words.view(np.uint8)[:len(packed)] = packed
            counts = np.bitwise_count(words).astype(np.int64)
            self.bits.append(words)
            self.before.append(np.cumsum(counts) - counts)
            self.zeros.append(int(len(bit) - bit.sum()))
            sequence = np.concatenate([sequence[~bit], sequence[bit]])
        self.start = self._walk(np.arange(n_symbols), np.zeros(n_symbols, np.int64))

    def _walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k in range(self.levels):
            word, rest = at >> 6, (at & 63).astype(np.uint64)
            low = self.bits[k][word] & ((np.uint64(1) << rest) - np.uint64(1))
            ones = self.before[k][word] + np.bitwise_count(low)
            up = (symbol >> (self.levels - 1 - k)) & 1
            at = np.where(up == 1, self.zeros[k] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._walk(symbol, at) - self.start[symbol]


class FMIndex:
    """Passages (arrays of word numbers from 0 to ``n_words`` - 1) with their documents."""

    def __init__(self, passages: list[np.ndarray], documents: np.ndarray, n_words: int, window: int):
        self.window, count = window, len(passages)
        lengths = np.array([len(p) for p in passages], np.int64)
        ends = np.cumsum(lengths + 1) - 1
        text = np.empty(int(ends[-1]) + 1, np.int64)
        inside = np.ones(len(text), bool)
        inside[ends] = False
        text[inside] = np.concatenate(passages) + count
        text[ends] = np.arange(count)
        order, ranks = suffix_ranks(text, count)
        # in the transform all ends are symbol 0 and word w is w + 1; the symbol before the first place is an end
        symbols = np.where(inside, text - count + 1, 0)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=n_words + 1))])
        self.matrix = WaveletMatrix(symbols[order - 1], n_words + 1)
        owner = np.repeat(np.asarray(documents, np.int64), lengths + 1)[order]
        shorter, whole = (self._classes(order, ranks, length) for length in (window - 1, window))
        sizes = np.diff(np.append(shorter, len(order)))
        self.low = np.repeat(shorter, sizes)
        self.high = np.repeat(shorter + sizes, sizes)
        self.smallest = np.repeat(np.minimum.reduceat(owner, whole), np.diff(np.append(whole, len(order))))
        self.rows = len(order)

    @staticmethod
    def _classes(order: np.ndarray, ranks: dict[int, np.ndarray], length: int) -> np.ndarray:
        """First rows of the runs of suffixes that share their first ``length`` symbols."""
        half = max(h for h in ranks if h <= max(1, length))
        rank = ranks[half]
        later = np.minimum(order + max(0, length - half), len(order) - 1)
        same = (rank[order][1:] == rank[order][:-1]) & (rank[later][1:] == rank[later][:-1])
        if length == 0:
            same[:] = True
        return np.concatenate([[0], np.flatnonzero(~same) + 1])

    def smallest_documents(self, passages: list[np.ndarray]) -> list[np.ndarray]:
        """For each window of each passage, the smallest document with that window.

        The passages have to be in the index, so that no search fails. A search goes from the last word to the
        first: the range of the window that starts one word later is widened to its first ``window`` - 1 words and
        narrowed by the word before them.
        """
        out: list[np.ndarray] = [np.empty(0, np.int64)] * len(passages)
        by_length = sorted(range(len(passages)), key=lambda i: -len(passages[i]))
        for at in range(0, len(by_length), BATCH):
            chosen = by_length[at:at + BATCH]
            lengths = np.array([len(passages[i]) for i in chosen])
            words = np.zeros((len(chosen), int(lengths[0])), np.int64)
            for row, i in enumerate(chosen):
                words[row, :lengths[row]] = passages[i][::-1]
            found = np.zeros((len(chosen), max(0, int(lengths[0]) - self.window + 1)), np.int64)
            low, high = np.zeros(len(chosen), np.int64), np.full(len(chosen), self.rows, np.int64)
            for step in range(words.shape[1]):
                active = int(np.searchsorted(-lengths, -step, side="left"))  # passages of more than `step` words
                a, b = low[:active], high[:active]
                if step >= self.window:
                    a, b = self.low[a], self.high[a]
                symbol = words[:active, step] + 1
                both = self.matrix.rank(np.concatenate([symbol, symbol]), np.concatenate([a, b]))
                low[:active] = self.first[symbol] + both[:active]
                high[:active] = self.first[symbol] + both[active:]
                if step >= self.window - 1:
                    found[:active, step - self.window + 1] = self.smallest[low[:active]]
            for row, i in enumerate(chosen):
                n = max(0, int(lengths[row]) - self.window + 1)
                out[i] = found[row, :n][::-1].copy()
        return out
