"""K-d trees over letter counts of words, and range searches with one edit.

A word is the vector of its letter counts. One replaced letter takes one from a count and adds one to another, one
inserted letter adds one: at most two in L1 distance. A search goes down the tree with the counts it may still take
and add, and leaves out every box that would need more. What it reaches is verified letter by letter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: a to z, and the code points from U+00C0 to U+00FF.
LETTERS = 26 + 64
#: Words of a leaf of the tree inside a cell.
LEAF = 48
#: Pairs of a word and a candidate that are looked at in one step.
PAIRS = 4_000_000


def letters_of(words: list[str]) -> np.ndarray:
    """Letter numbers of words of one length, a row per word."""
    points = np.array(words, dtype=f"<U{len(words[0])}").view(np.uint32).reshape(len(words), -1)
    return np.where(points < 128, points - 97, points - 0xC0 + 26).astype(np.uint8)


def counts_of(letters: np.ndarray) -> np.ndarray:
    out = np.zeros((len(letters), LETTERS), np.uint8)
    rows = np.arange(len(letters))
    for j in range(letters.shape[1]):
        out[rows, letters[:, j]] += 1
    return out


def signatures(counts: np.ndarray) -> np.ndarray:
    """128 bits per word whose differing bits never exceed the L1 distance: counts, up to two, of 64 groups of letters."""
    grouped = np.zeros((len(counts), 64), np.uint8)
    for letter in range(LETTERS):
        grouped[:, letter % 64] += counts[:, letter]
    bits = np.stack([grouped >= 1, grouped >= 2], axis=2).reshape(len(counts), 128)
    return np.packbits(bits, axis=1).view(np.uint64)


@dataclass
class Node:
    """A box, split where the counts of ``letter`` are at most ``cut``; a leaf has a number instead."""

    letter: int = -1
    cut: int = 0
    low: int = 0
    high: int = 255
    left: Node | None = None
    right: Node | None = None
    leaf: int = -1


def build(counts: np.ndarray, size: int) -> tuple[Node, list[np.ndarray]]:
    """The tree and the rows of each leaf. Leaves have up to ``size`` rows, or rows with all counts equal."""
    leaves: list[np.ndarray] = []

    def grow(rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> Node:
        best = None
        if len(rows) > size:
            own = counts[rows]
            spread = own.astype(np.float32).var(axis=0)
            for letter in np.argsort(-spread)[:4]:  # the cut that halves best among the widest spread
                if not spread[letter]:
                    break
                shares = np.cumsum(np.bincount(own[:, letter]))[:-1] / len(rows)
                cut = int(np.argmin(np.abs(shares - 0.5)))
                uneven = abs(shares[cut] - 0.5)
                if 0 < shares[cut] < 1 and (best is None or uneven < best[0]):
                    best = (uneven, int(letter), cut)
        if best is None:
            leaves.append(rows)
            return Node(leaf=len(leaves) - 1)
        _, letter, cut = best
        side = counts[rows, letter] <= cut
        node = Node(letter, cut, int(low[letter]), int(high[letter]))
        down, up = high.copy(), low.copy()
        down[letter], up[letter] = cut, cut + 1
        node.left, node.right = grow(rows[side], low, down), grow(rows[~side], up, high)
        return node

    root = grow(np.arange(len(counts)), np.zeros(LETTERS, np.int64), np.full(LETTERS, 255, np.int64))
    return root, leaves


def reach(root: Node, counts: np.ndarray, take: int, add: int):
    """``(leaf, rows)`` for each leaf whose box some rows can enter by taking and adding that many letters."""
    n = len(counts)
    stack = [(root, np.arange(n), np.zeros(n, np.int16), np.zeros(n, np.int16))]
    while stack:
        node, rows, taken, added = stack.pop()
        if not len(rows):
            continue
        if node.left is None:
            yield node.leaf, rows
            continue
        own = counts[rows, node.letter].astype(np.int16)
        # what this letter needs in the halves, instead of what it needed in the whole box
        down = taken + np.maximum(0, own - node.cut) - np.maximum(0, own - node.high)
        up = added + np.maximum(0, node.cut + 1 - own) - np.maximum(0, node.low - own)
        for child, a, b in ((node.left, down, added), (node.right, taken, up)):
            stays = (a <= take) & (b <= add)
            stack.append((child, rows[stays], a[stays], b[stays]))


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Do rows of ``a`` become those of ``b`` by one replaced letter, or, with a longer ``b``, one inserted letter?"""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    n = a.shape[1]
    ahead, behind = np.ones((len(a), n + 1), bool), np.ones((len(a), n + 1), bool)
    np.logical_and.accumulate(a == b[:, :n], axis=1, out=ahead[:, 1:])
    behind[:, :n] = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1)[:, ::-1]
    return (ahead & behind).any(axis=1)


class Cell:
    """Words of one length with a tree of their own. They come with the best first: that order settles every search."""

    def __init__(self, words: list[str]):
        self.length = len(words[0])
        self.letters = letters_of(words)
        counts = counts_of(self.letters)
        self.signatures = signatures(counts)
        self.root, self.leaves = build(counts, LEAF)

    def search(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many words of the cell are one edit away from each word (of one length), and the place of the first (-1: none)."""
        letters = letters_of(words)
        counts, n = counts_of(letters), letters.shape[1]
        marks = signatures(counts)
        found, best = np.zeros(len(words), np.int64), np.full(len(words), np.iinfo(np.int64).max)
        for leaf, rows in reach(self.root, counts, int(n >= self.length), int(n <= self.length)):
            inside = self.leaves[leaf]
            for at in range(0, len(inside), LEAF):  # only words with all counts equal make a leaf larger
                some = inside[at:at + LEAF]
                for start in range(0, len(rows), PAIRS // LEAF):
                    mine = rows[start:start + PAIRS // LEAF]
                    differ = np.bitwise_count(marks[mine, None, 0] ^ self.signatures[None, some, 0])
                    differ += np.bitwise_count(marks[mine, None, 1] ^ self.signatures[None, some, 1])
                    i, j = np.nonzero(differ <= 2)
                    i, j = mine[i], some[j]
                    a, b = letters[i], self.letters[j]
                    near = one_edit(a, b) if n <= self.length else one_edit(b, a)
                    i, j = i[near], j[near]
                    found += np.bincount(i, minlength=len(words))
                    np.minimum.at(best, i, j)
        return found, np.where(found > 0, best, -1)
