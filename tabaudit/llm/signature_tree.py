"""A signature tree over a bounded block of sets, and its dual traversal.

A leaf holds a few sets, a node the OR of the bitmaps below it and the range of their sizes. Two nodes are compared only
if some pair below them can still reach the threshold: the sizes must fit, and the bits that both bitmaps have, plus
what can hide behind shared bits, must allow the overlap that the smallest sizes need. Pairs that links already join
are passed over, so a block of near copies costs a spanning tree and not all its pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BITS = 2048
FANOUT = 8


def width_of(n: int) -> int:
    """Bits for a set of ``n`` shingles: a power of two, so that a bitmap of a large set doesn't fill up."""
    return max(BITS, 1 << max(0, int(n) - 1).bit_length())


def bitmap(shingles: np.ndarray, width: int = BITS) -> np.ndarray:
    bits = np.zeros(width, np.uint8)
    bits[(shingles >> np.uint64(17)) % np.uint64(width)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, width: int) -> np.ndarray:
    """A bitmap at a smaller width."""
    return np.bitwise_or.reduce(bits.reshape(-1, width // 64), axis=0)


def shared_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a & b).sum(axis=-1, dtype=np.int64)


@dataclass
class Level:
    bits: np.ndarray  # one bitmap for each node
    small: np.ndarray  # smallest and largest set below the node
    large: np.ndarray
    hidden: np.ndarray  # most shingles of one set that share a bit with another of its shingles


class Tree:
    """Sets in the order of their sizes, by bitmap; level 0 are the sets, each further level has a node for ``FANOUT``."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray):
        self.levels = [Level(bits, sizes, sizes, sizes - shared_bits(bits, bits))]
        while len(self.levels[-1].small) > 1:
            below = self.levels[-1]
            heads = np.arange(0, len(below.small), FANOUT)
            self.levels.append(
                Level(
                    np.bitwise_or.reduceat(below.bits, heads, axis=0),
                    np.minimum.reduceat(below.small, heads),
                    np.maximum.reduceat(below.large, heads),
                    np.maximum.reduceat(below.hidden, heads),
                )
            )


class Groups:
    """Union-find over the members of one block."""

    def __init__(self, labels: np.ndarray):
        _, first, inverse = np.unique(labels, return_index=True, return_inverse=True)
        self.up = first[inverse].tolist()

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def possible(a: Level, i: np.ndarray, b: Level, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether some pair below node ``i`` of ``a`` and node ``j`` of ``b`` can reach the threshold."""
    fits = (100 * a.large[i] >= percent * b.small[j]) & (100 * b.large[j] >= percent * a.small[i])
    need = -(-percent * (a.small[i] + b.small[j]) // (100 + percent))
    most = shared_bits(a.bits[i], b.bits[j]) + np.minimum(a.hidden[i], b.hidden[j])
    return fits & (most >= need)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """The exact test: 100 * intersection >= percent * union."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate((a, b))
    both.sort()
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * common >= percent * (len(a) + len(b) - common)


def dual_pairs(left: Tree, right: Tree | None, percent: int) -> np.ndarray:
    """Pairs of sets that the bitmaps leave possible: inside ``left`` (each pair once), or between ``left`` and ``right``."""
    own = right is None
    right = left if own else right
    top = max(len(left.levels), len(right.levels)) - 1

    def at(tree: Tree, level: int) -> int:
        return min(level, len(tree.levels) - 1)

    pairs = np.zeros((1, 2), np.int64)
    for level in range(top, -1, -1):
        a, b = left.levels[at(left, level)], right.levels[at(right, level)]
        if level < top:
            pairs = _children(pairs, len(a.small), at(left, level) < at(left, level + 1), len(b.small), at(right, level) < at(right, level + 1))
        if own:
            pairs = pairs[pairs[:, 0] <= pairs[:, 1]] if level else pairs[pairs[:, 0] < pairs[:, 1]]
        keep = [possible(a, part[:, 0], b, part[:, 1], percent) for part in np.array_split(pairs, len(pairs) // 16384 + 1)]
        pairs = pairs[np.concatenate(keep)]
    return pairs


def dual_links(pairs: np.ndarray, left: list[np.ndarray], right: list[np.ndarray], groups: Groups, shift: int, percent: int) -> list[tuple[int, int]]:
    """Links among ``pairs`` that join groups not yet joined, tested on the sets themselves.

    ``shift`` is the number of the first set of ``right`` in ``groups``. Together with the groups given, the links found
    connect all pairs that reach the threshold.
    """
    found = []
    for i, j in pairs.tolist():
        if groups.find(i) != groups.find(j + shift) and linked(left[i], right[j], percent):
            groups.join(i, j + shift)
            found.append((i, j))
    return found


def lowest_labels(n: int, pairs: np.ndarray) -> np.ndarray:
    """For each of ``n`` members the lowest member that pairs connect it with."""
    labels = np.arange(n)
    while len(pairs):
        before = labels.copy()
        low = np.minimum(labels[pairs[:, 0]], labels[pairs[:, 1]])
        np.minimum.at(labels, pairs[:, 0], low)
        np.minimum.at(labels, pairs[:, 1], low)
        labels = labels[labels]
        if (labels == before).all():
            break
    return labels


def _children(pairs: np.ndarray, n_left: int, down_left: bool, n_right: int, down_right: bool) -> np.ndarray:
    left = pairs[:, :1] * FANOUT + np.arange(FANOUT) if down_left else pairs[:, :1]
    right = pairs[:, 1:] * FANOUT + np.arange(FANOUT) if down_right else pairs[:, 1:]
    i = np.repeat(left, right.shape[1], axis=1).ravel()
    j = np.tile(right, (1, left.shape[1])).ravel()
    inside = (i < n_left) & (j < n_right)
    return np.stack([i[inside], j[inside]], axis=1)
