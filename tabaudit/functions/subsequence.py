"""Longest common subsequences of many pairs of strings at once.

The bit-vector recurrence of one pair (Hyyro 2004) takes a few word operations for each character of the longer string. Here a
batch of pairs takes the same step together: numpy arrays hold one row of 64-bit words for each pair, so no Python
code runs per pair. Additions carry from word to word; the other operations stay inside a word. Pairs whose shorter string
fills more words than ``MOST_WORDS`` are few and long, and take Python's big integers instead.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: Bits of a word that are used; the highest one takes the carry.
WORD = 63
MOST_WORDS = 8
#: Entries of the table of character positions that a batch may hold, 8 bytes each, and pairs of a batch.
TABLE_ENTRIES, BATCH_PAIRS = 1 << 18, 1 << 13
#: What is read of both strings before the rest is: two strings that share about half of their letters can't reach a score from ``HEAD_FROM`` by then.
HEAD, HEAD_FROM = 0.45, 75
FULL = np.uint64((1 << WORD) - 1)


class Strings:
    """Strings as one array of code points with offsets."""

    def __init__(self, texts: Sequence[str]):
        self.texts = texts
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))[:-1]
        self.met: tuple | None = None


def common_lengths(left: Strings, a: np.ndarray, right: Strings, b: np.ndarray, size_a: np.ndarray | None = None, size_b: np.ndarray | None = None) -> np.ndarray:
    """Length of the longest common subsequence of ``left[a[k]]`` and ``right[b[k]]`` for every ``k``, or of their first ``size_a[k]`` and ``size_b[k]`` letters."""
    out = np.zeros(len(a), np.int64)
    size_a, size_b = left.sizes[a] if size_a is None else size_a, right.sizes[b] if size_b is None else size_b
    short, long_ = np.minimum(size_a, size_b), np.maximum(size_a, size_b)
    words = -(-short // WORD)
    for k in np.flatnonzero(words > MOST_WORDS):
        out[k] = _one(left.texts[a[k]][: size_a[k]], right.texts[b[k]][: size_b[k]])
    letters, codes = _alphabet(left, right)
    sizes, starts = np.concatenate((left.sizes, right.sizes)), np.concatenate((left.starts, right.starts + len(left.codes)))
    swap = size_a > size_b
    pattern, other = np.where(swap, b + len(left.sizes), a), starts[np.where(swap, a, b + len(left.sizes))]  # the shorter one, and where the longer one begins
    for count in range(1, MOST_WORDS + 1):
        pairs = np.flatnonzero(words == count)
        pairs = pairs[np.argsort(pattern[pairs], kind="stable")]
        kinds, kind = np.unique(pattern[pairs], return_inverse=True)
        step = max(1, TABLE_ENTRIES // (count * letters))  # patterns of a table
        for first in range(0, len(kinds), step):
            some = kinds[first : first + step]
            table = _table(codes, starts[some], np.minimum(sizes[some], count * WORD), count, letters)
            begin, end = np.searchsorted(kind, [first, first + step])
            for start in range(begin, end, BATCH_PAIRS):
                part = np.arange(start, min(start + BATCH_PAIRS, end))
                part = part[np.argsort(-long_[pairs[part]], kind="stable")]
                at = pairs[part]
                out[at] = _batch(codes, table, (kind[part] - first) * letters, short[at], other[at], long_[at], count)
    return out


def _alphabet(left: Strings, right: Strings) -> tuple[int, np.ndarray]:
    """All characters, those of ``left`` first, numbered by what occurs on both sides; others are number 0, which nothing matches. It is kept for the next call."""
    if left.met is None or left.met[0] is not right:
        left.met = (right, *_numbered(left, right))
    return left.met[1:]


def _numbered(left: Strings, right: Strings) -> tuple[int, np.ndarray]:
    shared, codes = np.intersect1d(left.codes, right.codes), np.concatenate((left.codes, right.codes))
    if not len(shared):
        return 1, np.zeros(len(codes), np.int64)
    at = np.minimum(np.searchsorted(shared, codes), len(shared) - 1)
    return len(shared) + 1, np.where(shared[at] == codes, at + 1, 0)


def _table(codes: np.ndarray, first: np.ndarray, size: np.ndarray, words: int, letters: int) -> np.ndarray:
    """A line of each word, with an entry for every string and letter: the places of the letter in that word of the string."""
    rows = np.repeat(np.arange(len(first)), size)
    place = np.arange(len(rows)) - np.repeat(np.cumsum(size) - size, size)
    letter = codes[np.repeat(first, size) + place]
    table = np.zeros(words * len(first) * letters, np.uint64)
    known = letter > 0
    # Positions of a character are different powers of two, so adding them is setting their bits.
    np.add.at(table, ((place // WORD * len(first) + rows) * letters + letter)[known], np.uint64(1) << (place[known] % WORD).astype(np.uint64))
    return table.reshape(words, -1)


def _batch(codes: np.ndarray, table: np.ndarray, base: np.ndarray, short: np.ndarray, other: np.ndarray, long_: np.ndarray, words: int) -> np.ndarray:
    """One batch: the first ``short`` characters of the strings at ``base`` of the table against the others from ``other``, longest first."""
    open_bits = np.full((words, len(base)), FULL, np.uint64)
    alive = np.searchsorted(-long_, -np.arange(int(long_[0]) if len(base) else 0), side="left")  # pairs whose longer string reaches so far
    for step, some in enumerate(alive.tolist()):
        at = codes.take(other[:some] + step)
        at += base[:some]
        carry = None
        for word in range(words):
            bits = open_bits[word, :some]
            met = table[word].take(at)
            met &= bits
            total = bits + met
            if carry is not None:
                total += carry
            if word + 1 < words:
                carry = total >> np.uint64(WORD)
            bits ^= met
            bits |= total
            bits &= FULL
    last = short - np.arange(words)[:, None] * WORD
    mask = (np.uint64(1) << np.clip(last, 0, WORD).astype(np.uint64)) - np.uint64(1)
    return np.bitwise_count(~open_bits & mask).sum(axis=0, dtype=np.int64)


def _one(a: str, b: str) -> int:
    if len(a) > len(b):
        a, b = b, a
    where: dict[str, int] = {}
    for i, char in enumerate(a):
        where[char] = where.get(char, 0) | (1 << i)
    full = (1 << len(a)) - 1
    open_bits = full
    for char in b:
        if char in where:
            hits = open_bits & where[char]
            open_bits = ((open_bits + hits) | (open_bits - hits)) & full
    return len(a) - open_bits.bit_count()


def scores(left: Strings, a: np.ndarray, right: Strings, b: np.ndarray) -> np.ndarray:
    """Score of each pair, 0 to 100, halves to the even number; two empty strings score 100."""
    total = left.sizes[a] + right.sizes[b]
    return np.where(total == 0, 100, np.rint(200 * common_lengths(left, a, right, b) / np.maximum(total, 1))).astype(np.int64)


def scores_from(threshold: int, left: Strings, a: np.ndarray, right: Strings, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(k, score)`` of the pairs that reach the threshold.

    Most pairs are settled by the heads of both strings: of the letters behind a head no more can be common than there are. The
    heads end at the same distance from the ends, so no other cut of the shorter string promises more.
    """
    size_a, size_b = left.sizes[a], right.sizes[b]
    kept = np.arange(len(a))
    if threshold >= HEAD_FROM:
        rest = np.floor(np.minimum(size_a, size_b) * (1 - HEAD)).astype(np.int64)
        most = rest + common_lengths(left, a, right, b, size_a - rest, size_b - rest)
        kept = np.flatnonzero(400 * most >= (size_a + size_b) * (2 * threshold - 1))
    score = scores(left, a[kept], right, b[kept])
    return kept[score >= threshold], score[score >= threshold]
