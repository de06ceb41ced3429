"""Similarity scores (0-100) from the longest common subsequence of two strings.

``score = round_half_even(200 * lcs / (len(a) + len(b)))``; two empty strings score 100.
Spark has no longest-common-subsequence expression, so the score is an Arrow UDF. It is only ever applied to
pairs that survived the joins and filters of :mod:`tabaudit.operators.fuzzy_join`.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabaudit.functions.subsequence import Strings, scores
from tabaudit.functions.text import sort_tokens


class Pattern:
    """A string prepared for many comparisons: bit-parallel longest common subsequence (Hyyro 2004).

    One big-integer step per character of the other string.
    """

    def __init__(self, text: str):
        self.text = text
        self.full = (1 << len(text)) - 1
        self.where: dict[str, int] = {}
        for i, char in enumerate(text):
            self.where[char] = self.where.get(char, 0) | (1 << i)

    def lcs_length(self, other: str) -> int:
        open_bits, full, where = self.full, self.full, self.where
        for char in other:
            if char in where:
                hits = open_bits & where[char]
                open_bits = ((open_bits + hits) | (open_bits - hits)) & full
        return len(self.text) - open_bits.bit_count()

    def ratio(self, other: str) -> int:
        total = len(self.text) + len(other)
        return 100 if total == 0 else round(200 * self.lcs_length(other) / total)


def lcs_length(a: str, b: str) -> int:
    if a == b:
        return len(a)
    return Pattern(a).lcs_length(b) if len(a) < len(b) else Pattern(b).lcs_length(a)


def ratio(a: str, b: str) -> int:
    total = len(a) + len(b)
    return 100 if total == 0 else round(200 * lcs_length(a, b) / total)


def row_set_similarity(rows_a: Sequence[str], rows_b: Sequence[str]) -> float:
    """Mean best match of A in B and of B in A, averaged."""
    return float(row_set_similarities([rows_a], [rows_b])[0])


def row_set_similarities(sets_a: Sequence[Sequence[str]], sets_b: Sequence[Sequence[str]]) -> np.ndarray:
    """The same for many pairs of sets; all their row pairs are scored together. An empty set is similar to nothing."""
    n_a, n_b = (np.fromiter(map(len, sets), np.int64, len(sets)) for sets in (sets_a, sets_b))
    numbers: dict[str, int] = {}
    at_a, at_b = ([numbers.setdefault(row, len(numbers)) for rows in sets for row in rows] for sets in (sets_a, sets_b))
    block = np.repeat(np.arange(len(n_a)), n_a * n_b)
    inside = np.arange(len(block)) - np.repeat(np.cumsum(n_a * n_b) - n_a * n_b, n_a * n_b)
    line, column = (np.cumsum(n_a) - n_a)[block] + inside // np.maximum(n_b[block], 1), (np.cumsum(n_b) - n_b)[block] + inside % np.maximum(n_b[block], 1)
    strings, pairs = Strings(list(numbers)), np.stack([np.asarray(at_a, np.int64)[line], np.asarray(at_b, np.int64)[column]])
    different, back = np.unique(pairs, axis=1, return_inverse=True)
    score = scores(strings, different[0], strings, different[1])[back.ravel()].astype(float) if len(block) else np.zeros(0)
    out = np.zeros(len(n_a))
    for ends, count in ((line, n_a), (column, n_b)):
        best = np.zeros(int(count.sum()))
        np.maximum.at(best, ends, score)
        sums = np.bincount(np.repeat(np.arange(len(count)), count), weights=best, minlength=len(count))
        out += sums / np.maximum(count, 1) / 2
    return np.where((n_a > 0) & (n_b > 0), out, 0.0)


@F.pandas_udf(T.IntegerType())
def _ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    known = (a.notna() & b.notna()).to_numpy()
    out = np.full(len(a), None, object)
    pairs = np.arange(known.sum())
    out[known] = scores(Strings(a[known].tolist()), pairs, Strings(b[known].tolist()), pairs)
    return pd.Series(out, dtype="Int32")


@F.pandas_udf(T.DoubleType())
def row_set_similarity_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(row_set_similarities(a.tolist(), b.tolist()), dtype="float64")


def indel_ratio(a: Column, b: Column) -> Column:
    return _ratio_udf(a, b)


def token_sort_ratio(a: Column, b: Column) -> Column:
    return _ratio_udf(sort_tokens(a), sort_tokens(b))


def best_name(name: Column, targets: Sequence[str]) -> Column:
    """Best target name and score for a column name, first name in order on ties.

    ``targets`` is configuration (the known column names), so it travels with the function.
    """
    ordered = sorted(set(targets))

    @F.pandas_udf("match string, score int")
    def pick(names: pd.Series) -> pd.DataFrame:
        found = []
        for text in names:
            best, best_score = None, 0
            for target in ordered:
                score = ratio(text, target)
                if score > best_score:
                    best, best_score = target, score
            found.append((best, best_score))
        return pd.DataFrame(found, columns=["match", "score"])

    return pick(name)
