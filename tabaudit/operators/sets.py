"""Pairs of small sets of rows whose matching rows promise a mean best match at the threshold.

Sets are ranked by group and dealt out in slabs; a task compares two slabs of the same groups. Rows are numbers there, and pairs of
sets never leave a task before what they share is known, so what is exchanged grows with the sets and not with their pairs.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabaudit.functions.subsequence import Strings
from tabaudit.operators.ranking import numbered
from tabaudit.operators.tiles import LETTERS, letter_bags
from tabaudit.session import written

#: Sets of a slab, matches of rows that are looked at together, and tasks at most.
SETS, MATCHES, PARTS = 2048, 1 << 21, 1 << 12
#: Pairs of sets whose rows are bounded at a time.
BOUNDED = 1 << 12


def _bags(rows: pd.DataFrame, number: np.ndarray, sets: int, places: int) -> np.ndarray:
    """Letter counts by set and place; none where a set has no such row."""
    out = np.zeros((sets, places, LETTERS), np.int32)
    own = rows["bag"].notna().to_numpy()
    if own.any():
        out[number[own], rows["place"].to_numpy(np.int64)[own]] = np.frombuffer(b"".join(rows["bag"][own]), np.int32).reshape(-1, LETTERS)
    return out


def _letter_bounds(bags_a: np.ndarray, bags_b: np.ndarray) -> np.ndarray:
    """The best score that the letters of two rows allow, for all rows of each pair of sets."""
    common = np.minimum(bags_a[:, :, None, :], bags_b[:, None, :, :]).sum(axis=-1)
    return np.rint(200 * common / np.maximum(bags_a.sum(axis=-1)[:, :, None] + bags_b.sum(axis=-1)[:, None, :], 1))


def _enough(best_a: np.ndarray, size_a: np.ndarray, best_b: np.ndarray, size_b: np.ndarray, threshold: int) -> np.ndarray:
    return best_a.sum(axis=1, dtype=float) / size_a + best_b.sum(axis=1, dtype=float) / size_b >= 2 * threshold - 1e-6


class _Sets:
    """Rows of a slab by set; ``groups`` and ``names`` by set number."""

    def __init__(self, rows: pd.DataFrame):
        ids = rows[["group_ord", "class"]].drop_duplicates().sort_values(["group_ord", "class"])
        self.groups, self.names = ids["group_ord"].to_numpy(), ids["class"].to_numpy()
        self.number = pd.MultiIndex.from_frame(ids).get_indexer(pd.MultiIndex.from_frame(rows[["group_ord", "class"]]))
        self.sizes = np.zeros(len(ids), np.int64)
        self.sizes[self.number] = rows["n"].to_numpy()


def _common_rows(number: np.ndarray, value: np.ndarray, sets: int) -> np.ndarray:
    """``value`` of the rows of each set in a line, -1 where there are fewer."""
    order = np.argsort(number, kind="stable")
    number, value = number[order], value[order]
    start = np.searchsorted(number, np.arange(sets))
    at = np.arange(len(number)) - start[number]
    out = np.full((sets, int(at.max()) + 1 if len(at) else 0), -1, np.int64)
    out[number, at] = value
    return out


def promising(left: pd.DataFrame, right: pd.DataFrame, threshold: int, inside: bool) -> pd.DataFrame:
    """``group_ord, a_class, b_class`` of two slabs: ``left(group_ord, class, n, place, rare, t, other, score)`` by match, ``right`` by row.

    A set pair has at least one match that isn't between two common rows. All its matches are known then; a row without one scores
    less than the threshold, and no more than its letters allow. The letters (``bag``) of a left row come with its match with itself.
    """
    a, b = _Sets(left), _Sets(right)
    places = 1 + int(max(left["place"].max(), right["place"].max()))
    bags_a, bags_b = _bags(left, a.number, len(a.names), places), _bags(right, b.number, len(b.names), places)
    texts, place_b = np.unique(right["t"].to_numpy(np.int64)), right["place"].to_numpy(np.int64)
    by_text = np.argsort(right["t"].to_numpy(np.int64), kind="stable")
    text_b = np.searchsorted(texts, right["t"].to_numpy(np.int64))
    known = np.isin(left["other"].to_numpy(np.int64), texts)
    number_a, left = a.number[known], left[known]
    other, score = np.searchsorted(texts, left["other"].to_numpy(np.int64)), left["score"].to_numpy(np.int64)
    place_a, rare_a, rare_b = left["place"].to_numpy(np.int64), left["rare"].to_numpy(bool), right["rare"].to_numpy(bool)
    order = np.argsort(number_a, kind="stable")
    low, high = (np.searchsorted(text_b[by_text], other, side=side)[order] for side in ("left", "right"))
    ends = np.append(np.flatnonzero(np.diff(number_a[order])) + 1, len(order))  # of sets
    work = np.concatenate(([0], np.cumsum(high - low)))
    # Matches of common rows, to be looked up for the pairs that other rows bring together.
    code = (number_a * places + place_a) * len(texts) + other
    sorted_code = np.argsort(code, kind="stable")
    commons = ~rare_a
    rows_a = np.unique(np.stack([number_a[commons], place_a[commons]], axis=1), axis=0)
    common_a = _common_rows(rows_a[:, 0], rows_a[:, 1], len(a.names))
    common_b = _common_rows(b.number[~rare_b], np.flatnonzero(~rare_b), len(b.names))
    found, begin = [], 0
    while begin < len(order):
        stop = ends[max(np.searchsorted(work[ends], work[begin] + MATCHES, side="right") - 1, np.searchsorted(ends, begin, side="right"))]
        count = (high - low)[begin:stop]
        k = np.repeat(np.arange(begin, stop), count)
        row_b = by_text[np.arange(len(k)) - np.repeat(np.cumsum(count) - count, count) + low[k]]
        match = order[k]
        begin = stop
        set_a, set_b = number_a[match], b.number[row_b]
        good = (rare_a[match] | rare_b[row_b]) & (set_a < set_b if inside else True)
        match, row_b, set_a, set_b = match[good], row_b[good], set_a[good], set_b[good]
        if not len(match):
            continue
        pairs, key = np.unique(set_a * len(b.names) + set_b, return_inverse=True)
        set_a, set_b = pairs // len(b.names), pairs % len(b.names)
        keys, at_a, at_b, value = [key], [place_a[match]], [place_b[row_b]], [score[match]]
        for i in range(common_a.shape[1]):
            for j in range(common_b.shape[1]):
                first, second = common_a[set_a, i], common_b[set_b, j]
                both = np.flatnonzero((first >= 0) & (second >= 0))
                wanted = (set_a[both] * places + first[both]) * len(texts) + text_b[second[both]]
                at = np.minimum(np.searchsorted(code, wanted, sorter=sorted_code), len(code) - 1)
                hit = code[sorted_code[at]] == wanted
                keys.append(both[hit]), at_a.append(first[both][hit]), at_b.append(place_b[second[both][hit]]), value.append(score[sorted_code[at[hit]]])
        key, value = np.concatenate(keys), np.concatenate(value)
        best_a, best_b = (np.zeros((len(pairs), places), np.float32) for _ in range(2))
        np.maximum.at(best_a, (key, np.concatenate(at_a)), value.astype(np.float32))
        np.maximum.at(best_b, (key, np.concatenate(at_b)), value.astype(np.float32))
        rows_of = np.arange(places)
        open_a, open_b = ((best == 0) & (rows_of < sizes[:, None]) for best, sizes in ((best_a, a.sizes[set_a]), (best_b, b.sizes[set_b])))
        kept = np.flatnonzero(_enough(best_a + open_a * (threshold - 1), a.sizes[set_a], best_b + open_b * (threshold - 1), b.sizes[set_b], threshold))
        for start in range(0, len(kept), BOUNDED):
            some = kept[start : start + BOUNDED]
            bounds = np.minimum(_letter_bounds(bags_a[set_a[some]], bags_b[set_b[some]]), threshold - 1)
            most_a, most_b = best_a[some] + open_a[some] * bounds.max(axis=2), best_b[some] + open_b[some] * bounds.max(axis=1)
            some = some[_enough(most_a, a.sizes[set_a[some]], most_b, b.sizes[set_b[some]], threshold)]
            found.append(pd.DataFrame({"group_ord": a.groups[set_a[some]], "a_class": a.names[set_a[some]], "b_class": b.names[set_b[some]]}))
    return pd.concat(found) if found else pd.DataFrame({"group_ord": [], "a_class": [], "b_class": []}, dtype="int64")


def close_sets(members: DataFrame, matches: DataFrame, threshold: int) -> DataFrame:
    """Pairs ``group_ord, a_class, b_class`` of sets of a group whose mean best match may reach the threshold.

    ``members(group_ord, class, n, place, t, rare, bag)`` has a line for each row of a set of ``n``; ``matches(t, other, score)`` holds the rows of a group
    that score the threshold, both ways and each with itself. Pairs that match in rows that aren't ``rare`` only are left out.
    """
    members = written(members)
    ranked = numbered(members.select("group_ord", "class").distinct(), "rank", "group_ord", "class")
    placed = written(members.join(ranked, ["group_ord", "class"]).withColumn("slab", F.floor(F.col("rank") / SETS)).drop("rank"))
    lines = placed.select("group_ord", "slab").distinct()
    cells = lines.withColumnRenamed("slab", "a_slab").join(lines.withColumnRenamed("slab", "b_slab"), "group_ord").where("a_slab <= b_slab")
    cells = written(cells.select("a_slab", "b_slab").distinct())
    names = ["group_ord", "class", "n", "place", "t", "rare", "bag"]

    def side(rows: DataFrame, slab: str, *more: str) -> DataFrame:
        # A fresh projection: both sides are the same table.
        return rows.withColumnRenamed("slab", slab).join(cells, slab).select(*[F.col(c).alias(c) for c in ("a_slab", "b_slab", *names, *more)])

    kind = ", ".join(f"{name} {members.schema[column].dataType.simpleString()}" for name, column in (("group_ord", "group_ord"), ("a_class", "class"), ("b_class", "class")))

    def meet(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"group_ord": [], "a_class": [], "b_class": []}, dtype="int64")
        return promising(left, right, threshold, key[0] == key[1])

    parts = max(1, min(PARTS, 2 * cells.count()))
    sides = side(placed.join(matches, "t").withColumn("bag", F.when(F.col("other") == F.col("t"), F.col("bag"))), "a_slab", "other", "score"), side(placed, "b_slab")
    met, other = (rows.repartition(parts, "a_slab", "b_slab").groupBy("a_slab", "b_slab") for rows in sides)
    return written(met.cogroup(other).applyInPandas(meet, kind))


def letters_of(text):
    """Letter counts of a text as bytes."""

    @F.pandas_udf("binary")
    def bag(texts: pd.Series) -> pd.Series:
        return pd.Series([row.tobytes() for row in letter_bags(Strings(texts.tolist()))], dtype=object)

    return bag(text)
