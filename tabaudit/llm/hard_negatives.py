"""Hard negatives by segment summary filtering.

A vector is cut into 1, 2, 4, ... segments of equal length; each segment is stored as its mean and its deviation (root of the
mean squared distance from the mean). The inner product of two segments of ``d`` numbers differs from ``d`` times the product
of their means by ``d`` times the product of their deviations at most, so a few numbers bound a score from both sides.
Anchors are compared with rows level by level: pairs whose bounds miss every score that is wanted are dropped, the
rest go on to finer segments, and what is left is scored exactly in whole numbers.

1. All rows are stored once with their segment summaries. Anchors are numbered and taken in blocks of bounded size.
2. For each block, a first look at some rows of the store finds scores that the wanted ones must reach; it decides nothing else.
   Then every row meets the block: rows of the anchor's label give its positives.
3. In the same way every row of another label whose score lies in the range of a positive may be one of its negatives.
   A task keeps the best rows for each anchor and positive that it has met, and raises what the next ones must reach.

Anchors against all rows is quadratic by contract; the store is read twice for each block of anchors, and only the best rows of
a task are exchanged. Higher scores come first, then the smaller ``vec_id`` (null last), then the row stored first. Rows
without label or vector take no part. Repeated rows are rows of their own. Vectors of unequal length are filled up with zeros.
Components are limited to ``LIMIT`` on either side of zero, so scores fit into 64 bits. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabaudit.operators.ranking import numbered
from tabaudit.session import written

LIMIT = 1 << 25
#: Segments of a vector on each level.
LEVELS = (1, 4, 16, 32)
#: Anchors that travel to every task at a time: 16 MB with 64 numbers each.
ANCHORS = 1 << 14
#: Rows of the first look.
FIRST_ROWS = 1 << 14
#: Anchors and rows that are compared at once.
TILE_ANCHORS, TILE_ROWS = 512, 1024
#: Pairs whose numbers are laid side by side at once: 16 MB with 64 of them.
SLICE_PAIRS = 1 << 14
#: Pairs that a task holds before it keeps the best ones only.
HELD_PAIRS = 1 << 18
NO_ID = np.iinfo(np.int64).max
LOWEST, HIGHEST = -(1 << 62), 1 << 62


def finite(vector: str) -> Column:
    """Whether a vector is there and has no null, infinite or undefined component."""
    return F.col(vector).isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


@dataclass
class Vectors:
    """Rows of the store: whole numbers, and means and deviations by level, scaled so that a bound is a plain product."""

    ids: np.ndarray
    nos: np.ndarray
    labels: np.ndarray
    numbers: np.ndarray
    means: list[np.ndarray] = field(default_factory=list)
    deviations: list[np.ndarray] = field(default_factory=list)

    def at(self, rows) -> Vectors:
        return Vectors(self.ids[rows], self.nos[rows], self.labels[rows], self.numbers[rows], [m[rows] for m in self.means], [d[rows] for d in self.deviations])


def width_of(size: int) -> int:
    """Numbers of a stored vector: a multiple of the segments on the finest level."""
    return max(1, -(-size // LEVELS[-1])) * LEVELS[-1]


def summaries(numbers: np.ndarray) -> np.ndarray:
    """For each row the means and then the deviations of all levels, times the root of the segment's length."""
    means, deviations = [], []
    for n in LEVELS:
        segments = numbers.reshape(len(numbers), n, -1).astype(float)
        mean, root = segments.mean(axis=2), math.sqrt(segments.shape[2])
        means.append(mean * root)
        deviations.append(np.sqrt(((segments - mean[:, :, None]) ** 2).mean(axis=2)) * root)
    return np.concatenate(means + deviations, axis=1)


def _unpacked(batch: pa.RecordBatch, width: int) -> Vectors:
    def numbers(name: str, kind, size: int) -> np.ndarray:
        return np.frombuffer(b"".join(batch.column(name).to_pylist()), kind).reshape(batch.num_rows, size)

    flat, cuts = numbers("summary", np.float64, 2 * sum(LEVELS)), np.cumsum(LEVELS + LEVELS)[:-1]
    parts = np.split(flat, cuts, axis=1)
    ids = batch.column("vec_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
    return Vectors(ids, batch.column("row_no").to_numpy(), batch.column("label").to_numpy(), numbers("numbers", np.int32, width), parts[: len(LEVELS)], parts[len(LEVELS) :])


def stored(rows: DataFrame, anchor: Column) -> tuple[DataFrame, int]:
    """``vec_id, row_no, label, anchor, numbers, summary`` of the rows that take part, and the stored length of a vector."""
    valid = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), "vector")
    valid = valid.where("label IS NOT NULL AND vector IS NOT NULL").withColumn("vector", F.transform("vector", lambda x: F.greatest(F.least(x.cast("long"), F.lit(LIMIT)), F.lit(-LIMIT))))
    valid = written(valid.withColumn("row_no", F.monotonically_increasing_id()))
    width = width_of(valid.agg(F.max(F.size("vector"))).first()[0] or 0)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, n = batch.column("vector"), batch.num_rows
            at = column.offsets.to_numpy().astype(np.int64)
            sizes, numbers = np.diff(at), np.zeros((n, width), np.int32)
            rows = np.repeat(np.arange(n), sizes)
            numbers[rows, np.arange(at[0], at[-1]) - np.repeat(at[:-1], sizes)] = column.values.to_numpy()[at[0] : at[-1]]
            packed = [pa.array([row.tobytes() for row in table], pa.binary()) for table in (numbers, summaries(numbers))]
            names = ["vec_id", "row_no", "label", "anchor"]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + packed, [*names, "numbers", "summary"])

    return written(valid.select("vec_id", "row_no", "label", "anchor", "vector").mapInArrow(summarise, "vec_id long, row_no long, label long, anchor boolean, numbers binary, summary binary")), width


@dataclass
class Wanted:
    """What a block of anchors looks for: per anchor up to ``slots`` score ranges, each for its ``most`` best rows."""

    anchors: Vectors
    low: np.ndarray
    high: np.ndarray
    most: int
    same_label: bool


def _left(anchors: Vectors, rows: Vectors, low: np.ndarray, high: np.ndarray, pairs_wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (anchor, row) whose bounds meet a range of the anchor, level by level."""
    a, b = np.nonzero(pairs_wanted & _meets(anchors.means[0] @ rows.means[0].T, anchors.deviations[0] @ rows.deviations[0].T, low[:, None, :], high[:, None, :]))
    for level in range(1, len(LEVELS)):
        if not len(a):
            break
        if len(a) * 8 > len(anchors.ids) * len(rows.ids):  # many are left: products of whole tables
            middle, spread = (anchors.means[level] @ rows.means[level].T)[a, b], (anchors.deviations[level] @ rows.deviations[level].T)[a, b]
        else:
            middle = _products(anchors.means[level], rows.means[level], a, b)
            spread = _products(anchors.deviations[level], rows.deviations[level], a, b)
        alive = _meets(middle, spread, low[a], high[a])
        a, b = a[alive], b[alive]
    return a, b


def _products(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows ``a`` of one table with the rows ``b`` of another, pair by pair, some pairs at a time."""
    out = np.zeros(len(a), left.dtype)
    for start in range(0, len(a), SLICE_PAIRS):
        part = slice(start, start + SLICE_PAIRS)
        np.einsum("ij,ij->i", left[a[part]], right[b[part]], out=out[part])
    return out


def _meets(middle: np.ndarray, spread: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Whether ``middle`` plus or minus ``spread`` meets one of the ranges on the last axis; a hair is added for rounding."""
    spread = spread + 1e-9 * (np.abs(middle) + spread) + 1e-3
    top, bottom = middle + spread, middle - spread
    out = np.zeros(middle.shape, bool)
    for slot in range(low.shape[-1]):
        out |= (top >= low[..., slot]) & (bottom <= high[..., slot])
    return out


class Best:
    """The best rows of each anchor and range that a task has met, and what further rows must reach."""

    def __init__(self, wanted: Wanted):
        self.wanted, self.low = wanted, wanted.low.copy()
        self.parts: list[np.ndarray] = []
        self.pending = 0

    def meet(self, rows: Vectors) -> None:
        w = self.wanted
        for start in range(0, len(w.anchors.ids), TILE_ANCHORS):
            tile = np.arange(start, min(start + TILE_ANCHORS, len(w.anchors.ids)))
            anchors, low, high = w.anchors.at(tile), self.low[tile], w.high[tile]
            same = anchors.labels[:, None] == rows.labels
            pairs = same & (anchors.nos[:, None] != rows.nos) if w.same_label else ~same
            a, b = _left(anchors, rows, low, high, pairs)
            if not len(a):
                continue
            score = _products(anchors.numbers.astype(np.int64), rows.numbers.astype(np.int64), a, b)
            for slot in range(low.shape[1]):
                hit = (score >= low[a, slot]) & (score <= high[a, slot])
                if hit.any():
                    found = np.stack([(start + a[hit]) * low.shape[1] + slot, score[hit], rows.ids[b[hit]], rows.nos[b[hit]]])
                    self.parts.append(found)
                    self.pending += found.shape[1]
            if self.pending > HELD_PAIRS:
                self.settle()
        self.settle()

    def settle(self) -> None:
        """Keep the ``most`` best of each range; a full range lets only better rows in."""
        if not self.parts:
            return
        all_of = np.concatenate(self.parts, axis=1)
        order = np.lexsort((all_of[3], all_of[2], -all_of[1], all_of[0]))
        all_of = all_of[:, order]
        first = np.flatnonzero(np.concatenate(([True], all_of[0][1:] != all_of[0][:-1])))
        place = np.arange(all_of.shape[1]) - np.repeat(first, np.diff(np.append(first, all_of.shape[1])))
        kept = all_of[:, place < self.wanted.most]
        last = all_of[:, place == self.wanted.most - 1]
        flat = self.low.reshape(-1)
        flat[last[0]] = np.maximum(flat[last[0]], last[1])
        self.parts, self.pending = [kept], 0


def _met(store: DataFrame, wanted: Wanted, width: int) -> DataFrame:
    """``place, score, order_id, row_no``: the best rows that each task met, for each anchor and range (``place``)."""
    a = wanted.anchors
    table = ([a.ids, a.nos, a.labels, a.numbers, a.means, a.deviations], [wanted.low, wanted.high, wanted.most, wanted.same_label])
    shared = store.sparkSession.sparkContext.broadcast(table)  # plain arrays: workers have no copy of the package

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(Wanted(Vectors(*shared.value[0]), *shared.value[1]))
        for batch in batches:
            for start in range(0, batch.num_rows, TILE_ROWS):
                best.meet(_unpacked(batch.slice(start, TILE_ROWS), width))
        for part in best.parts:
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in part], ["place", "score", "order_id", "row_no"])

    columns = store.select("vec_id", "row_no", "label", "numbers", "summary")
    return columns.mapInArrow(search, "place long, score long, order_id long, row_no long")


def _best(found: DataFrame, most: int) -> DataFrame:
    """The ``most`` best of each place with ``rank`` from 1; the limit works before the exchange as well."""
    order = Window.partitionBy("place").orderBy(F.col("score").desc(), "order_id", "row_no")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _primed(store: DataFrame, wanted: Wanted, width: int, rows: int) -> Wanted:
    """Raise what must be reached to what some rows of the store reach already; no result is lost by it."""
    share = max(1, -(-rows // FIRST_ROWS))
    some = store.where(F.pmod(F.xxhash64("row_no"), F.lit(share)) == 0) if share > 1 else None
    if some is None:
        return wanted  # the search itself would be the first look
    reached = _best(_met(some, wanted, width), wanted.most).where(F.col("rank") == wanted.most).select("place", "score").collect()  # a line for each range of a block
    low = wanted.low.copy().reshape(-1)
    for row in reached:
        low[row["place"]] = max(low[row["place"]], row["score"])
    return Wanted(wanted.anchors, low.reshape(wanted.low.shape), wanted.high, wanted.most, wanted.same_label)


def _ceil_div(a: np.ndarray, b: int) -> np.ndarray:
    return -(-a // b)


def mined(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, block: int = ANCHORS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows(vec_id, label, vector)`` holds vectors of whole numbers, ``anchor`` tells the anchors. An anchor's positives are
    its best other rows of the same label. For each of them the best rows of other labels are returned whose score lies between
    ``low`` and ``high`` percent of the positive's.
    """
    store, width = stored(rows, anchor)
    n_rows, spark = store.count(), rows.sparkSession
    anchors = written(numbered(store.where("anchor").drop("anchor"), "a_no", "vec_id", "row_no"))
    n_anchors, parts = anchors.count(), []
    for start in range(0, n_anchors, block):
        taken = anchors.where(F.col("a_no").between(start, start + block - 1)).orderBy("a_no").toArrow().combine_chunks().to_batches()[0]  # bounded by ``block``
        here = _unpacked(taken, width)
        size = (len(here.ids), 1)
        wanted = _primed(store, Wanted(here, np.full(size, LOWEST), np.full(size, HIGHEST), positives, True), width, n_rows)
        close = written(_best(_met(store, wanted, width), positives))
        scores = np.full((len(here.ids), positives), LOWEST, np.int64)
        for row in close.select("place", "rank", "score").collect():  # ``positives`` lines for each anchor of the block
            scores[row["place"], row["rank"] - 1] = row["score"]
        there = scores != LOWEST
        bottom = np.where(there, _ceil_div(np.where(there, scores, 0) * low, 100), HIGHEST)
        top = np.where(there, np.where(there, scores, 0) * high // 100, LOWEST)
        wanted = _primed(store, Wanted(here, bottom, top, negatives, False), width, n_rows)
        hard = _best(_met(store, wanted, width), negatives)
        names = close.select(
            (F.col("place") * positives + F.col("rank") - 1).alias("place"), (F.col("place") + start).alias("a_no"), F.col("order_id").alias("positive_id"), F.col("score").alias("positive_score")
        )
        found = hard.select("place", "rank", F.col("order_id").alias("negative_id"), F.col("score").alias("negative_score")).join(names, "place")
        parts.append(written(found.join(anchors.select("a_no", F.col("vec_id").alias("anchor_id")), "a_no").drop("place", "a_no")))
    if not parts:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)

    def named(column: str) -> Column:
        return F.when(F.col(column) != int(NO_ID), F.col(column)).alias(column)

    return found.select("anchor_id", named("positive_id"), F.col("rank").cast("int").alias("rank"), named("negative_id"), "positive_score", "negative_score")
