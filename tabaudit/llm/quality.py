"""Quality classifier from positive and unlabelled texts: non-negative unbiased risk, minimised by Newton steps.

Trusted positives are documents labelled good outside the held-out fold; the unlabelled text is that of all documents, the
positives among them. With the logistic loss the unbiased risk of a score ``g`` is ``-prior * mean_P(g) + mean_U(log(1 + e^g))``:
it needs no negative examples and is convex. The risk of the negatives inside it, ``mean_U - prior * mean_P`` of
``log(1 + e^g)``, cannot truly be negative; a step that would make it so is halved until it isn't.

The prior, the share of good documents, is estimated from positives and unlabelled text alone; labels of poor documents are
never read. A first fit with an even prior and half of the positives puts the documents in an order; the other half are positives
that it hasn't seen. Above any score lies at least the share of the unlabelled text that the share of positives above it, times
the prior, accounts for, so the ratio of the two shares bounds the prior from above, and where only good documents are left it
meets it. The smallest upper confidence bound of the ratio counts, as the smallest ratio itself is too small by chance; with few
positives it errs towards accepting. The half that was seen is left out of both counts and added to the good ones afterwards.
The second fit has all positives.

Each Newton step is one pass over the features of *all* documents: tasks return sums of fixed size. Nothing is sampled.
Labels, language, source and id are never inputs of a score. Null text counts as empty and is scored like any other; a
null id belongs to no label and isn't held out. Of contradicting labels of one id the lowest counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabaudit.llm.common import require, row_slices, text_buffers, text_of
from tabaudit.llm.places import PLACE, kept, located
from tabaudit.llm.shingles import _word_hashes
from tabaudit.session import written

FOLDS, HELD_OUT = 3, 1
#: Strength of the ridge, and what is added to it divided by the number of positives: few examples allow little.
RIDGE, RIDGE_EXTRA = 1e-3, 10.0
STEPS = 25
#: The scores of the first fit are counted in so many bins of equal width, from ``-BIN_REACH`` to ``BIN_REACH``.
PRIOR_BINS, BIN_REACH = 4096, 16.0
#: Chance that a bound on a share fails at any score (one side, Dvoretzky-Kiefer-Wolfowitz), and the smallest and largest prior.
PRIOR_FAILS, PRIOR_RANGE = 0.1, (0.01, 0.99)

# Byte classes: lower case, upper case, digits, white space but line ends, line ends, then the marks by kind, then the rest.
_KINDS = np.full(256, 12, np.int64)
_KINDS[97:123], _KINDS[65:91], _KINDS[48:58], _KINDS[[32, 9, 11, 12, 13]], _KINDS[10] = 0, 1, 2, 3, 4
for _kind, _marks in enumerate((b".,;:", b"!?", b"|", b"#*$%&", b"<>{}[]()/\\=_~^`@+", b"'\"-"), start=5):
    _KINDS[list(_marks)] = _kind
_KINDS[128:] = 11
N_KINDS = 13
_SHARES = 7
WIDTH = 1 + 2 * (N_KINDS + _SHARES) + 4


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def features(column: pa.Array) -> np.ndarray:
    """A row of ``WIDTH`` numbers for each text."""
    data, at = text_buffers(column)
    out = [_sliced(data[at[a] : at[b]], at[a : b + 1] - at[a]) for a, b in row_slices(at)]
    return np.concatenate(out) if out else np.zeros((0, WIDTH), np.float32)


def _sliced(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    n, size = len(at) - 1, np.diff(at)
    doc = np.repeat(np.arange(n), size)
    kinds = np.bincount(doc * N_KINDS + _KINDS[data], minlength=n * N_KINDS).reshape(n, N_KINDS).astype(float)
    with np.errstate(over="ignore"):
        words, starts = _word_hashes(data, at)
        runs = words * np.uint64(3) + np.roll(words, -1) * np.uint64(0x9E3779B97F4A7C15) + np.roll(words, -2) * np.uint64(0xA0761D6478BD642F)
    home = np.searchsorted(at, starts, side="right") - 1
    n_words = np.bincount(home, minlength=n).astype(float)
    whole = np.flatnonzero(home[2:] == home[:-2])

    def distinct(values: np.ndarray, owners: np.ndarray) -> np.ndarray:
        if not len(values):
            return np.zeros(n)
        order = np.lexsort((values, owners))
        v, o = values[order], owners[order]
        return np.bincount(o[np.concatenate(([True], (v[1:] != v[:-1]) | (o[1:] != o[:-1])))], minlength=n).astype(float)

    same_next = np.flatnonzero((home[1:] == home[:-1]) & (words[1:] == words[:-1]))
    n_runs = np.bincount(home[whole], minlength=n).astype(float)
    upper_start = np.bincount(home, weights=(data[starts] >= 65) & (data[starts] <= 90), minlength=n) if len(starts) else np.zeros(n)
    solid = size - kinds[:, 3] - kinds[:, 4]
    shares = np.stack(
        [
            _share(distinct(words, home), n_words), _share(distinct(runs[whole], home[whole]), n_runs), _share(np.bincount(home[same_next], minlength=n), n_words),
            _share(upper_start, n_words), np.minimum(_share(solid, n_words) / 20, 1), np.minimum(_share(n_words, kinds[:, 4] + 1) / 100, 1), _share(kinds[:, 1], kinds[:, 0] + kinds[:, 1]),
        ], axis=1,
    )
    shares = np.concatenate((kinds / np.maximum(size, 1)[:, None], shares), axis=1)
    length = np.log1p(n_words)
    rest = np.stack([length / 10, (length / 10) ** 2, (n_words < 5).astype(float), (n_words < 50).astype(float)], axis=1)
    return np.concatenate((np.ones((n, 1)), shares, np.sqrt(shares), rest), axis=1).astype(np.float32)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def with_features(docs: DataFrame, along: list[str] | None = None) -> DataFrame:
    """``doc_id, x``: the features of every document, packed as four-byte numbers. Columns named in ``along`` come along."""
    names = ["doc_id", *(along or [])]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = features(batch.column("text"))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array([row.tobytes() for row in rows], pa.binary())], [*names, "x"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(along or []), text_of().alias("text"))
    return rows.mapInArrow(make, T.StructType([*rows.drop("text").schema.fields, T.StructField("x", T.BinaryType())]))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(len(column), WIDTH).astype(float)


def _sums(examples: DataFrame, of, size: int) -> np.ndarray:
    """The sum over all examples of what ``of(x, positive)`` returns for a batch: added in tasks, then in lanes."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += of(_matrix(batch.column("x")), batch.column("positive").to_numpy(zero_copy_only=False).astype(bool))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    def total(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"sums": [np.sum([np.frombuffer(body) for body in group["sums"]], axis=0).tobytes()]})

    lanes = examples.select("x", "positive").mapInArrow(part, "sums binary").withColumn("lane", F.pmod(F.xxhash64("sums"), F.lit(16)))
    rows = lanes.groupBy("lane").applyInPandas(lambda group: total(group), "sums binary").collect()
    # The order of addition is fixed, so that reruns agree.
    return np.sum(sorted((np.frombuffer(row["sums"]) for row in rows), key=lambda v: v.tobytes()), axis=0) if rows else np.zeros(size)


class _Risk:
    """The non-negative unbiased risk over ``examples(x, positive)``, every one of which is unlabelled text, too."""

    def __init__(self, examples: DataFrame) -> None:
        d = WIDTH
        moments = _sums(examples, lambda x, p: np.concatenate(([p.sum(), len(p)], x.sum(0), (x * x).sum(0), x[p].sum(0))), 2 + 3 * d)
        self.examples, (self.n_positive, self.n) = examples, moments[:2]
        mean = moments[2 : 2 + d] / max(self.n, 1)
        scale = np.sqrt(np.maximum(moments[2 + d : 2 + 2 * d] / max(self.n, 1) - mean**2, 0))
        mean[0], scale[0] = 0.0, 1.0
        self.mean, self.scale = mean, np.where(scale > 1e-6, scale, np.inf)
        self.positive_mean = (moments[2 + 2 * d :] / max(self.n_positive, 1) - mean) / self.scale
        self.strength = RIDGE + RIDGE_EXTRA / max(self.n_positive, 1)

    def at(self, w: np.ndarray, prior: float) -> tuple[float, float, np.ndarray, np.ndarray]:
        """Risk, risk of the negatives in it, gradient and Hessian at ``w``: one pass over all documents."""
        mean, scale, d = self.mean, self.scale, WIDTH

        def of(x: np.ndarray, p: np.ndarray) -> np.ndarray:
            z = (x - mean) / scale
            g = z @ w
            soft, chance = np.logaddexp(0, g), 1 / (1 + np.exp(-np.clip(g, -50, 50)))
            hessian = (z * (chance * (1 - chance))[:, None]).T @ z
            return np.concatenate(([soft.sum(), soft[p].sum()], z.T @ chance, hessian.ravel()))

        sums = _sums(self.examples, of, 2 + d + d * d)
        unlabelled, positive = sums[0] / self.n, sums[1] / self.n_positive
        ridge = self.strength * np.concatenate(([0.0], w[1:]))
        risk = -prior * self.positive_mean @ w + unlabelled + 0.5 * w @ ridge
        gradient = -prior * self.positive_mean + sums[2 : 2 + d] / self.n + ridge
        hessian = sums[2 + d :].reshape(d, d) / self.n + self.strength * np.eye(d)
        return risk, unlabelled - prior * positive, gradient, hessian

    def least(self, prior: float) -> np.ndarray:
        """The standardised weights of least risk, by Newton steps from zero, where the risk of the negatives isn't negative."""
        w = np.zeros(WIDTH)
        risk, negative, gradient, hessian = self.at(w, prior)
        for _ in range(STEPS):
            step = np.linalg.solve(hessian, gradient)
            for _ in range(12):
                moved = self.at(w - step, prior)
                if moved[1] >= 0 and moved[0] <= risk + 1e-12:
                    break
                step = step / 2
            else:
                break
            w, gain = w - step, risk - moved[0]
            risk, negative, gradient, hessian = moved
            if gain < 1e-5:
                break
        return w

    def plain(self, w: np.ndarray) -> np.ndarray:
        """Weights for features as they are."""
        w = w / self.scale
        w[0] -= float(np.where(np.isfinite(self.scale), self.mean, 0) @ w)
        return w


def prior_from_counts(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of good ones in unlabelled text, from counts of positives and of unlabelled text by score, lowest score first."""
    above = [np.cumsum(counts[::-1]) / max(counts.sum(), 1) for counts in (positive, unlabelled)]
    seen = above[0] > 0
    share, whole = above[0][seen], above[1][seen]
    if not len(share) or not unlabelled.sum():
        return 0.5
    noise = sum(np.sqrt(np.log(1 / PRIOR_FAILS) / (2 * counts.sum())) for counts in (positive, unlabelled))
    return float(np.clip(np.min((whole + noise) / share), *PRIOR_RANGE))


def class_prior(examples: DataFrame, weights: np.ndarray) -> float:
    """The estimated share of good documents, from the scores of ``examples(x, positive, seen)``; ``weights`` were fitted to the seen.

    At most ``PRIOR_BINS`` counts come back.
    """

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((3, PRIOR_BINS), np.int64)
        for batch in batches:
            if batch.num_rows:
                place = np.clip((_matrix(batch.column("x")) @ weights + BIN_REACH) * (PRIOR_BINS / (2 * BIN_REACH)), 0, PRIOR_BINS - 1).astype(int)
                positive, seen = (batch.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("positive", "seen"))
                counts += [np.bincount(place[rows], minlength=PRIOR_BINS) for rows in (positive & ~seen, ~seen, seen)]
        used = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), *[pa.array(c[used]) for c in counts]], ["bin", "positive", "unlabelled", "seen"])

    names = ["positive", "unlabelled", "seen"]
    counted = examples.select("x", "positive", "seen").mapInArrow(bins, "bin int, positive long, unlabelled long, seen long")
    counts = np.zeros((3, PRIOR_BINS), np.int64)
    for row in counted.groupBy("bin").agg(*[F.sum(c).alias(c) for c in names]).collect():
        counts[:, row["bin"]] = [row[c] for c in names]
    rest, seen = counts[1].sum(), counts[2].sum()
    return float(np.clip((prior_from_counts(*counts[:2]) * rest + seen) / max(rest + seen, 1), *PRIOR_RANGE))


def fit(examples: DataFrame) -> np.ndarray:
    """Weights that minimise the non-negative unbiased risk over ``examples(x, positive, seen)``; ``seen`` marks half of the positives."""
    whole = _Risk(examples.select("x", "positive"))
    if not whole.n_positive:
        return np.zeros(WIDTH)
    half = _Risk(examples.select("x", F.col("seen").alias("positive")))
    start = half.least(0.5) if half.n_positive else np.zeros(WIDTH)
    return whole.plain(whole.least(class_prior(examples, half.plain(start))))


def scored(docs: DataFrame, labels: DataFrame, along: list[str] | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row for each row of ``docs``. Columns named in ``along`` come along."""
    known = require(labels, "doc_id", "quality").where(~held_out(F.col("doc_id"))).where("doc_id IS NOT NULL AND quality IS NOT NULL")
    known = known.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.min("quality").alias("quality"))
    made = with_features(docs, along).join(known, F.col("doc_id") == F.col("label_id"), "left")
    positive = F.coalesce(F.col("quality") == 1, F.lit(False))
    seen = F.coalesce(positive & (F.xxhash64("doc_id") % 2 == 0), F.lit(False))
    rows = written(made.select("doc_id", *(along or []), "x", positive.alias("positive"), seen.alias("seen")))
    weights = fit(rows)

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        g = np.frombuffer(b"".join(x), np.float32).reshape(len(x), WIDTH).astype(float) @ weights
        return pd.Series(1 / (1 + np.exp(-np.clip(g, -50, 50))))

    found = rows.select("doc_id", *(along or []), held_out(F.col("doc_id")).alias("held_out"), score("x").alias("score"))
    return found.withColumn("predicted", F.when(F.col("score") >= 0.5, F.lit(1)).otherwise(F.lit(0)))


def without_poor(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns; each is judged by its own text and filtered where it is."""
    columns, rows = docs.columns, located(docs)
    return kept(rows, scored(rows, labels, PLACE).where("predicted = 1")).select(*[F.col(f"`{c}`") for c in columns])
