"""Sharding by a hypergeometric communication matrix: a uniform shuffle with exact shard sizes.

How many rows each partition sends to each shard is drawn first, as if all rows were dealt out blindly: a multivariate
hypergeometric draw, partition by partition. The matrix has a line for each partition, never for each row. Every partition
then permutes its rows and cuts them by its line of the matrix, the rows are exchanged, and each shard permutes what it
got, in lanes of bounded size whose exact counts give the slots.

All draws come from the seed and from the order of the rows in the input, so a rerun over the same files agrees. Nulls,
repeated rows and texts of any length are rows like all others: equal texts aren't kept together, since a group may be
larger than a shard.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabaudit.session import written

#: Rows that a shard permutes in one task, on average.
LANE_ROWS = 4096


def hypergeometric(total: int, good: int, n: int, random: np.random.Generator) -> int:
    """How many of ``n`` rows, drawn from ``total``, are among the ``good`` ones. Exact ratios, for totals of any size."""
    low, high = max(0, n - (total - good)), min(n, good)
    if low == high:
        return low
    mean = n * good / total
    spread = math.sqrt(mean * (1 - good / total) * (total - n) / max(1, total - 1))
    first, last = max(low, int(mean - 12 * spread) - 20), min(high, int(mean + 12 * spread) + 20)
    k = np.arange(first, last, dtype=float)
    steps = np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(total - good - n + k + 1)
    chances = np.concatenate(([0.0], np.cumsum(steps)))
    chances = np.cumsum(np.exp(chances - chances.max()))
    return first + int(np.searchsorted(chances, random.random() * chances[-1], side="right"))


def communication_matrix(counts: list[int], sizes: list[int], random: np.random.Generator) -> np.ndarray:
    """Rows that each partition (``counts``) sends to each shard (``sizes``); both margins are exact."""
    room, out = [int(s) for s in sizes], np.zeros((len(counts), len(sizes)), np.int64)
    for line, n in enumerate(counts):
        left, total = int(n), sum(room)
        for shard, free in enumerate(room):
            if not left:
                break
            taken = hypergeometric(total, free, left, random) if free else 0
            out[line, shard], left, total = taken, left - taken, total - free
            room[shard] -= taken
    return out


def sharded(docs: DataFrame, shards: int, seed: int = 11) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``: shard sizes differ by one at most, slots run from 0 without gaps.

    Columns of these two names that ``docs`` already has are replaced.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    rows = written(
        docs.select(*[F.col(f"`{c}`") for c in kept])
        .withColumn("_s_part", F.spark_partition_id())
        .withColumn("_s_at", F.monotonically_increasing_id())
    )
    counts = sorted(tuple(r) for r in rows.groupBy("_s_part").agg(F.count(F.lit(1))).collect())  # a line for each partition
    total = sum(n for _, n in counts)
    sizes = [total // shards + (shard < total % shards) for shard in range(shards)]
    matrix = communication_matrix([n for _, n in counts], sizes, np.random.default_rng(seed))
    lines = [(part, [int(x) for x in line]) for (part, _), line in zip(counts, np.cumsum(matrix, axis=1))]
    cuts = spark.createDataFrame(lines, "_s_cut_part int, _s_cuts array<long>")

    local = Window.partitionBy("_s_part").orderBy(F.xxhash64(F.lit(seed), "_s_part", "_s_at"), "_s_at")
    placed = rows.withColumn("_s_rank", F.row_number().over(local)).join(cuts, F.col("_s_part") == F.col("_s_cut_part"))
    placed = placed.withColumn("shard", F.size(F.filter("_s_cuts", lambda cut: cut < F.col("_s_rank"))).cast("int"))

    lanes = max(1, math.ceil(total / shards / LANE_ROWS))
    placed = placed.withColumn("_s_lot", F.xxhash64(F.lit(seed + 1), "_s_part", "_s_at"))
    placed = written(placed.withColumn("_s_lane", F.pmod(F.xxhash64("_s_lot", F.lit(1)), F.lit(lanes))).drop("_s_cuts", "_s_cut_part", "_s_rank"))
    loads = placed.groupBy("shard", "_s_lane").agg(F.count(F.lit(1)).alias("_s_n"))
    before = F.sum("_s_n").over(Window.partitionBy("shard").orderBy("_s_lane").rowsBetween(Window.unboundedPreceding, -1))
    starts = loads.select("shard", "_s_lane", F.coalesce(before, F.lit(0)).alias("_s_before"))
    again = Window.partitionBy("shard", "_s_lane").orderBy("_s_lot", "_s_part", "_s_at")
    out = placed.withColumn("_s_place", F.row_number().over(again)).join(starts, ["shard", "_s_lane"])
    return out.select(*[F.col(f"`{c}`") for c in kept], "shard", (F.col("_s_before") + F.col("_s_place") - 1).cast("long").alias("slot"))


def write_shards(docs: DataFrame, shards: int, path: str, seed: int = 11) -> None:
    """Write the shards to ``path/shard=<n>``; each file holds a run of slots in order."""
    placed = sharded(docs, shards, seed)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
