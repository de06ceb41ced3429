"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target number of words; a source with ``s`` words and target ``t`` takes each of its documents ``t / s``
times on average. The whole part is taken for certain. The fractional parts are rounded in pairs: words are moved at random
from one document's expectation to the other's until one of the two is taken a whole number of times, so that expectations
stay what they are and the words of each pair are kept. What is left over from a group, one document, is combined with the
leftovers of other groups in a reduction tree; only the last leftover of a source is rounded by itself, so the words taken from
a source miss its target by less than that document.

Groups are formed by a hash of the document and are paired from the largest document to the smallest, so that the last
leftover is a small one. All randomness comes from the seed and the data: reruns agree on any cluster.

Null text has size 0; null is a source of its own, ranked last. Rows with the same id, source and size are taken equally often.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabaudit.llm.common import text_of, word_count
from tabaudit.llm.places import PLACE, located, numbered_rows
from tabaudit.operators.ranking import numbered
from tabaudit.session import written

#: Documents, or leftovers, that are paired in one task at a time.
GROUP = 4096
UNIT = ["doc_id", "source", "size"]


def repeating(weights: list[float]) -> Column:
    """The weight of a source by its rank."""
    return F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))


def source_targets(sources: DataFrame, share: float, most: int, weight: Column) -> DataFrame:
    """``rank, source, source_size, target``: ``share`` of all words dealt out by weight, at most ``most`` times a source's size.

    What is cut off goes to the other sources by weight, until none is above. Sums are over integers, so they are exact.
    """
    ranked = numbered(sources, "rank", F.col("source").asc_nulls_last()).withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    ranked = written(ranked)
    budget = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > F.col("cap")
        cut, free, n = ranked.agg(
            F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)), F.count(F.when(over, F.lit(1)))
        ).first()
        if n == full or not free:
            break
        level, full = max(0.0, (budget - cut) / free), n
    target = F.least(F.col("weight") * F.lit(level), F.col("cap").cast("double"))
    return ranked.select(F.col("rank").cast("long").alias("rank"), "source", "source_size", target.alias("target"))


def pivot(mass: np.ndarray, chance: np.ndarray, random: np.random.Generator, last: bool) -> np.ndarray:
    """Round ``chance`` in pairs, in the given order; ``sum(mass * chance)`` stays, but for rounding the last one if asked."""
    chance = chance.copy()
    draws = random.random(len(chance) + 1)
    held = -1
    for k in range(len(chance)):
        if not 0.0 < chance[k] < 1.0:
            continue
        if held < 0:
            held = k
            continue
        a, b = mass[held], mass[k]
        up = min(a * (1 - chance[held]), b * chance[k])  # words that can move to the held document, and from it
        down = min(a * chance[held], b * (1 - chance[k]))
        gain = up if draws[k] * (up + down) < down else -down
        settled_held = gain == (a * (1 - chance[held]) if gain > 0 else -a * chance[held])
        chance[held] += gain / a
        chance[k] -= gain / b
        done = held if settled_held else k
        chance[done] = round(chance[done])
        other = k if settled_held else held
        chance[other] = min(max(chance[other], 0.0), 1.0)
        if min(chance[other], 1 - chance[other]) < 1e-12:
            chance[other] = round(chance[other])
            held = -1
        else:
            held = other
    if last and held >= 0:
        chance[held] = float(draws[-1] < chance[held])
    return chance


def _rounded(units: DataFrame, seed: int) -> DataFrame:
    """``UNIT, extra``: 0 or 1 for each of ``units(UNIT, rows, rank, chance, block, blocks)``."""

    def reduce(level: int):
        def work(group: pd.DataFrame) -> pd.DataFrame:
            group = group.assign(mass=group["size"] * group["rows"]).sort_values(["mass", "doc_id", "size"], ascending=[False, True, True])
            random = np.random.default_rng([seed, level, int(group["rank"].iloc[0]), int(group["block"].iloc[0])])
            group["chance"] = pivot(group["mass"].to_numpy(float), group["chance"].to_numpy(float), random, bool(group["blocks"].iloc[0] == 1))
            return group[list(columns)]

        columns = [f.name for f in units.schema.fields]
        return work

    levels, most = 1, units.agg(F.max("blocks")).first()[0] or 1
    while most > 1:
        levels, most = levels + 1, math.ceil(most / GROUP)
    done, left = None, units
    for level in range(levels):
        left = written(left.groupBy("rank", "block").applyInPandas(reduce(level), units.schema))
        settled = left.where("chance IN (0.0, 1.0)").select(*UNIT, F.col("chance").cast("int").alias("extra"))
        done = settled if done is None else done.unionByName(settled)
        left = left.where("chance NOT IN (0.0, 1.0)")
        left = left.withColumn("block", F.expr(f"block div {GROUP}")).withColumn("blocks", F.ceil(F.col("blocks") / GROUP).cast("long"))
    return done


def copies(docs: DataFrame, share: float = 1.0, most: int = 2, weight: Column | None = None, seed: int = 7, along: list[str] | None = None) -> DataFrame:
    """``doc_id, source, size, rank, source_size, target, copies``: how often each document is taken, a line for each row of ``docs``.

    ``share`` is the size of the mix as a part of all words, ``weight`` an expression over ``source`` and ``rank`` (default: equal).
    Columns named in ``along`` come along.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(text_of()).alias("size"), *(along or []))
    rows = written(rows)
    targets = written(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), share, most, F.lit(1.0) if weight is None else weight))
    units = rows.groupBy(*UNIT).agg(F.count(F.lit(1)).alias("rows"))
    here = targets.withColumnRenamed("source", "_source")
    mean = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    units = units.join(here, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    units = written(units.withColumn("whole", F.floor(mean).cast("int")).withColumn("chance", mean - F.floor(mean)))

    open_ones = units.where("chance > 0 AND size > 0")
    blocks = open_ones.groupBy("rank").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("long").alias("blocks"))
    dealt = open_ones.join(blocks, "rank").withColumn("block", F.pmod(F.xxhash64("doc_id", "size", F.lit(seed)), "blocks"))
    extra = _rounded(dealt.select(*UNIT, "rows", "rank", "chance", "block", "blocks"), seed)

    by_hash = F.pmod(F.xxhash64("doc_id", "source", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    empty = F.when((F.col("size") == 0) & (by_hash < F.col("chance")), F.lit(1)).otherwise(F.lit(0))
    extra = extra.select(*[F.col(c).alias(f"_{c}") for c in UNIT], "extra")
    match = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in UNIT]
    units = units.join(extra, match[0] & match[1] & match[2], "left").withColumn("copies", F.col("whole") + F.coalesce("extra", empty))
    units = units.select(*[F.col(c).alias(f"_{c}") for c in UNIT], "rank", "source_size", "target", "copies")
    return rows.join(units, match[0] & match[1] & match[2]).drop(*[f"_{c}" for c in UNIT])


def mixture(docs: DataFrame, share: float = 1.0, most: int = 2, weight: Column | None = None, seed: int = 7) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with all its columns; rows are multiplied where they are."""
    columns = docs.columns
    rows = located(docs)
    taken = copies(rows, share, most, weight, seed, PLACE).select(*PLACE, F.col("copies").alias("number"))
    repeated = numbered_rows(rows, taken, "__m_copies", most)
    repeated = repeated.withColumn("__m_copy", F.explode(F.sequence(F.lit(1), F.col("__m_copies"))))
    return repeated.select(*[F.col(f"`{c}`") for c in columns])
