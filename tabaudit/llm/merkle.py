"""Merkle manifest of a dataset by butterfly exchange: every partition ends up with the upper proofs of its own rows.

Leaves are hashes of rows, sorted by id within their source and dealt out in aligned partitions of ``fanout ** height``
leaves. Each partition hashes its own subtree. Then partitions swap subtree roots round by round: the children of a node, at
most ``fanout`` of them, cover groups of partitions, and the partitions that stand at the same lane of each child meet, learn
each other's root, and each hashes the parent. A node is so hashed by every partition below it, and after the last
round each partition holds the whole path from its root to the root of the dataset: no pass downward is needed. Where a
child has fewer partitions than its siblings, its lanes answer several lanes of theirs. A round is one exchange of narrow
lines, one for each partition and sibling, in groups of at most ``fanout`` lines; a hot source only adds lanes.

A tree is built per source, then one over the sources' roots, sources in the order of their UTF-8 bytes. A node with a
single child is the hash of that child's digest, and a tree of one leaf is that leaf.

Nulls of every column have a mark of their own in a leaf. A null source is a source, ordered first; so is a null id among
ids. Rows with the same id are ordered by their digest, so equal rows are leaves of their own with proofs of their own. An
empty table has no rows and no root. Texts of any length are hashed whole. Further columns are neither hashed nor returned.
"""

from __future__ import annotations

import hashlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabaudit.llm.common import require
from tabaudit.operators.ranking import numbered
from tabaudit.session import written

FANOUT = 16
#: Levels of the subtree that a partition hashes by itself: 4096 leaves.
HEIGHT = 3
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]

_STEP = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """A field of a leaf: its bytes preceded by their number, or the mark of a null."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(value) for value in values]), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that follows from a leaf and the siblings on its path."""
    return F.aggregate(proof, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def siblings(proof: Column) -> Column:
    """All sibling digests of a path in one string, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), "")


def _digest(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def _levels(nodes: list[str], fanout: int, height: int, alone: bool) -> list[list[str]]:
    """The levels above ``nodes``, up to one node; ``height`` of them in all, unless the tree ends here (``alone``)."""
    levels = [nodes]
    while len(levels) <= height and (not alone or len(levels[-1]) > 1):
        last = levels[-1]
        levels.append([_digest(last[k : k + fanout]) for k in range(0, len(last), fanout)])
    return levels


def _placed(rows: DataFrame, fanout: int, height: int) -> tuple[DataFrame, DataFrame]:
    """Rows with ``source_no, at, n, part``, and the sources with ``source_no, n, parts``."""
    size = fanout**height
    rows = numbered(rows, "rank", F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), "leaf")
    sources = rows.groupBy("source").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n"))
    sources = written(numbered(sources, "source_no", F.col("source").asc_nulls_first()))
    here = sources.select(F.col("source").alias("_source"), "source_no", "first", "n")
    placed = rows.join(here, F.col("source").eqNullSafe(F.col("_source"))).withColumn("at", F.col("rank") - F.col("first"))
    placed = placed.withColumn("part", F.expr(f"at div {size}")).drop("_source", "first", "rank")
    return written(placed), sources.select("source_no", "n", F.ceil(F.col("n") / size).cast("long").alias("parts"))


def _subtrees(placed: DataFrame, fanout: int, height: int) -> DataFrame:
    """``source_no, part, node, wait``: the subtree root of each partition, hashed in one task from at most ``fanout ** height`` leaves."""

    def work(group: pd.DataFrame) -> pd.DataFrame:
        leaves = group.sort_values("at")["leaf"].tolist()
        levels = _levels(leaves, fanout, height, int(group["n"].iloc[0]) <= fanout**height)
        return pd.DataFrame({"source_no": group["source_no"].iloc[:1].to_numpy(), "part": group["part"].iloc[:1].to_numpy(), "node": [levels[-1][0]]})

    return placed.select("source_no", "part", "at", "n", "leaf").groupBy("source_no", "part").applyInPandas(work, "source_no long, part long, node string")


def _round(state: DataFrame, fanout: int) -> DataFrame:
    """One round of the butterfly over ``state(tree, at, lane, lanes, nodes, node, proof, ...)``.

    ``at`` is the place of the node among the ``nodes`` of its level and tree, ``lane`` the place of the partition among the
    ``lanes`` partitions below it. Trees of one node are finished and wait.
    """
    own = [f.name for f in state.schema.fields]
    waiting, moving = state.where("nodes = 1"), state.where("nodes > 1").withColumn("parent", F.expr(f"at div {fanout}"))
    # How many lanes the widest child of each parent has: a line for each node, not for each partition.
    widest = moving.where("lane = 0").groupBy("tree", "parent").agg(F.max("lanes").alias("widest"))
    answers = F.sequence(F.col("lane"), F.col("widest") - 1, F.col("lanes"))
    sent = moving.join(widest, ["tree", "parent"]).withColumn("to", F.explode(answers)).drop("widest")
    mine = F.when(F.col("to") == F.col("lane"), F.struct(*own))
    met = sent.groupBy("tree", "parent", "to").agg(F.sort_array(F.collect_list(F.struct("at", "lanes", "node", mine.alias("mine")))).alias("met"))
    children = met.withColumn("me", F.explode("met")).where("me.mine IS NOT NULL")
    left, right = F.filter("met", lambda x: x["at"] < F.col("me.at")), F.filter("met", lambda x: x["at"] > F.col("me.at"))

    def text(side: Column) -> Column:
        return F.array_join(F.transform(side, lambda x: x["node"]), "")

    def width(side: Column) -> Column:
        return F.aggregate(side, F.lit(0).cast("long"), lambda total, x: total + x["lanes"])

    new = {
        "at": F.col("parent"), "lane": width(left) + F.col("me.mine.lane"), "lanes": width(F.col("met")),
        "nodes": F.ceil(F.col("me.mine.nodes") / fanout).cast("long"), "node": F.sha2(text(F.col("met")), 256),
        "proof": F.concat("me.mine.proof", F.array(F.struct(text(left).alias("left"), text(right).alias("right")))),
    }
    moved = children.select(*[(new[c] if c in new else F.col(f"me.mine.{c}")).alias(c) for c in own])
    return waiting.unionByName(moved)


def _rounds(state: DataFrame, fanout: int) -> DataFrame:
    """Rounds until every tree is one node: as many as the highest tree has levels left."""
    most = state.agg(F.max("nodes")).first()[0] or 1
    while most > 1:
        state = written(_round(state, fanout))
        most = -(-most // fanout)
    return state


def _upper(placed: DataFrame, sources: DataFrame, fanout: int, height: int) -> DataFrame:
    """``source_no, part, subroot, root, upper``: the path above each partition, learned in the exchange."""
    state = _subtrees(placed, fanout, height).join(sources, "source_no").select(
        "source_no", "part", F.col("source_no").alias("tree"), F.col("part").alias("at"), F.lit(0).cast("long").alias("lane"), F.lit(1).cast("long").alias("lanes"),
        F.col("parts").alias("nodes"), "node", F.array().cast(_STEP).alias("proof"),
    )
    state = _rounds(written(state), fanout).withColumn("subroot", F.col("node"))
    # One tree over all sources: each partition goes on from the lane it has below its source.
    total = sources.count()
    state = state.withColumn("tree", F.lit(0).cast("long")).withColumn("at", F.col("source_no")).withColumn("nodes", F.lit(total).cast("long"))
    return _rounds(state, fanout).select("source_no", "part", "subroot", F.col("node").alias("root"), F.col("proof").alias("upper"))


def leaves(docs: DataFrame, **others: Column) -> DataFrame:
    """``doc_id, source, leaf`` of every row, and further columns to be carried along."""
    digest = leaf_digest(*map(F.col, FIELDS))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), digest.alias("leaf"), *[c.alias(n) for n, c in others.items()])


def manifest(docs: DataFrame, fanout: int = FANOUT, height: int = HEIGHT) -> DataFrame:
    """``doc_id, source, leaf, subroot, root, proof``, one row for each row of ``docs``."""
    return proven(leaves(require(docs, *FIELDS)), fanout, height)


def proven(leaves: DataFrame, fanout: int = FANOUT, height: int = HEIGHT) -> DataFrame:
    """``leaves(doc_id, source, leaf, ...)`` with ``subroot, root, proof``.

    ``proof`` is the path from the leaf to the root: for each level the digests left and right of the own node, in one string each.
    """
    if fanout < 2 or height < 1:
        raise ValueError("fanout must be 2 or more, height 1 or more")
    placed, sources = _placed(written(leaves), fanout, height)
    upper = written(_upper(placed, sources, fanout, height))
    made = T.StructType([*placed.drop("source_no", "part", "at", "n").schema.fields, T.StructField("subroot", T.StringType()), T.StructField("root", T.StringType())])

    def work(rows: pa.Table, above: pa.Table) -> pa.Table:
        rows = rows.sort_by("at")
        levels = _levels(rows.column("leaf").to_pylist(), fanout, height, rows.column("n")[0].as_py() <= fanout**height)
        sides = []
        for nodes in levels[:-1]:
            runs = [nodes[k : k + fanout] for k in range(0, len(nodes), fanout)]
            sides.append([("".join(run[:k]), "".join(run[k + 1 :])) for run in runs for k in range(len(run))])
        above = above.to_pylist()[0]
        upper = [(step["left"], step["right"]) for step in above["upper"]]
        steps = [step for row in range(len(rows)) for step in (*(side[row // fanout**depth] for depth, side in enumerate(sides)), *upper)]
        pairs = pa.StructArray.from_arrays([pa.array([a for a, _ in steps], pa.string()), pa.array([b for _, b in steps], pa.string())], ["left", "right"])
        deep = len(sides) + len(upper)
        proof = pa.ListArray.from_arrays(pa.array(range(0, len(steps) + 1, deep) if deep else [0] * (len(rows) + 1), pa.int32()), pairs)
        whole = [pa.array([above[name]] * len(rows), pa.string()) for name in ("subroot", "root")]
        return pa.Table.from_arrays([rows.column(f.name) for f in made.fields[:-2]] + whole + [proof], [*made.names, "proof"])

    both = placed.groupBy("source_no", "part").cogroup(upper.groupBy("source_no", "part"))
    return both.applyInArrow(work, T.StructType([*made.fields, T.StructField("proof", T.ArrayType(T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType())])))]))
