"""N-gram Jaccard join: exact links between documents whose shingle sets are similar enough, found in signature trees.

1. Every text becomes a set of hashed shingles. Documents with equal sets are one class from here on.
2. A class stands under the shingles of its prefix (as many as a similar set cannot avoid), frequent shingles last. How
   frequent a shingle is comes from a counting sketch over all documents; its size is fixed, and it decides only the
   order, never the result.
3. Classes that meet under a shingle go to the cell of the smallest class there, so each pair that can be a link meets in
   a cell. A cell is cut into blocks of bounded size by set size and hash. Each block becomes a signature tree over the
   bitmaps of its classes; the dual traversal leaves the pairs whose overlap may be large enough, and only classes in such
   pairs go on. Blocks of the same cell are traversed in pairs, with both trees.
4. What goes on is grouped anew by the pairs left, and the sets themselves are fetched for it. Pairs left in a block are
   tested exactly, until links connect them: two classes that a path of links joins anyway get no further link, so
   groups of copies never become all their pairs.
5. The blocks of a group too large for one are the nodes of an upper level with bitmaps of their own: pairs of blocks are
   pruned by size range and largest possible overlap, and skipped where both lie in one component already.

Nulls and texts without words have the empty set and no links; their component is their own ``doc_id``. A component
without any ``doc_id`` has null. Rows may repeat.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tabaudit.llm.common import text_of
from tabaudit.llm.components import components
from tabaudit.llm.places import PLACE, kept, located
from tabaudit.llm.shingles import set_print, shingle_sets
from tabaudit.llm.signature_tree import Groups, Level, Tree, bitmap, dual_links, dual_pairs, folded, lowest_labels, possible, width_of
from tabaudit.session import written

#: The sketch: counters, and the part of the hash range that prefixes come from.
CELLS = 1 << 22
SKETCH_SHIFT = 40
SKETCH_BLOCKS = 64
LOW_RANGE = np.uint64(1 << 62)
#: A block of a tree holds at most about so many sets and shingles.
BLOCK_SETS = 512
BLOCK_SHINGLES = 1 << 20
#: Marks of the ids whose sets are wanted: 8 MB, whatever the input. Where it fills up, more sets are made than needed.
MARKS, MARK_BLOCKS = 1 << 26, 64
#: Blocks are handed to tasks in parcels of about so many members, or shingles where sets travel along.
PARCEL_MEMBERS, PARCEL_SHINGLES = 4096, 1 << 20


def _scanned(docs: DataFrame, width: int) -> DataFrame:
    """``n, fp, bits`` and all columns but the text of every row, and from each task its part of the sketch (``block, counts``)."""
    own = [T.StructField(f.name, f.dataType) for f in docs.schema.fields if f.name != "text"]
    schema = T.StructType([*own, *T.StructType.fromDDL("n long, fp long, bits binary, block int, counts binary").fields])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, names = np.zeros(CELLS, np.int32), [*[f.name for f in own], "n", "fp", "bits", "block", "counts"]
        for batch in batches:
            sizes, prints, bits, seen = [], [], [], [np.zeros(0, np.uint64)]
            for shingles in shingle_sets(batch.column("text"), width):
                sizes.append(len(shingles))
                bits.append(bitmap(shingles, width_of(len(shingles))).tobytes() if len(shingles) else None)
                prints.append(set_print(shingles) if len(shingles) else None)
                seen.append(shingles[: np.searchsorted(shingles, LOW_RANGE)] >> np.uint64(SKETCH_SHIFT))
            np.add.at(counts, np.concatenate(seen).astype(np.int64), 1)
            n = len(sizes)
            kept = [batch.column(f.name) for f in own]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sizes, pa.int64()), pa.array(prints, pa.int64()), pa.array(bits, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names
            )
        blocks, none = counts.reshape(SKETCH_BLOCKS, -1), pa.nulls(SKETCH_BLOCKS, pa.int64())
        empty = [pa.nulls(SKETCH_BLOCKS, pa.string() if f.dataType == T.StringType() else pa.int64()) for f in own]
        yield pa.RecordBatch.from_arrays(
            [*empty, none, none, pa.nulls(SKETCH_BLOCKS, pa.binary()), pa.array(range(SKETCH_BLOCKS), pa.int32()), pa.array([b.tobytes() for b in blocks], pa.binary())], names
        )

    return docs.mapInArrow(scan, schema)


def _sketch(scanned: DataFrame) -> np.ndarray:
    """The summed sketch, 32 MB whatever the input; added up in two steps."""

    def total(group: pd.DataFrame) -> pd.DataFrame:
        size = CELLS // SKETCH_BLOCKS
        out = np.zeros(size, np.int64)
        for body in group["counts"]:
            out += np.frombuffer(body, np.int64 if len(body) == 8 * size else np.int32)
        return pd.DataFrame({"block": group["block"].iloc[:1].to_numpy(), "counts": [out.tobytes()]})

    parts = scanned.where("block IS NOT NULL").select("block", "counts", F.pmod(F.xxhash64("counts"), F.lit(64)).alias("lane"))
    lanes = parts.groupBy("block", "lane").applyInPandas(lambda group: total(group[["block", "counts"]]), "block int, counts binary")
    rows = lanes.groupBy("block").applyInPandas(total, "block int, counts binary").collect()
    return np.concatenate([np.frombuffer(row["counts"], np.int64) for row in sorted(rows, key=lambda row: row["block"])] or [np.zeros(CELLS, np.int64)])


def prefix(shingles: np.ndarray, ranks: np.ndarray, percent: int) -> np.ndarray:
    """The shingles under which a set must stand: one more than a similar set may lack, in the order of (rank, hash)."""
    n = len(shingles)
    length = n - -(-percent * n // 100) + 1
    low = shingles[: np.searchsorted(shingles, LOW_RANGE)]
    rank = ranks[(low >> np.uint64(SKETCH_SHIFT)).astype(np.int64)]
    if not rank[:length].any():
        return shingles[:length]
    order = np.argsort(np.concatenate((rank, np.zeros(n - len(low), rank.dtype))), kind="stable")
    return shingles[order[:length]]


def _standing(docs: DataFrame, width: int, percent: int, sketch: np.ndarray) -> DataFrame:
    """``token, fp, n``: every class under the shingles of its prefix."""
    # A counter is hit by shingles that occur once, too; what lies five deviations above that is a frequent shingle.
    mean = float(sketch.mean())
    often = max(8.0, mean + 5.0 * math.sqrt(mean))
    ranks = np.where(sketch >= often, 1 + np.floor(np.log2(np.maximum(sketch, 1) / often)), 0).astype(np.int8)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def stand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            tokens, prints, sizes, pending = [], [], [], 0
            for shingles in shingle_sets(batch.column("text"), width):
                if not len(shingles) or (fp := set_print(shingles)) in seen:
                    continue
                seen.add(fp)
                chosen = prefix(shingles, shared.value, percent)
                tokens.append(chosen)
                prints.append(np.full(len(chosen), fp, np.int64))
                sizes.append(np.full(len(chosen), len(shingles), np.int32))
                pending += len(chosen)
                if pending > 100_000:
                    yield _columns(tokens, prints, sizes)
                    tokens, prints, sizes, pending = [], [], [], 0
            if pending:
                yield _columns(tokens, prints, sizes)

    def _columns(tokens, prints, sizes):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(prints)), pa.array(np.concatenate(sizes))], ["token", "fp", "n"])

    return docs.select("text").mapInArrow(stand, "token long, fp long, n int")


def _cells(standing: DataFrame) -> DataFrame:
    """``hub, fp, n``: the members of each cell."""
    met = Window.partitionBy("token")
    pairs = standing.withColumn("hub", F.min("fp").over(met)).withColumn("last", F.max("fp").over(met)).where("hub <> last")
    return written(pairs.select("hub", "fp", "n").distinct())


def _dealt(members: DataFrame, percent: int) -> DataFrame:
    """``hub, large, band, part, fp, n``: the members of each cell in blocks, large cells by set size and hash."""
    whole = members.groupBy("hub").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles"))
    large = whole.select("hub", ((F.col("sets") > BLOCK_SETS) | (F.col("shingles") > BLOCK_SHINGLES)).alias("large"))
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(100 / percent))).cast("int")
    banded = members.join(large, "hub").withColumn("band", F.when(F.col("large"), band).otherwise(F.lit(0)))
    loads = banded.groupBy("hub", "band").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles"))
    parts = loads.select("hub", "band", F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).alias("parts"))
    return banded.join(parts, ["hub", "band"]).select("hub", "large", "band", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int").alias("part"), "fp", "n")


def _parcel(rows: DataFrame, weight: str, most: int, *unit: str) -> DataFrame:
    """``rows`` with ``parcel``: units stay whole, and many small ones share a parcel. Expected weight of a parcel: ``most``."""
    total = rows.agg(F.sum(weight) if weight else F.count(F.lit(1))).first()[0] or 0
    return rows.withColumn("parcel", F.pmod(F.xxhash64(*unit), F.lit(max(1, math.ceil(total / most)))))


def _units(group: pd.DataFrame, unit: list[str], order: list[str]) -> Iterator[pd.DataFrame]:
    """The units of a parcel, each sorted by ``order``."""
    group = group.sort_values([*unit, *order])
    keys = [group[name].to_numpy() for name in unit]
    starts = np.flatnonzero(np.concatenate(([True], np.any([key[1:] != key[:-1] for key in keys], axis=0))))
    for start, stop in zip(starts, [*starts[1:], len(group)]):
        yield group[start:stop]


def _bit_pairs(group: pd.DataFrame, split: int | None, percent: int) -> np.ndarray:
    """Pairs of members left possible: all of them, or those between the members before and from ``split``.

    Sets that can be linked have bitmaps of the same width or of neighbouring widths, so each width is traversed with the
    next one folded to it.
    """
    bits, sizes = [np.frombuffer(body, np.uint64) for body in group["bits"]], group["n"].to_numpy(np.int64)
    widths, found = np.array([64 * len(b) for b in bits]), [np.zeros((0, 2), np.int64)]
    for width in np.unique(widths):
        own = np.flatnonzero((widths == width) | (widths == 2 * width))
        tables = [own] if split is None else [own[own < split], own[own >= split]]
        if not all(len(t) for t in tables):
            continue
        trees = [Tree(np.stack([folded(bits[k], width) for k in t]), sizes[t]) for t in tables]
        pairs = dual_pairs(trees[0], trees[1] if split is not None else None, percent)
        pairs = np.stack([tables[0][pairs[:, 0]], tables[-1][pairs[:, 1]]], axis=1)
        found.append(pairs[(widths[pairs] == width).any(axis=1)])
    return np.concatenate(found)


def _possible(dealt: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """``hub, fp, n``: members that the bitmaps leave a partner, grouped by what they are connected with."""
    block, columns = ["hub", "band", "part"], ["hub", "fp", "n"]
    empty = pd.DataFrame({name: np.zeros(0, np.int64) for name in columns})

    def inside(parcel: pd.DataFrame) -> pd.DataFrame:
        out = [empty]
        for group in _units(parcel, block, ["n", "fp"]):
            pairs = _bit_pairs(group, None, percent)
            if len(pairs):
                prints, alive = group["fp"].to_numpy(), np.unique(pairs)
                hubs = group["hub"].to_numpy() if group["large"].iloc[0] else prints[lowest_labels(len(group), pairs)]
                out.append(pd.DataFrame({"hub": hubs[alive], "fp": prints[alive], "n": group["n"].to_numpy()[alive]}))
        return pd.concat(out)

    def between(parcel: pd.DataFrame) -> pd.DataFrame:
        out = [empty]
        for group in _units(parcel, ["pair"], ["side", "n", "fp"]):
            split = int((group["side"] == "a").sum())
            out.append(group[columns].iloc[np.unique(_bit_pairs(group, split, percent))])
        return pd.concat(out)

    parcels = _parcel(dealt, "", PARCEL_MEMBERS, *block).join(bits, "fp")
    found = parcels.select("parcel", *block, "large", "fp", "n", "bits").groupBy("parcel").applyInPandas(inside, "hub long, fp long, n int")
    crossed = _block_pairs(dealt.where("large").select(*block).distinct()).join(dealt.join(bits, "fp"), block)
    crossed = crossed.select("pair", "side", *columns, "bits").withColumn("parcel", F.xxhash64("pair"))
    return found.unionByName(crossed.groupBy("parcel").applyInPandas(between, "hub long, fp long, n int")).distinct()


def _block_pairs(blocks: DataFrame, keep=None) -> DataFrame:
    """``pair, hub, band, part, side`` for two blocks of a cell whose sizes can match. Lines of blocks, not of members."""
    a = blocks.select("hub", *[F.col(c).alias(f"{c}_a") for c in blocks.columns if c != "hub"])
    b = blocks.select("hub", *[F.col(c).alias(f"{c}_b") for c in blocks.columns if c != "hub"])
    below = (F.col("band_a") < F.col("band_b")) | ((F.col("band_a") == F.col("band_b")) & (F.col("part_a") < F.col("part_b")))
    met = a.join(b, "hub").where(below & (F.col("band_b") - F.col("band_a") <= 1))
    met = met if keep is None else keep(met)
    pair = F.concat_ws(":", "hub", "band_a", "part_a", "band_b", "part_b").alias("pair")
    sides = [met.select(pair, "hub", F.col(f"band_{s}").alias("band"), F.col(f"part_{s}").alias("part"), F.lit(s).alias("side")) for s in "ab"]
    return sides[0].unionByName(sides[1])


def _marks(ids: DataFrame) -> np.ndarray:
    """A table of ``MARKS`` bits in which the ids are marked, put together from blocks in two steps."""
    size = MARKS // MARK_BLOCKS

    def mark(group: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(size, np.uint8)
        bits[group["mark"].to_numpy() % size] = 1
        return pd.DataFrame({"block": group["block"].iloc[:1].to_numpy(), "bits": [np.packbits(bits).tobytes()]})

    def join(group: pd.DataFrame) -> pd.DataFrame:
        bits = np.bitwise_or.reduce([np.frombuffer(body, np.uint8) for body in group["bits"]], axis=0)
        return pd.DataFrame({"block": group["block"].iloc[:1].to_numpy(), "bits": [bits.tobytes()]})

    marks = ids.select(_mark().alias("mark")).distinct().withColumn("block", F.expr(f"mark div {size}"))
    lanes = max(1, math.ceil(ids.count() / MARK_BLOCKS / 100_000))
    parts = marks.withColumn("lane", F.pmod(F.xxhash64("mark"), F.lit(lanes))).groupBy("block", "lane").applyInPandas(lambda g: mark(g[["mark", "block"]]), "block long, bits binary")
    out = np.zeros((MARK_BLOCKS, size // 8), np.uint8)
    for row in parts.groupBy("block").applyInPandas(join, "block long, bits binary").collect():
        out[row["block"]] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


def _mark() -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(MARKS))


def _sets(docs: DataFrame, classes: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """``fp, body``: the sets of all classes that stand in a cell, made again from their texts.

    The ids of one document of each class are marked in a table of fixed size that goes to every task, so texts stay where
    they are and only sets are exchanged. Ids that share a mark, equal ids with different texts and rows that repeat bring sets
    that nobody asked for, or twice; the join drops them.
    """
    wanted = written(members.select("fp").distinct())
    shared = docs.sparkSession.sparkContext.broadcast(_marks(written(classes.join(wanted, "fp", "left_semi").select("doc_id"))))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mark = batch.column("mark").to_numpy()
            texts = batch.column("text").filter(pa.array((shared.value[mark >> 3] >> (7 - (mark & 7)) & 1).astype(bool)))
            prints, bodies, size = [], [], 0
            for shingles in shingle_sets(texts, width) if len(texts) else ():
                if len(shingles):
                    prints.append(set_print(shingles))
                    bodies.append(shingles.tobytes())
                    size += len(bodies[-1])
                if size > 1 << 23:
                    yield pa.RecordBatch.from_arrays([pa.array(prints, pa.int64()), pa.array(bodies, pa.binary())], ["fp", "body"])
                    prints, bodies, size = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(prints, pa.int64()), pa.array(bodies, pa.binary())], ["fp", "body"])

    made = docs.select("text", _mark().alias("mark")).mapInArrow(make, "fp long, body binary")
    return written(made.join(wanted, "fp", "left_semi").groupBy("fp").agg(F.first("body").alias("body")))


def _set_tree(sets: list[np.ndarray]) -> Tree:
    return Tree(np.stack([bitmap(s) for s in sets]), np.array([len(s) for s in sets], np.int64))


def _unpacked(bodies: pd.Series) -> list[np.ndarray]:
    return [np.frombuffer(body, np.uint64) for body in bodies]


def _block_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links inside each block."""
    block = ["hub", "band", "part"]

    def search(parcel: pd.DataFrame) -> pd.DataFrame:
        a, b = [], []
        for group in _units(parcel, block, ["n", "fp"]):
            prints, sets = group["fp"].to_numpy(), _unpacked(group["body"])
            links = dual_links(dual_pairs(_set_tree(sets), None, percent), sets, sets, Groups(np.arange(len(sets))), 0, percent)
            a += [prints[i] for i, _ in links]
            b += [prints[j] for _, j in links]
        return pd.DataFrame({"a": a, "b": b}, dtype="int64")

    parcels = _parcel(members, "n", PARCEL_SHINGLES, *block).join(sets, "fp")
    return parcels.select("parcel", *block, "fp", "n", "body").groupBy("parcel").applyInPandas(search, "a long, b long")


def _nodes(filled: DataFrame) -> DataFrame:
    """The upper level: bitmap, size range and component range of every block of a cell that has several."""

    def make(group: pd.DataFrame) -> pd.DataFrame:
        root = _set_tree(_unpacked(group["body"])).levels[-1]
        return pd.DataFrame(
            {
                "hub": group["hub"].iloc[:1].to_numpy(), "band": group["band"].iloc[:1].to_numpy(), "part": group["part"].iloc[:1].to_numpy(),
                "bits": [root.bits[0].tobytes()], "small": root.small, "large": root.large, "hidden": root.hidden,
                "first": [group["component"].min()], "last": [group["component"].max()],
            }
        )

    return filled.groupBy("hub", "band", "part").applyInPandas(
        make, "hub long, band int, part int, bits binary, small long, large long, hidden long, first long, last long"
    )


def _node_pairs(nodes: DataFrame, percent: int) -> DataFrame:
    """``pair, hub, band, part, side``: the blocks of each pair that may still hold a link."""
    apart = (F.col("first_a") != F.col("last_a")) | (F.col("first_b") != F.col("last_b")) | (F.col("first_a") != F.col("first_b"))
    level = ["bits", "small", "large", "hidden"]

    @F.pandas_udf("boolean")
    def may_link(*columns: pd.Series) -> pd.Series:
        sides = []
        for part in (columns[:4], columns[4:]):
            bits = np.frombuffer(b"".join(part[0]), np.uint64).reshape(len(part[0]), -1)
            sides.append(Level(bits, *(c.to_numpy(np.int64) for c in part[1:])))
        rows = np.arange(len(columns[0]))
        return pd.Series(possible(sides[0], rows, sides[1], rows, percent))

    return _block_pairs(nodes, lambda met: met.where(apart).where(may_link(*[f"{c}_a" for c in level], *[f"{c}_b" for c in level])))


def _cross_links(pairs: DataFrame, filled: DataFrame, percent: int) -> DataFrame:
    """Links between the two blocks of each pair."""

    def search(group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(size=group["body"].str.len()).sort_values(["side", "size", "fp"])
        split, sets, prints = int((group["side"] == "a").sum()), _unpacked(group["body"]), group["fp"].to_numpy()
        groups = Groups(group["component"].to_numpy())
        pairs = dual_pairs(_set_tree(sets[:split]), _set_tree(sets[split:]), percent)
        links = dual_links(pairs, sets[:split], sets[split:], groups, split, percent)
        return pd.DataFrame({"a": [prints[i] for i, _ in links], "b": [prints[j + split] for _, j in links]}, dtype="int64")

    both = pairs.join(filled, ["hub", "band", "part"]).select("pair", "side", "fp", "component", "body")
    return both.groupBy("pair").applyInPandas(search, "a long, b long")


def linked_components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links``, one row for each row of ``docs``.

    ``n_links`` counts the links found at the document's class; links span each component.
    """
    return _linked(docs, width, percent, []).drop("component")


def _linked(docs: DataFrame, width: int, percent: int, along: list[str]) -> DataFrame:
    """The components with a number of their own, ``component`` (null for an empty set), and the columns named in ``along``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), *along)
    scanned = written(_scanned(docs, width))
    rows = scanned.where("block IS NULL").select("doc_id", F.col("n").alias("n_shingles"), "fp", *along)
    classes = rows.where("fp IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("doc_id"))

    cells = written(_dealt(_cells(_standing(docs, width, percent, _sketch(scanned))), percent))
    bits = scanned.select("fp", "bits").join(cells.select("fp").distinct(), "fp", "left_semi").groupBy("fp").agg(F.first("bits").alias("bits"))
    members = written(_dealt(written(_possible(cells, bits, percent)), percent).drop("large"))
    sets = _sets(docs, classes, members, width)
    links = written(_block_links(members, sets, percent))
    groups = written(components(links))

    several = members.groupBy("hub").agg(F.countDistinct("band", "part").alias("blocks")).where("blocks > 1").select("hub")
    placed = members.join(several, "hub", "left_semi").join(groups.withColumnRenamed("node", "fp"), "fp", "left")
    placed = written(placed.select("hub", "band", "part", "fp", F.coalesce("component", "fp").alias("component")))
    if not placed.isEmpty():
        filled = placed.join(sets, "fp")
        pairs = written(_node_pairs(_nodes(filled), percent))
        links = links.unionByName(written(_cross_links(pairs, filled, percent)))
        groups = written(components(links))

    degrees = links.select(F.col("a").alias("fp")).unionByName(links.select(F.col("b").alias("fp"))).groupBy("fp").agg(F.count(F.lit(1)).alias("n_links"))
    named = classes.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    named = written(named)
    names = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    answer = named.join(names, "component").join(degrees, "fp", "left").select("fp", "component", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return rows.join(answer, "fp", "left").select(
        "doc_id", "n_shingles", F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component", *along,
    )


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each component the smallest ``doc_id`` (null last), then the row
    that stands first in the files. Rows are filtered where they are.
    """
    columns, rows = docs.columns, located(docs)
    found = written(_linked(rows, width, percent, PLACE).select("doc_id", "component", *PLACE))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *PLACE)).alias("first")
    stays = found.where("component IS NOT NULL").groupBy("component").agg(first).select(*[F.col(f"first.{c}").alias(c) for c in PLACE])
    return kept(rows, stays.unionByName(found.where("component IS NULL").select(*PLACE))).select(*[F.col(f"`{c}`") for c in columns])
