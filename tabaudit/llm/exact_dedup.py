"""Exact duplicates: binary-fuse filters of an immutable snapshot screen the digests of a new batch.

A snapshot is a folder written once: its digests, dealt into buckets of about ``KEYS_PER_FILTER``, and for each bucket one
static filter (three slots a key, eight-bit fingerprints) that is never changed. A digest of a new batch meets the filter of
its bucket only; filters of bounded total size travel to the tasks, so digests stay where they are. What the filter rejects is
new for certain; what it lets through joins the exact bucket, and then the texts themselves are compared. Duplicates inside
the new batch are grouped on their own, before they are screened.

Texts are equal when they are identical without their white space. Of equal texts the row with the most code points
stays, then the smallest ``doc_id`` (a null id comes last), then the row that stands first in the files. Null text counts as
empty. Rows that repeat id and text count as rows of their own, and only one of them is kept. Texts of any length are compared
whole, in the tasks that hold them: only texts of groups travel, and those of a large group in lanes that each have the text
that stays. An empty table gives an empty result. Further columns stay what they are.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabaudit.llm.common import squeezed, text_of
from tabaudit.llm.places import PLACE, kept, located, numbered_rows
from tabaudit.session import fresh_path, written

#: Snapshot digests that share one filter, on average, and the filters that travel to every task, in bytes.
KEYS_PER_FILTER, FILTER_BYTES = 4096, 1 << 26
#: Texts of a group that are compared in one task; larger groups are cut into so many times more lanes.
LANE_ROWS, LANE_STEP = 1024, 16


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


# --- the filter ------------------------------------------------------------------------------------------------------


def _spread(keys: np.ndarray, seed: int) -> np.ndarray:
    value = keys + np.uint64(seed)
    value = (value ^ (value >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    value = (value ^ (value >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return value ^ (value >> np.uint64(33))


def _slots(value: np.ndarray, segment: int, segments: int) -> np.ndarray:
    """Three slots a key, in three consecutive segments."""
    first = ((value >> np.uint64(32)) * np.uint64(segment * segments)) >> np.uint64(32)
    mask = np.uint64(segment - 1)
    second = (first + np.uint64(segment)) ^ ((value >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * segment)) ^ (value & mask)
    return np.stack([first, second, third]).astype(np.int64)


def _prints(value: np.ndarray) -> np.ndarray:
    return ((value ^ (value >> np.uint64(32))) & np.uint64(0xFF)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> bytes:
    """A binary-fuse filter over distinct 64-bit keys: seed, segment length, number of segments, fingerprints."""
    n = len(keys)
    segment = 1 << max(2, int(math.log(max(n, 2)) / math.log(3.33) + 2.25))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    segments = max(1, math.ceil(n * factor / segment) - 2)
    seed = 0x9E3779B97F4A7C15
    while True:
        value = _spread(keys, seed)
        slots = _slots(value, segment, segments)
        size = segment * (segments + 2)
        load = np.bincount(slots.ravel(), minlength=size)
        held = np.zeros(size, np.int64)
        for row in slots:
            np.bitwise_xor.at(held, row, np.arange(n))
        rounds, done = [], 0
        free = np.flatnonzero(load == 1)
        while free.size:
            who, first = np.unique(held[free], return_index=True)
            rounds.append((who, free[first]))
            done += who.size
            gone = slots[:, who]
            for row in gone:
                np.subtract.at(load, row, 1)
                np.bitwise_xor.at(held, row, who)
            touched = np.unique(gone)
            free = touched[load[touched] == 1]
        if done == n:
            break
        seed = (seed * 6364136223846793005 + 1442695040888963407) % (1 << 64)
    table, prints = np.zeros(size, np.uint8), _prints(value)
    for who, slot in reversed(rounds):
        a, b, c = slots[:, who]
        table[slot] = prints[who] ^ table[a] ^ table[b] ^ table[c]
    return np.array([seed, segment, segments], np.uint64).tobytes() + table.tobytes()


def probe_filter(body: bytes, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be in the filter; true for every key it was built from."""
    seed, segment, segments = (int(x) for x in np.frombuffer(body[:24], np.uint64))
    table = np.frombuffer(body[24:], np.uint8)
    value = _spread(keys, seed)
    a, b, c = _slots(value, segment, segments)
    return (table[a] ^ table[b] ^ table[c]) == _prints(value)


def snapshot_filters(classes: DataFrame) -> DataFrame:
    """``(bucket, body)``: one filter for each bucket of ``classes(bucket, key)``."""

    def build(group: pd.DataFrame) -> pd.DataFrame:
        keys = np.unique(group["key"].to_numpy(np.int64).view(np.uint64))
        return pd.DataFrame({"bucket": group["bucket"].iloc[:1].to_numpy(), "body": [build_filter(keys)]})

    return classes.select("bucket", "key").groupBy("bucket").applyInPandas(build, "bucket long, body binary")


# --- snapshots -------------------------------------------------------------------------------------------------------


def write_snapshot(classes: DataFrame, path: str) -> None:
    """Write a snapshot of ``classes(digest, ...)``: ``path/classes`` with ``key`` and ``bucket``, and ``path/filters``.

    Both are immutable: writing to a snapshot that is there already is an error.
    """
    keyed = classes.withColumn("key", F.xxhash64("digest"))
    n_buckets = max(1, math.ceil(classes.count() / KEYS_PER_FILTER))
    keyed = keyed.withColumn("bucket", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(n_buckets)))
    keyed.write.mode("error").parquet(f"{path}/classes")
    filters = snapshot_filters(classes.sparkSession.read.schema(keyed.schema).parquet(f"{path}/classes"))
    filters.withColumn("n_buckets", F.lit(n_buckets)).write.mode("error").parquet(f"{path}/filters")


def known_digests(batch: DataFrame, path: str) -> DataFrame:
    """``digest``: those of ``batch(digest)`` that the filters of a snapshot let through. Every digest of the snapshot is."""
    spark = batch.sparkSession
    filters = spark.read.schema("bucket long, body binary, n_buckets int").parquet(f"{path}/filters")
    total, n_buckets = filters.agg(F.sum(F.length("body")), F.max("n_buckets")).first()
    if n_buckets is None:
        return batch.select("digest").where("false")
    keyed = batch.select("digest", F.xxhash64("digest").alias("key"))
    keyed = keyed.withColumn("bucket", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(n_buckets)))
    if total <= FILTER_BYTES:
        held = spark.sparkContext.broadcast({row["bucket"]: bytes(row["body"]) for row in filters.toLocalIterator()})

        def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys, buckets = (batch.column(c).to_numpy() for c in ("key", "bucket"))
                hit = np.zeros(batch.num_rows, bool)
                order = np.argsort(buckets, kind="stable")
                for rows in np.split(order, np.flatnonzero(np.diff(buckets[order])) + 1):
                    body = held.value.get(int(buckets[rows[0]])) if len(rows) else None
                    if body:
                        hit[rows] = probe_filter(body, keys[rows].view(np.uint64))
                yield pa.RecordBatch.from_arrays([batch.column("digest").filter(pa.array(hit))], ["digest"])

        return keyed.mapInArrow(screen, "digest binary")

    def probe(group: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        keys = group["key"].to_numpy(np.int64).view(np.uint64)
        hit = probe_filter(held["body"].iloc[0], keys) if len(held) else np.zeros(len(keys), bool)
        return pd.DataFrame({"digest": group["digest"][hit]})

    return keyed.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(probe, "digest binary")


# --- groups ----------------------------------------------------------------------------------------------------------


def _classes(rows: DataFrame, *by: str) -> DataFrame:
    """One line for each digest: number of rows and the row that stays. Partial minima keep hot digests small."""
    best = F.min(F.struct((-F.col("n_points")).alias("low"), F.col("doc_id").isNull().alias("no_id"), "doc_id", *PLACE))
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), best.alias("best"))


def _answer(rows: DataFrame, classes: DataFrame, on: list[str]) -> DataFrame:
    stays = (F.col("best.__file") == F.col("__file")) & (F.col("best.__row") == F.col("__row"))
    return rows.join(classes, on).select("doc_id", F.col("best.doc_id").alias("keep_id"), F.col("n").alias("group_size"), stays.alias("kept"), "digest", *PLACE)


def _lanes(level: Column) -> Column:
    return F.greatest(F.pow(F.lit(float(LANE_STEP)), level - 1).cast("long"), F.lit(1).cast("long"))


def _differing(rows: DataFrame, located_docs: DataFrame, classes: DataFrame, digest: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame]:
    """The texts of groups of several rows, and the digests that stand for different texts.

    What a row is (level of its group's size, and whether it stays) comes back by its place, so the rest of the texts isn't read.
    """
    level = 1 + F.greatest(F.lit(0), F.ceil(F.log(F.col("n") / LANE_ROWS) / math.log(LANE_STEP))).cast("int")
    several = rows.join(classes.where("n > 1").select("digest", level.alias("level"), "best"), "digest")
    stays = ((F.col("best.__file") == F.col("__file")) & (F.col("best.__row") == F.col("__row"))).cast("int")
    texts = numbered_rows(located_docs.select("doc_id", "text", *PLACE), several.select(*PLACE, (2 * F.col("level") + stays).alias("number")), "kind", 31)
    norm = squeezed(text_of())
    texts = texts.select(F.col("doc_id").cast("long").alias("doc_id"), norm.alias("norm"), digest(norm).alias("digest"), F.length(text_of()).alias("n_points"), *PLACE, "kind")
    texts = texts.withColumn("lanes", _lanes(F.floor(F.col("kind") / 2)))
    dealt = texts.where("kind % 2 = 0").withColumn("lane", F.pmod(F.xxhash64(*PLACE), "lanes"))
    keepers = texts.where("kind % 2 = 1").select("digest", F.col("norm").alias("norm_kept"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("lanes") - 1)).alias("lane"))
    differ = dealt.join(keepers, ["digest", "lane"]).where("norm <> norm_kept").select("digest").distinct()
    return texts.drop("kind", "lanes"), written(differ)


def exact_groups(docs: DataFrame, in_snapshot: Column, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, digest, PLACE``, one row for each row of ``docs``.

    ``in_snapshot`` tells the rows of the snapshot from those of the new batch; null counts as new. ``digest`` may be
    any function of the normalised text: texts with the same digest but different bytes are told apart in the end.
    """
    flagged = located(docs.select("doc_id", "text", F.coalesce(in_snapshot, F.lit(False)).alias("old")))
    narrow = flagged.select(F.col("doc_id").cast("long").alias("doc_id"), digest(squeezed(text_of())).alias("digest"), F.length(text_of()).alias("n_points"), "old", *PLACE)
    rows = written(narrow)
    path = fresh_path(docs.sparkSession)
    write_snapshot(_classes(rows.where("old"), "digest"), path)
    snapshot = docs.sparkSession.read.parquet(f"{path}/classes").select("digest", "n", "best")
    batch = written(_classes(rows.where("NOT old"), "digest"))
    hits = written(known_digests(batch, path))
    found = batch.join(hits, "digest", "left_semi").select("digest", F.col("n").alias("n_new"), F.col("best").alias("best_new"))
    met = written(snapshot.join(found, "digest").select("digest", (F.col("n") + F.col("n_new")).alias("n"), F.least("best", "best_new").alias("best")))
    apart = snapshot.unionByName(batch).join(met.select("digest"), "digest", "left_anti")
    classes = written(met.unionByName(apart))

    texts, differ = _differing(rows, flagged, classes, digest)
    if differ.isEmpty():
        return _answer(rows, classes, ["digest"])
    plain = _answer(rows.join(differ, "digest", "left_anti"), classes, ["digest"])
    mixed = texts.join(differ, "digest", "left_semi")
    return plain.unionByName(_answer(mixed, _classes(mixed, "digest", "norm"), ["digest", "norm"]))


def without_copies(docs: DataFrame, in_snapshot: Column) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; they are filtered where they are."""
    columns = docs.columns
    rows = located(docs.withColumn("__m_old", in_snapshot))
    stays = exact_groups(rows, F.col("__m_old")).where("kept")
    return kept(rows, stays).select(*[F.col(f"`{c}`") for c in columns])
