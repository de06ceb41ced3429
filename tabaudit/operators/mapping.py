"""Best-match mapping of old datasets to target datasets by title."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabaudit.functions.text import sort_tokens
from tabaudit.operators.fuzzy_join import check_threshold, similar_pairs
from tabaudit.operators.tiles import best_matches

def old_titles(ready: DataFrame) -> DataFrame:
    """Distinct ``(old_id, old_title, file_order, tokens)`` of the ready rows."""
    missing = [name for name in ("Dataset_Id", "Judul_Tabel") if name not in ready.columns]
    if missing:
        raise ValueError(f"ready rows miss required columns: {missing}")
    order = F.min("row_no") if "row_no" in ready.columns else F.lit(None).cast("long")
    distinct = ready.groupBy(F.col("Dataset_Id").alias("old_id"), F.col("Judul_Tabel").alias("old_title")).agg(order.alias("file_order"))
    return distinct.withColumn("tokens", sort_tokens(F.coalesce("old_title", F.lit(""))))


def _targets(catalog: DataFrame) -> DataFrame:
    """Distinct target titles; equal titles are represented by the first in catalog order."""
    return (
        catalog.withColumn("tokens", sort_tokens(F.coalesce("judul", F.lit(""))))
        .groupBy("tokens")
        .agg(F.min(F.struct("ord", "id", "judul")).alias("target"))
    )


def best_above(old: DataFrame, targets: DataFrame, threshold: int) -> DataFrame:
    """``(tokens, target, score)``: best target of every distinct old title that has one at the threshold."""
    left = old.select(F.struct(F.lit(0).alias("side"), F.md5("tokens").alias("t")).alias("sid"), F.lit(0).alias("side"), F.col("tokens").alias("text")).distinct()
    right = targets.select(F.struct(F.lit(1).alias("side"), F.md5("tokens").alias("t")).alias("sid"), F.lit(1).alias("side"), F.col("tokens").alias("text"))
    strings = left.unionByName(right).withColumn("block", F.lit(0))
    scored = similar_pairs(strings, threshold, two_sided=True).select(
        F.col("a_text").alias("old_tokens"), F.col("b_text").alias("tokens"), "score"
    )
    # Titles without tokens are equal to each other, and similar to nothing else.
    empty = old.where("tokens = ''").select(F.col("tokens").alias("old_tokens"), "tokens", F.lit(100).cast(scored.schema["score"].dataType).alias("score")).distinct()
    return (
        scored.unionByName(empty).join(targets, "tokens")
        .groupBy(F.col("old_tokens").alias("tokens"))
        .agg(F.max_by(F.struct("target", "score"), F.struct(F.col("score"), -F.col("target.ord"))).alias("best"))
        .select("tokens", F.col("best.target").alias("target"), F.col("best.score").alias("score"))
    )


def automap(ready: DataFrame, catalog: DataFrame, threshold: int = 85, done: DataFrame | None = None) -> DataFrame:
    """``old_id, old_title, new_id, new_title, match_score, file_order`` for titles that reach the threshold.

    ``done(new_id)`` removes finished targets first. ``threshold`` 0 is treated as 1: a mapping needs some match.
    """
    check_threshold(threshold)
    old, targets = old_titles(ready), _targets(_open_targets(catalog, done))
    best = best_above(old, targets, max(threshold, 1))
    return old.join(best, "tokens").select(
        "old_id",
        "old_title",
        F.col("target.id").alias("new_id"),
        F.col("target.judul").alias("new_title"),
        F.col("score").alias("match_score"),
        "file_order",
    )


def _open_targets(catalog: DataFrame, done: DataFrame | None) -> DataFrame:
    if done is None:
        return catalog
    return catalog.join(done.select(F.col("new_id").alias("id")), "id", "left_anti")


def automap_unmapped(
    ready: DataFrame, catalog: DataFrame, mapping: DataFrame, done: DataFrame | None = None
) -> DataFrame:
    """Old titles without a mapping, with the best title found below the threshold and its score.

    A best match without a lower limit has no join key. Targets lie in tiles of bounded size under a tree of bounds; a title meets
    the most promising tile first, and then only tiles that can still beat what it has found.
    """
    old, targets = old_titles(ready), _targets(_open_targets(catalog, done))
    rest = old.join(mapping.select("old_id", "old_title").distinct(), ["old_id", "old_title"], "left_anti")
    right = targets.select(F.col("tokens").alias("text"), F.col("target.ord").alias("ord"))
    best = best_matches(rest.select(F.col("tokens").alias("text")), right).join(targets.withColumnRenamed("tokens", "best_text"), "best_text")
    best = best.select(F.col("text").alias("tokens"), F.col("target.judul").alias("judul"), "score")
    return rest.join(best, "tokens", "left").select(
        "old_id",
        "old_title",
        F.col("judul").alias("best_new_title_found"),
        F.coalesce("score", F.lit(0)).alias("highest_score"),
    )


def collisions(mapping: DataFrame) -> DataFrame:
    """Mapping lines whose target is also the target of another line."""
    shared = mapping.groupBy("new_id").agg(F.count(F.lit(1)).alias("n_old")).where("n_old > 1")
    return mapping.join(shared, "new_id").select(*mapping.columns, "n_old")


def with_best_is_done(mapping: DataFrame, ready: DataFrame, catalog: DataFrame, done: DataFrame, threshold: int = 85) -> DataFrame:
    """Mark mappings whose best target in the whole catalog is finished already."""
    overall = automap(ready, catalog, threshold).select("old_id", "old_title", F.col("new_id").alias("best_id"))
    finished = done.select(F.col("new_id").alias("best_id"), F.lit(True).alias("best_is_done")).distinct()
    return (
        mapping.join(overall, ["old_id", "old_title"], "left")
        .join(finished, "best_id", "left")
        .select(*mapping.columns, F.coalesce("best_is_done", F.lit(False)).alias("best_is_done"))
    )
