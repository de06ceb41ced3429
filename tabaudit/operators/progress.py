"""Migration progress: an append-only log, and the latest state per target read from it.

A batch appends its lines; nothing is rewritten. The latest line of a target is an aggregate, so a target with a
long history costs no more than the rows read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabaudit.operators.payloads import DONE, FAILED, PARTIAL

PROGRESS_SCHEMA = (
    "new_id string, new_title string, old_id string, status string, rows_sent bigint, "
    "migrated_at timestamp, batch_number int, seq bigint"
)


def latest(log: DataFrame) -> DataFrame:
    """Last line of every ``new_id`` by batch and position."""
    others = [name for name in log.columns if name != "new_id"]
    order = F.struct(F.coalesce("batch_number", F.lit(0)), F.coalesce("seq", F.lit(0)))
    last = log.groupBy("new_id").agg(F.max_by(F.struct(*others), order).alias("last"))
    return last.select("new_id", *[F.col(f"last.{name}").alias(name) for name in others])


def done_ids(log: DataFrame) -> DataFrame:
    return latest(log).where(F.col("status") == DONE).select("new_id")


def next_batch(log: DataFrame) -> DataFrame:
    return log.agg((F.coalesce(F.max("batch_number"), F.lit(0)) + 1).cast("int").alias("next_batch"))


def progress_summary(log: DataFrame) -> DataFrame:
    status = F.col("status")
    return latest(log).agg(
        F.count(F.lit(1)).alias("total_recorded"),
        F.count_if(status == DONE).alias("done"),
        F.count_if(status == PARTIAL).alias("partial"),
        F.count_if(status == FAILED).alias("failed"),
    )


def remaining_catalog(catalog: DataFrame, log: DataFrame) -> DataFrame:
    """Targets that are not done yet."""
    return catalog.join(done_ids(log).withColumnRenamed("new_id", "id"), "id", "left_anti").select(*catalog.columns)


def catalog_status(catalog: DataFrame, log: DataFrame) -> DataFrame:
    """``id, judul, status``: DONE, PARTIAL, FAILED, or NEW for targets without a line."""
    state = latest(log).select(F.col("new_id").alias("id"), F.upper("status").alias("status"))
    return catalog.join(state, "id", "left").select("id", "judul", F.coalesce("status", F.lit("NEW")).alias("status"))


def overall_progress(catalog: DataFrame, log: DataFrame) -> DataFrame:
    """Targets in the catalog, finished ones, and the rest."""
    total, done = F.count(F.lit(1)), F.count_if(F.col("status") == "DONE")
    return catalog_status(catalog, log).agg(total.alias("n_targets"), done.alias("n_done"), (total - done).alias("n_remaining"))


def progress_lines(fold: DataFrame, catalog: DataFrame, batch_number: int) -> DataFrame:
    """Log lines of a finished batch."""
    titles = catalog.select(F.col("id").alias("target_id"), F.col("judul").alias("new_title"))
    return fold.join(titles, "target_id", "left").select(
        F.col("target_id").cast("string").alias("new_id"),
        F.coalesce("new_title", F.lit("unknown")).alias("new_title"),
        "old_id",
        "status",
        F.col("rows_sent").cast("long").alias("rows_sent"),
        F.date_trunc("second", F.current_timestamp()).alias("migrated_at"),
        F.lit(batch_number).cast("int").alias("batch_number"),
        F.lit(0).cast("long").alias("seq"),
    )
