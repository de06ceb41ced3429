"""Load gate, per-dataset quality and decision, and routing of rows to the ready and review outputs."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabaudit.functions.text import typed_json
from tabaudit.operators.ranking import numbered
from tabaudit.operators.rules import FLAGGED

READY_FOR_LOAD, REVIEW, SKIPPED = "ready_for_load", "manager_review_required", "skipped"


def allowed_statuses(statuses: Iterable[str] | None = None) -> list[str]:
    wanted = {str(status).strip().lower() for status in (statuses if statuses is not None else ["ready"])} - {""}
    if not wanted:
        raise ValueError("allowed statuses must contain at least one value")
    return sorted(wanted)


def _is_allowed(audited: DataFrame, statuses: Iterable[str] | None) -> Column:
    if "migration_status" not in audited.columns:
        raise ValueError("rows must have a 'migration_status' column")
    return F.coalesce(F.lower("migration_status").isin(allowed_statuses(statuses)), F.lit(False))


def gate_select(audited: DataFrame, statuses: Iterable[str] | None = None) -> DataFrame:
    """Rows that may be loaded.

    The rows are counted on their way to the filter (``observe``). The optimiser doesn't move a filter below that; else it would put the
    whole chain of rules in place of each mention of the status, and work it out again for each.
    """
    allowed = _is_allowed(audited, statuses)
    return audited.observe(f"gate-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("total_rows")).where(allowed)


def gate_summary(audited: DataFrame, statuses: Iterable[str] | None = None) -> DataFrame:
    total, loadable = F.count(F.lit(1)), F.count_if(_is_allowed(audited, statuses))
    return audited.agg(total.alias("total_rows"), loadable.alias("loadable_rows"), (total - loadable).alias("blocked_rows"))


def catalog_head(catalog: DataFrame, max_datasets: int | None) -> DataFrame:
    """First datasets in catalog order: the assessment budget of a run; None means all."""
    if max_datasets is None:
        return catalog
    return numbered(catalog, "_rank", "ord").where(F.col("_rank") < max_datasets).drop("_rank")


def quality_report(
    catalog: DataFrame,
    audited: DataFrame,
    issues: DataFrame,
    suspects: DataFrame | None = None,
    fetch_status: DataFrame | None = None,
    statuses: Iterable[str] | None = None,
) -> DataFrame:
    """One row per catalog dataset: counts, schema issues, suspect mark and load decision.

    All datasets are counted by one aggregate over their rows. ``fetch_status(dataset_id, ok, message)`` names the
    datasets that could not be read; those and datasets without rows are reported as skipped.
    """
    counts = audited.groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("migration_status") == FLAGGED).alias("n_flagged"),
        F.count_if(_is_allowed(audited, statuses)).alias("n_loadable"),
    )
    report = catalog.select(F.col("id").alias("dataset_id"), "judul").join(counts, "dataset_id", "left").join(issues, "dataset_id", "left")
    if suspects is None:
        report = report.withColumn("suspect", F.lit(False))
    else:
        marked = suspects.select("dataset_id", F.lit(True).alias("suspect"))
        report = report.join(marked, "dataset_id", "left").withColumn("suspect", F.coalesce("suspect", F.lit(False)))
    if fetch_status is None:
        report = report.withColumn("fetch_error", F.lit(None).cast("string"))
    else:
        failed = fetch_status.where(~F.col("ok")).select("dataset_id", F.coalesce("message", F.lit("")).alias("fetch_error"))
        report = report.join(failed, "dataset_id", "left")
    skip_text = F.when(F.col("fetch_error").isNotNull(), F.concat(F.lit("API Error: "), "fetch_error")).when(
        F.col("n_rows").isNull(), F.lit("Tabel Kosong (0 baris)")
    )

    def counted(name: str) -> Column:
        return F.when(skip_text.isNull(), F.col(name)).otherwise(F.lit(0)).cast("long")

    decision = (
        F.when(skip_text.isNotNull(), SKIPPED)
        .when(F.col("suspect") | (F.col("n_flagged") > 0), REVIEW)
        .otherwise(READY_FOR_LOAD)
    )
    return report.select(
        F.col("dataset_id").alias("Dataset_Id"),
        F.col("judul").alias("Judul_Tabel"),
        F.col("suspect").alias("Catalog_Suspect"),
        counted("n_rows").alias("Total_Rows"),
        counted("n_flagged").alias("Baris_Bermasalah"),
        counted("n_loadable").alias("Baris_Siap_Load"),
        F.coalesce(skip_text, F.col("Schema_Issues"), F.lit("")).alias("Schema_Issues"),
        decision.alias("Load_Decision"),
    )


def load_summary(quality: DataFrame) -> DataFrame:
    """Totals over the quality report; no row when nothing was assessed."""
    return quality.agg(
        F.count(F.lit(1)).alias("Total_Dataset_Dinilai"),
        F.sum("Total_Rows").alias("Total_Baris_Dinilai"),
        F.sum("Baris_Siap_Load").alias("Total_Baris_Siap_Load"),
        F.sum("Baris_Bermasalah").alias("Total_Baris_Bermasalah"),
    ).where(F.col("Total_Dataset_Dinilai") > 0)


def route(audited: DataFrame, quality: DataFrame, statuses: Iterable[str] | None = None) -> DataFrame:
    """Every routed row with its ``Load_Decision``: loadable rows of ready datasets, all rows of review datasets.

    One pass over the rows serves both outputs when it is written partitioned by the decision. Values keep the type that they
    had when they were fetched, as far as rows say so (``bare``).
    """
    decisions = quality.where(F.col("Load_Decision") != SKIPPED).select(
        F.col("Dataset_Id").alias("dataset_id"), "Judul_Tabel", "Catalog_Suspect", "Load_Decision"
    )
    document = typed_json(F.col("row"), F.col("bare")) if "bare" in audited.columns else F.to_json("row")
    kept = (F.col("Load_Decision") == REVIEW) | _is_allowed(audited, statuses)
    return audited.join(decisions, "dataset_id").where(kept).select(
        F.col("dataset_id").alias("Dataset_Id"),
        "Judul_Tabel",
        "Catalog_Suspect",
        "migration_status",
        "flag_reason",
        document.alias("Row_Data_JSON"),
        "row_no",
        "Load_Decision",
    )


def pack_ready(audited: DataFrame, quality: DataFrame, statuses: Iterable[str] | None = None) -> DataFrame:
    """Loadable rows of the datasets that are ready, one JSON document per row."""
    chosen = quality.where(F.col("Load_Decision") == READY_FOR_LOAD)
    return route(audited, chosen, statuses).select("Dataset_Id", "Judul_Tabel", "Row_Data_JSON", "row_no")


def pack_review(audited: DataFrame, quality: DataFrame) -> DataFrame:
    """All rows, good and bad, of the datasets a manager has to look at."""
    return route(audited, quality.where(F.col("Load_Decision") == REVIEW)).drop("Load_Decision")
