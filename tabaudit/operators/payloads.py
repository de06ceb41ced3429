"""From packed ready rows to one payload per (dataset, year), and back from delivery outcomes to statuses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabaudit.functions.text import parse_year
from tabaudit.operators.ranking import numbered
from tabaudit.operators.schema import apply_plan

YEAR = "tahun"
DONE, PARTIAL, FAILED = "done", "partial", "failed"


def unpack_rows(ready: DataFrame) -> DataFrame:
    """``(dataset_id, row_no, row)`` from ready rows; ``row`` is NULL where the document cannot be read.

    Ready rows carry ``row_no``; for files without it, see :func:`tabaudit.sources.tables.read_ready_csv`.
    """
    row = F.from_json("Row_Data_JSON", "map<string,string>")
    # The JSON reader hands a bare NaN over with quotes around it; it means "no value". The text NaN is data.
    row = F.transform_values(row, lambda k, v: F.when(v != '"NaN"', v))
    return ready.select(F.col("Dataset_Id").alias("dataset_id"), "row_no", row.alias("row"))


# A whole string, or a bare NaN outside of strings.
STRING_OR_NAN = r'("(?:[^"\\]|\\.)*+")|\bNaN\b'


def _without_bare_nan(text: Column) -> Column:
    """JSON text with ``null`` for each bare NaN. JSON allows no raw U+0001, so it can mark what was matched."""
    marked = F.regexp_replace(text, STRING_OR_NAN, "$1\u0001")
    return F.replace(F.replace(marked, F.lit('"\u0001'), F.lit('"')), F.lit("\u0001"), F.lit("null"))


def unpack_typed(ready: DataFrame) -> DataFrame:
    """Like :func:`unpack_rows` with every value as a VARIANT: numbers, booleans and nested values keep type and value."""
    text = F.col("Row_Data_JSON")
    text = F.when(F.contains(text, F.lit("NaN")), _without_bare_nan(text)).otherwise(text)
    return ready.select(F.col("Dataset_Id").alias("dataset_id"), "row_no", F.from_json(text, "map<string,variant>").alias("row"))


def latest_mapping(mapping: DataFrame) -> DataFrame:
    """One target per old id; of several mapped titles the one that comes last in the ready rows counts."""
    order = [F.col(name) for name in ("file_order", "old_title", "new_id") if name in mapping.columns]
    return mapping.groupBy(F.col("old_id").alias("dataset_id")).agg(F.max_by("new_id", F.struct(*order)).alias("target_id"))


def classify_rows(ready: DataFrame, mapping: DataFrame, rename_plan: DataFrame | None = None) -> DataFrame:
    """Every ready row with its target, year and, if it cannot be delivered, the reason."""
    rows = unpack_typed(ready)
    if rename_plan is not None:
        rows = apply_plan(rows, rename_plan)
    year_text = F.try_variant_get(F.col("row")[YEAR], "$", "string")
    joined = rows.join(latest_mapping(mapping), "dataset_id", "left").withColumn("tahun_data", parse_year(year_text))
    reason = (
        F.when(F.col("target_id").isNull(), "unmapped_dataset")
        .when(F.col("row").isNull(), "invalid_json")
        .when(year_text.isNull(), "missing_year")
        .when(F.col("tahun_data").isNull(), "invalid_year")
    )
    return joined.withColumn("reject_reason", reason)


def payload_rows(classified: DataFrame) -> DataFrame:
    """Deliverable rows: ``target_id, old_id, tahun_data, row_no, record`` with the year lifted out of the record."""
    return classified.where(F.col("reject_reason").isNull()).select(
        "target_id",
        F.col("dataset_id").alias("old_id"),
        "tahun_data",
        "row_no",
        F.map_filter("row", lambda k, v: k != YEAR).alias("record"),
    )


def payload_rejects(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("reject_reason").isNotNull()).select(
        F.col("dataset_id").alias("old_id"), "row_no", "reject_reason"
    )


def payload_groups(rows: DataFrame) -> DataFrame:
    """One line per payload with its size and row range; no rows are gathered."""
    return rows.groupBy("target_id", "old_id", "tahun_data").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("row_no").alias("first_row"), F.max("row_no").alias("last_row")
    )


PAYLOAD = ["target_id", "old_id", "tahun_data"]


def payload_documents(rows: DataFrame, rows_per_document: int | None) -> DataFrame:
    """Payloads as documents: ``target_id, old_id, chunk, body(tahun_data, data)`` with records in file order.

    The rows of a payload are counted in file order and cut every ``rows_per_document`` rows, whatever its size; gaps in
    ``row_no`` don't matter. With None each payload is one document, so its size has no bound then.
    """
    if rows_per_document is None:
        placed = rows.withColumn("chunk", F.lit(0).cast("long"))
    else:
        ranked = numbered(rows, "_rank", *PAYLOAD, "row_no")
        first = ranked.groupBy(*PAYLOAD).agg(F.min("_rank").alias("_first"))
        placed = ranked.join(first, PAYLOAD).withColumn("chunk", F.floor((F.col("_rank") - F.col("_first")) / rows_per_document)).drop("_rank", "_first")
    record = F.struct("row_no", F.to_json("record").alias("json"))
    gathered = placed.groupBy("target_id", "old_id", "tahun_data", "chunk").agg(F.sort_array(F.collect_list(record)).alias("rows"))
    data = F.transform("rows", lambda r: F.from_json(r["json"], "map<string,variant>"))
    return gathered.select("target_id", "old_id", "chunk", F.struct("tahun_data", data.alias("data")).alias("body"))


def outcome_fold(outcomes: DataFrame) -> DataFrame:
    """Delivery outcomes ``(target_id, old_id, tahun_data, chunk, ok, n_rows)`` to one status per target.

    Each document has an outcome of its own, so a payload of which one chunk failed is ``partial``.
    """
    won, lost = F.count_if("ok"), F.count_if(~F.col("ok"))
    return outcomes.groupBy("target_id").agg(
        F.min("old_id").alias("old_id"),
        (F.min("old_id") != F.max("old_id")).alias("collision"),
        F.when(lost == 0, DONE).when(won == 0, FAILED).otherwise(PARTIAL).alias("status"),
        won.alias("n_ok"),
        lost.alias("n_failed"),
        F.sum(F.when(F.col("ok"), F.col("n_rows")).otherwise(0)).alias("rows_sent"),
    )


def failed_payloads(documents: DataFrame, outcomes: DataFrame) -> DataFrame:
    """``target_id, old_id, tahun_data, chunk, body`` of the documents whose delivery failed: all that a resend needs."""
    keys = [*PAYLOAD, "chunk"]
    sent = documents.select("target_id", "old_id", F.col("body.tahun_data").alias("tahun_data"), "chunk", "body")
    return sent.join(outcomes.where(~F.col("ok")).select(*keys).distinct(), keys, "left_semi").select(*keys, "body")


def batch_totals(fold: DataFrame, batch_number: int | None = None) -> DataFrame:
    """Targets per status in this batch."""
    totals = fold.agg(
        F.count_if(F.col("status") == DONE).alias("done"),
        F.count_if(F.col("status") == PARTIAL).alias("partial"),
        F.count_if(F.col("status") == FAILED).alias("failed"),
        F.coalesce(F.sum("rows_sent"), F.lit(0)).alias("rows_sent"),
    )
    return totals if batch_number is None else totals.withColumn("batch_number", F.lit(batch_number))
