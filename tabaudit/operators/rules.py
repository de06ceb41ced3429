"""Row rules. They add ``migration_status`` and ``flag_reason`` beside the row map.

Every rule is a column expression over one row, so a chain of rules is one projection without a shuffle; only the
duplicate rule needs to look at other rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabaudit.functions.text import is_blank, parse_number

PENDING, READY, FLAGGED = "pending", "ready", "flagged"
AUDIT_COLUMNS = ("migration_status", "flag_reason")


def start_audit(records: DataFrame) -> DataFrame:
    """Take status and reason from the row where a dataset brings them, else start as pending."""
    if all(name in records.columns for name in AUDIT_COLUMNS):
        status, reason = F.col("migration_status"), F.col("flag_reason")
    else:
        status, reason = F.col("row")["migration_status"], F.col("row")["flag_reason"]
    brought = F.map_contains_key("row", AUDIT_COLUMNS[0]) | F.map_contains_key("row", AUDIT_COLUMNS[1])
    without = F.when(brought, F.map_filter("row", lambda k, v: ~k.isin(*AUDIT_COLUMNS))).otherwise(F.col("row"))
    return (
        records.withColumn("migration_status", F.coalesce(F.lower(status), F.lit(PENDING)))
        .withColumn("flag_reason", F.coalesce(reason, F.lit("")))
        .withColumn("row", without)
    )


def add_reason(reason: Column, condition: Column, text: str | Column) -> Column:
    """Append ``text`` to the reasons so far, separated by a bar."""
    addition = F.lit(text) if isinstance(text, str) else text
    return F.concat_ws(" | ", F.nullif(reason, F.lit("")), F.when(condition, addition))


def flag_where(audited: DataFrame, condition: Column, reason: str) -> DataFrame:
    """Custom rule: flag the rows where the condition holds (NULL counts as false)."""
    if not isinstance(condition, Column):
        raise TypeError("condition must be a Column")
    hit = F.coalesce(condition, F.lit(False))
    return audited.withColumns(
        {
            "flag_reason": add_reason(F.col("flag_reason"), hit, reason),
            "migration_status": F.when(hit, F.lit(FLAGGED)).otherwise(F.col("migration_status")),
        }
    )


def flag_missing(audited: DataFrame, required: Sequence[str], columns: DataFrame | None = None) -> DataFrame:
    """Flag rows without a value in a required column. Columns a dataset does not have at all are a schema issue
    (:func:`tabaudit.operators.schema.schema_issues`), not a row flag.

    Which columns a dataset has is told by ``columns``, or without it by ``present`` of each row, as
    :func:`tabaudit.operators.schema.apply_plan` leaves it; ``present`` is dropped.
    """
    if columns is None:
        joined = audited.withColumnRenamed("present", "_present")
    else:
        present = columns.where(F.col("col").isin(list(required))).groupBy("dataset_id").agg(F.collect_set("col").alias("_present"))
        joined = audited.join(present, "dataset_id", "left")
    missing = {}
    for name in required:
        value = F.col("row")[name]
        blank = value.isNull() | is_blank(value)
        missing[name] = F.coalesce(F.array_contains("_present", name), F.lit(False)) & blank
    reasons = [F.when(hit, F.lit(f"Missing '{name}'")) for name, hit in missing.items()]
    any_missing = F.lit(False)
    for hit in missing.values():
        any_missing = any_missing | hit
    return joined.withColumns(
        {
            "flag_reason": F.concat_ws(" | ", F.nullif(F.col("flag_reason"), F.lit("")), *reasons),
            "migration_status": F.when(any_missing, F.lit(FLAGGED)).otherwise(F.col("migration_status")),
        }
    ).drop("_present")


def flag_duplicates(audited: DataFrame, subset: Sequence[str], columns: DataFrame) -> DataFrame:
    """Flag every row whose subset values occur more than once in its dataset; NULLs are equal.

    Datasets lacking a subset column are left alone. Counting is a partial aggregate, so a hot value never has to
    sit in one task; the repeated keys are joined back.
    """
    subset = list(subset)
    label = "Duplicate subset: [" + ", ".join(f"'{name}'" for name in subset) + "]"
    complete = (
        columns.where(F.col("col").isin(subset)).groupBy("dataset_id").agg(F.countDistinct("col").alias("n")).where(F.col("n") == len(subset))
    )
    keyed = audited.withColumn("_key", F.to_json(F.array(*[F.col("row")[name] for name in subset])))
    repeated = (
        keyed.groupBy("dataset_id", "_key")
        .agg(F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .join(complete.select("dataset_id"), "dataset_id", "left_semi")
    )
    joined = keyed.join(repeated, ["dataset_id", "_key"], "left")
    return flag_where(joined, F.col("_n").isNotNull(), label).select(*audited.columns)


def duplicate_check_issues(columns: DataFrame, subset: Sequence[str]) -> DataFrame:
    """``(dataset_id, issue)`` for datasets where the duplicate rule cannot run."""
    subset = list(subset)
    found = columns.groupBy("dataset_id").agg(*[F.max(F.col("col") == name).alias(f"has_{i}") for i, name in enumerate(subset)])
    listed = F.concat_ws(", ", *[F.when(~F.col(f"has_{i}"), F.lit(f"'{name}'")) for i, name in enumerate(subset)])
    return found.where(listed != "").select(
        "dataset_id", F.concat(F.lit("Duplicate check skipped, missing columns: ["), listed, F.lit("]")).alias("issue")
    )


def warn_year(audited: DataFrame, year_min: int = 2000, year_max: int = 2025, column: str = "tahun") -> DataFrame:
    """Append a warning to rows whose year is out of range; the status stays."""
    year = parse_number(F.col("row")[column])
    outside = (year < year_min) | (year > year_max)
    text = f"WARNING: tahun di luar range [{year_min}-{year_max}]"
    return audited.withColumn("flag_reason", add_reason(F.col("flag_reason"), outside, text))


def mark_ready(audited: DataFrame) -> DataFrame:
    """Rows no rule flagged become ready."""
    status = F.col("migration_status")
    return audited.withColumn("migration_status", F.when(status == PENDING, F.lit(READY)).otherwise(status))
