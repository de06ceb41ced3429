"""Value cleaning on the row map, with counts of what changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabaudit.functions.text import format_region_code, is_undotted_code, squash_whitespace, strip

REGION_COLUMN = "kode_wilayah"


def clean_whitespace(records: DataFrame) -> DataFrame:
    """Strings without white space too much; numbers and nested values aren't touched."""
    if "bare" not in records.columns:
        return records.withColumn("row", F.transform_values("row", lambda k, v: squash_whitespace(v)))
    return records.withColumn("row", F.transform_values("row", lambda k, v: F.when(F.array_contains("bare", k), v).otherwise(squash_whitespace(v))))


def fix_region_codes(records: DataFrame, column: str = REGION_COLUMN) -> DataFrame:
    """Dotted form of the digits-only codes in one column. A number that gets dots is a string from then on."""
    fixed = F.transform_values("row", lambda k, v: F.when(k == column, format_region_code(v)).otherwise(v))
    if "bare" in records.columns:
        dotted = F.array_contains("bare", column) & is_undotted_code(F.col("row")[column])
        records = records.withColumn("bare", F.when(dotted, F.array_remove("bare", column)).otherwise(F.col("bare")))
    return records.withColumn("row", F.when(F.map_contains_key("row", column), fixed).otherwise(F.col("row")))


def change_log(records: DataFrame, region_column: str = REGION_COLUMN) -> DataFrame:
    """``(dataset_id, action, target, n_changed, n_lossy)`` for whitespace and region-code cleaning.

    ``n_lossy`` counts codes of five or seven digits, whose last digit the dotted form cannot hold.
    """
    cells = records.select("dataset_id", F.explode("row").alias("target", "before"))
    squashed = squash_whitespace(F.col("before"))
    cells = cells.withColumn("squashed", squashed)
    is_region = F.col("target") == region_column
    region_fixed = is_region & (format_region_code(F.col("squashed")) != F.col("squashed"))
    lossy = region_fixed & F.length(strip(F.col("squashed"))).isin(5, 7)
    counted = cells.groupBy("dataset_id", "target").agg(
        F.count_if(F.col("before") != F.col("squashed")).alias("whitespace_strip"),
        F.count_if(region_fixed).alias("kode_wilayah_fix"),
        F.count_if(lossy).alias("lossy"),
    )
    stacked = counted.select(
        "dataset_id",
        "target",
        F.inline(
            F.array(
                F.struct(F.lit("whitespace_strip").alias("action"), F.col("whitespace_strip").alias("n_changed"), F.lit(0).cast("long").alias("n_lossy")),
                F.struct(F.lit("kode_wilayah_fix").alias("action"), F.col("kode_wilayah_fix").alias("n_changed"), F.col("lossy").alias("n_lossy")),
            )
        ),
    )
    return stacked.where(F.col("n_changed") > 0).select("dataset_id", "action", "target", "n_changed", "n_lossy")
