"""Ready rows, alias configuration and the progress log."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabaudit.operators.progress import PROGRESS_SCHEMA

# The contract of the ready file.
READY_COLUMNS = ["Dataset_Id", "Judul_Tabel", "Row_Data_JSON"]


def check_ready(ready: DataFrame) -> DataFrame:
    missing = [name for name in READY_COLUMNS if name not in ready.columns]
    if missing:
        raise ValueError(f"ready rows miss required columns: {missing}")
    return ready


def read_ready_csv(spark: SparkSession, path: str, line_breaks: bool = True) -> DataFrame:
    """Ready rows from CSV with quoted JSON; every column stays text.

    Cells may have line breaks, so a file is read by one task; ready rows of any size belong in Parquet. Only where no cell
    has a line break, ``line_breaks=False`` lets many tasks read a large file; it would tear such cells apart.

    Rows of a plain CSV file have no number. Where the export wrote ``row_no`` it is used; otherwise rows are
    numbered by their position, which :func:`monotonically_increasing_id` keeps within each file.
    """
    ready = check_ready(spark.read.csv(path, header=True, quote='"', escape='"', multiLine=line_breaks))
    if "row_no" in ready.columns:
        return ready.withColumn("row_no", F.col("row_no").cast("long"))
    return ready.withColumn("row_no", F.monotonically_increasing_id())


def read_ready(spark: SparkSession, path: str) -> DataFrame:
    return check_ready(spark.read.parquet(path))


def read_aliases(spark: SparkSession, path: str) -> tuple[dict[str, str], int | None]:
    """Column aliases and fuzzy threshold from the JSON configuration; absent or unreadable files give none."""
    try:
        text = spark.read.text(path, wholetext=True).first()
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return {}, None
    return parse_aliases(text[0] if text else "")


def parse_aliases(text: str) -> tuple[dict[str, str], int | None]:
    try:
        config = json.loads(text)
    except ValueError:
        return {}, None
    aliases = {old.strip().lower(): new.strip().lower() for old, new in config.get("column_aliases", {}).items()}
    threshold = config.get("fuzzy_threshold")
    return aliases, None if threshold is None else int(threshold)


def complete_progress(log: DataFrame) -> DataFrame:
    """Progress lines of any age in today's columns; what an old file lacks is NULL."""
    empty = log.sparkSession.createDataFrame([], PROGRESS_SCHEMA)
    known = log.select(*[name for name in empty.columns if name in log.columns])
    types = dict(empty.dtypes)
    known = known.select(*[F.col(name).cast(types[name]).alias(name) for name in known.columns])
    return empty.unionByName(known, allowMissingColumns=True)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The progress log; a folder that does not exist yet is an empty log."""
    try:
        log = spark.read.option("mergeSchema", "true").parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], PROGRESS_SCHEMA)
    return complete_progress(log)
