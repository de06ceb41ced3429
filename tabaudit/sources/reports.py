"""Sinks: report tables, payload hand-off, progress log."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_report(df: DataFrame, path: str, only_if_any: bool = False) -> bool:
    """Write one report table; with ``only_if_any`` an empty table leaves no trace."""
    if only_if_any and df.isEmpty():
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def write_csv(df: DataFrame, path: str, only_if_any: bool = True) -> bool:
    """CSV export with the quoting that :func:`tabaudit.sources.tables.read_ready_csv` reads back."""
    if only_if_any and df.isEmpty():
        return False
    df.write.mode("overwrite").csv(path, header=True, quote='"', escape='"')
    return True


def write_reports(tables: dict[str, DataFrame], folder: str, only_if_any: tuple[str, ...] = ()) -> list[str]:
    """Write named tables below one folder; returns the names that were written."""
    return [name for name, df in tables.items() if write_report(df, f"{folder}/{name}", name in only_if_any)]


def write_routed(routed: DataFrame, path: str) -> None:
    """Ready and review rows in one pass, one folder per decision."""
    routed.write.mode("overwrite").partitionBy("Load_Decision").parquet(path)


def write_payloads(documents: DataFrame, path: str) -> None:
    """Payload documents as JSON lines for delivery. A payload document is the unit that is spread over files."""
    documents.repartition("target_id", "old_id", "chunk").write.mode("overwrite").json(path)


DOCUMENT_KEY = ["target_id", "old_id", "tahun_data", "chunk"]


def _runs(spark: SparkSession, path: str) -> list[str]:
    """The runs in the manifest, one short line each; a folder that doesn't exist yet has none."""
    try:
        return sorted(row[0] for row in spark.read.schema("run string, n_documents long").parquet(f"{path}/manifest").select("run").collect())
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return []


def hand_over(documents: DataFrame, path: str, run: str | None = None) -> int:
    """Hand over the documents that no earlier run has handed over; returns how many went out.

    A run writes its documents to a folder of its own, and then its one line of the manifest. Only the manifest counts: a run
    that stops in between has handed nothing over, its folder is never read, and the next run sends its documents again. So
    there are no gaps and no doubles, whenever a run stops. Documents are told apart by their keys, not by their bodies.
    """
    spark, run = documents.sparkSession, run or uuid.uuid4().hex
    due = documents.withColumn("tahun_data", F.col("body.tahun_data").cast("int")).withColumn("chunk", F.col("chunk").cast("long"))
    if _runs(spark, path):
        sent = handed_over(spark, path).select(*[F.col(name).alias(f"_{name}") for name in DOCUMENT_KEY])
        match = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in DOCUMENT_KEY]
        due = due.join(sent, match[0] & match[1] & match[2] & match[3], "left_anti")
    due.repartition(*DOCUMENT_KEY).write.mode("error").parquet(f"{path}/documents/run={run}")
    n = spark.read.parquet(f"{path}/documents/run={run}").count()
    spark.createDataFrame([(run, n)], "run string, n_documents long").coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return n


def handed_over(spark: SparkSession, path: str) -> DataFrame:
    """The documents that are out, each once, with their ``run``: those of the runs in the manifest."""
    runs = _runs(spark, path)
    if not runs:
        raise ValueError(f"nothing was handed over at {path}")
    return spark.read.option("basePath", f"{path}/documents").parquet(*[f"{path}/documents/run={run}" for run in runs])


def write_failed(failed: DataFrame, path: str, batch_number: int) -> bool:
    """Failed payloads of a batch, in a folder of their own."""
    if failed.isEmpty():
        return False
    failed.write.mode("overwrite").json(f"{path}/batch_number={batch_number}")
    return True


def append_progress(lines: DataFrame, path: str) -> None:
    lines.write.mode("append").parquet(path)
