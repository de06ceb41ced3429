"""The progress log as numbered additions with snapshots: what is read doesn't grow with history.

An addition is a folder of its own, ``additions/n=<number>``; a snapshot, ``snapshots/n=<number>``, holds the last line of
every target up to that addition. Readers take the newest snapshot and the additions after it. The last line of a
target is a maximum, so this gives every answer that the full log gives, whenever lines of old batches come. Folders count
when Spark has finished them, so whatever stops half-way is never read. Nothing is rewritten or deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabaudit.operators.progress import PROGRESS_SCHEMA, latest
from tabaudit.sources.tables import complete_progress


def _numbers(spark: SparkSession, folder: str, finished: bool = True) -> list[int]:
    """Numbers of the folders ``n=<number>``, a name for each; those that were finished, or all."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    found = [entry.getPath() for entry in files.listStatus(place) if entry.getPath().getName().startswith("n=")]
    done = [path for path in found if not finished or files.exists(spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS"))]
    return sorted(int(path.getName()[2:]) for path in done)


def append(lines: DataFrame, path: str) -> int:
    """Add lines; returns the number of the addition. Two writers at the same time are an error for one of them."""
    number = max(_numbers(lines.sparkSession, f"{path}/additions", finished=False), default=0) + 1
    complete_progress(lines).write.mode("error").parquet(f"{path}/additions/n={number}")
    return number


def folders(spark: SparkSession, path: str) -> list[str]:
    """What has to be read: the newest snapshot, if any, and the additions after it."""
    snapshots = _numbers(spark, f"{path}/snapshots")
    start = snapshots[-1] if snapshots else 0
    return [f"{path}/snapshots/n={start}"] * bool(snapshots) + [f"{path}/additions/n={n}" for n in _numbers(spark, f"{path}/additions") if n > start]


def read(spark: SparkSession, path: str) -> DataFrame:
    """The log, as far as the last line of any target can depend on it. A folder that doesn't exist yet is an empty log."""
    found = folders(spark, path)
    if not found:
        return spark.createDataFrame([], PROGRESS_SCHEMA)
    return spark.read.schema(PROGRESS_SCHEMA).parquet(*found)


def compact(spark: SparkSession, path: str) -> int:
    """Write a snapshot of all finished additions; returns its number, 0 where there is nothing new."""
    additions, snapshots = _numbers(spark, f"{path}/additions"), _numbers(spark, f"{path}/snapshots", finished=False)
    if not additions or additions[-1] <= max(snapshots, default=0):
        return 0
    latest(read(spark, path)).write.mode("error").parquet(f"{path}/snapshots/n={additions[-1]}")
    return additions[-1]
