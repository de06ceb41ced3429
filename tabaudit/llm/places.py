"""Decisions on rows carried back to the rows by their place in their file, so that texts needn't be exchanged.

A row of a Parquet scan is known by its file and its number in it. What is decided on narrow lines, keep it or not, take it
so many times, comes back as bitmaps of 32,768 rows each, one bit for a row and binary digit of the number. Bitmaps of bounded
total size travel to every task and the scan is filtered where it is; larger ones are joined, which exchanges the rows once.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabaudit.session import written

#: Bitmaps that travel to every task, in bytes: those of a milliard rows.
BROADCAST_BYTES = 1 << 27
BITMAP_BYTES = 4096
PLACE = ["__file", "__row"]


def _is_scan(docs: DataFrame) -> bool:
    """Whether ``docs`` is a plain scan of files, columns and rows left out at most."""
    node = docs._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().head()
    return node.nodeName().startswith("LogicalRelation") and docs.inputFiles() != []


def located(docs: DataFrame) -> DataFrame:
    """``docs`` with ``PLACE``. What isn't a plain scan is written first. Columns of these two names are replaced."""
    docs = docs.drop(*PLACE)
    docs = docs if _is_scan(docs) else written(docs)
    return docs.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))


def _bucket(row: Column) -> Column:
    return F.call_function("bitmap_bucket_number", row + 1)


def bitmaps(numbers: DataFrame, most: int) -> DataFrame:
    """``__m_file, __m_bucket, __m_<k>``: the digits of ``numbers(PLACE, number)``, from 0 to ``most``; rows of number 0 may be left out."""
    bit = F.call_function("bitmap_bit_position", F.col("__row") + 1)
    digits = [F.call_function("bitmap_construct_agg", F.when(F.shiftright("number", k).bitwiseAND(F.lit(1)) == 1, bit)).alias(f"__m_{k}") for k in range(most.bit_length())]
    return numbers.where("number > 0").groupBy(F.col("__file").alias("__m_file"), _bucket(F.col("__row")).alias("__m_bucket")).agg(*digits)


def numbered_rows(rows: DataFrame, numbers: DataFrame, name: str, most: int = 1) -> DataFrame:
    """``rows`` (with ``PLACE``) whose number isn't 0, with the number as ``name``."""
    masks = written(bitmaps(numbers.select(*PLACE, F.col("number").cast("int").alias("number")), most))
    if masks.count() * BITMAP_BYTES * most.bit_length() <= BROADCAST_BYTES:
        masks = F.broadcast(masks)
    bit = F.call_function("bitmap_bit_position", F.col("__row") + 1)

    def digit(k: int) -> Column:
        byte = F.conv(F.hex(F.substr(F.col(f"__m_{k}"), F.lit(1) + F.floor(bit / 8), F.lit(1))), 16, 10).cast("int")
        return F.shiftleft(F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(F.lit(1)), k)

    met = rows.join(masks, (F.col("__file") == F.col("__m_file")) & (_bucket(F.col("__row")) == F.col("__m_bucket")))
    met = met.withColumn(name, reduce(add, [digit(k) for k in range(most.bit_length())])).where(F.col(name) > 0)
    return met.drop("__m_file", "__m_bucket", *[f"__m_{k}" for k in range(most.bit_length())])


def kept(rows: DataFrame, places: DataFrame) -> DataFrame:
    """The ``rows`` that stand at ``places(PLACE)``, without their places."""
    return numbered_rows(rows, places.select(*PLACE, F.lit(1).alias("number")), "__m_number").drop("__m_number", *PLACE)
