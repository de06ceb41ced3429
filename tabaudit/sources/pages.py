"""Paged JSON documents ``{"_meta": {"pageCount": n}, "data": [...]}`` as tables.

The audited system serves catalogs and dataset rows page by page. Here the pages have been landed, one document per
row: ``pages(dataset_id, page, body, ok)``. Catalog pages use any constant ``dataset_id``. All datasets are read by
one job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabaudit.session import written

PAGE_SCHEMA = "_meta struct<pageCount:string>, data array<string>"
ROW_SHIFT = 32


def read_landed_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages from files ``<path>/dataset_id=<id>/page=<n>/*``, one JSON document per file.

    A file named ``*.failed`` marks a page that could not be fetched and holds the message.
    """
    files = spark.read.text(path, wholetext=True).withColumn("file", F.input_file_name())
    return files.select(
        F.col("dataset_id").cast("string").alias("dataset_id"),
        F.col("page").cast("int").alias("page"),
        F.col("value").alias("body"),
        (~F.endswith("file", F.lit(".failed"))).alias("ok"),
    )


def page_count(text: Column) -> Column:
    """Page counts that are absent, not a whole number, or not positive count as one page."""
    number = text.try_cast("int")
    return F.when(number > 0, number).otherwise(1)


def parsed_pages(pages: DataFrame) -> DataFrame:
    """``(dataset_id, page, n_pages, readable, items)``: every body parsed once, and the result written.

    ``n_pages`` is the page count of a first page and NULL elsewhere. Pages are counted and read from the written table, so
    neither repeats the parsing, and no body goes through a join.
    """
    body = F.from_json("body", PAGE_SCHEMA)
    readable = F.coalesce(F.col("ok") & F.col("doc").isNotNull() & F.startswith(F.ltrim("body"), F.lit("{")), F.lit(False))
    parsed = pages.withColumn("doc", body).select(
        "dataset_id", "page", F.when(F.col("page") == 1, page_count(F.col("doc._meta.pageCount"))).alias("n_pages"), readable.alias("readable"), F.col("doc.data").alias("items")
    )
    return written(parsed)


def _status(parsed: DataFrame, max_pages: int | None) -> DataFrame:
    status = parsed.groupBy("dataset_id").agg(F.max("n_pages").alias("n_pages"), F.min(F.when(~F.col("readable"), F.col("page"))).alias("bad_page"))
    last = F.coalesce("n_pages", F.lit(1))
    if max_pages is not None:
        last = F.least(last, F.lit(max_pages))
    return status.select("dataset_id", last.alias("last_page"), F.when(F.col("bad_page") <= last, F.col("bad_page")).alias("bad_page"))


def page_status(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """``(dataset_id, last_page, bad_page)``: the last page to read, and the first unusable one up to there.

    The page count of the first page decides how many pages there are.
    """
    return _status(parsed_pages(pages), max_pages)


def page_items(pages: DataFrame, max_pages: int | None = None, fail_fast: bool = True) -> DataFrame:
    """``(dataset_id, page, pos, item)``: the raw JSON text of every element of ``data``, in order.

    On an unusable page the job fails, or with ``fail_fast=False`` the pages before it are kept.
    """
    parsed = parsed_pages(pages)
    joined = parsed.join(_status(parsed, max_pages), "dataset_id").where(F.col("page") <= F.col("last_page"))
    if fail_fast:
        message = F.concat(F.lit("unusable page "), F.col("bad_page").cast("string"), F.lit(" of dataset "), "dataset_id")
        joined = joined.where(F.when(F.col("bad_page").isNotNull(), F.raise_error(message).cast("boolean")).otherwise(True))
    else:
        joined = joined.where(F.col("bad_page").isNull() | (F.col("page") < F.col("bad_page")))
    return joined.select("dataset_id", "page", F.posexplode("items").alias("pos", "item"))


def _objects(items: DataFrame) -> DataFrame:
    """Elements that are JSON objects, as maps; ``n`` orders them by page and position."""
    row = F.from_json("item", "map<string,string>")
    order = F.shiftleft(F.col("page").cast("long"), ROW_SHIFT) + F.col("pos")
    typed = F.from_json("item", "map<string,variant>")
    bare = F.map_keys(F.map_filter(typed, lambda k, v: F.coalesce(~F.schema_of_variant(v).isin("STRING", "VOID"), F.lit(False))))
    found = items.where(F.startswith("item", F.lit("{"))).select("dataset_id", order.alias("n"), row.alias("row"), F.coalesce(bare, F.array().cast("array<string>")).alias("bare"))
    return found.where(F.col("row").isNotNull())


def catalog_from_pages(pages: DataFrame, max_pages: int | None = None, fail_fast: bool = True) -> DataFrame:
    """Catalog ``(ord, id, judul, extra)``; further keys of an entry are kept in ``extra``."""
    entries = _objects(page_items(pages, max_pages, fail_fast))
    return entries.select(
        F.col("n").alias("ord"),
        F.col("row")["id"].alias("id"),
        F.col("row")["judul"].alias("judul"),
        F.map_filter("row", lambda k, v: ~k.isin("id", "judul")).alias("extra"),
    )


def records_from_pages(pages: DataFrame, max_pages: int | None = None, fail_fast: bool = True) -> DataFrame:
    """Rows ``(dataset_id, row_no, row, bare)`` of all datasets. ``row_no`` orders the rows of a dataset, with gaps.

    ``row`` holds the text of every value, ``bare`` the keys whose values are no strings: numbers, booleans, nested values.
    """
    rows = _objects(page_items(pages, max_pages, fail_fast))
    return rows.select("dataset_id", F.col("n").alias("row_no"), F.map_filter("row", lambda k, v: k != "dataset_id").alias("row"), "bare")


def fetch_status(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """``(dataset_id, ok, message)`` for reports on datasets that could not be read whole."""
    return page_status(pages, max_pages).select(
        "dataset_id",
        F.col("bad_page").isNull().alias("ok"),
        F.when(F.col("bad_page").isNotNull(), F.concat(F.lit("unusable page "), F.col("bad_page").cast("string"))).alias("message"),
    )


def target_catalog(pages: DataFrame) -> DataFrame:
    """Target catalog: a single page; an absent ``data`` is an empty catalog."""
    return catalog_from_pages(pages.where(F.col("page") == 1), max_pages=1, fail_fast=False)
