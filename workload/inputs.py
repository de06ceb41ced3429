"""Inputs in the shape of the audited system, derived from the given tables.

Every input uses all rows of its table. Titles of documents are their first sentences or lines; their other sentences are their rows. The expressions that *make* the input are SQL text, because
the checking SQL starts from the same input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Names of the legacy columns below and what they stand for.
ALIAS_CONFIG = """{"column_aliases": {"jml": "jumlah", "kod_wil": "kode_wilayah", "thn": "tahun", "tahun_data": "tahun", "kab_kota": "nama_wilayah"},
 "fuzzy_threshold": 80}"""

DIRTY = "o_custkey % 40 < 30"
YEAR_VALUE = f"""CASE WHEN {DIRTY} AND o_orderkey % 23 = 0 THEN NULL
 WHEN {DIRTY} AND o_orderkey % 29 = 0 THEN '' WHEN {DIRTY} AND o_orderkey % 31 = 0 THEN '1899'
 WHEN o_orderkey % 37 = 0 THEN cast(year(o_orderdate) AS string) || '.0'
 WHEN {DIRTY} AND o_orderkey % 53 = 0 THEN 'n/a'
 ELSE cast(year(o_orderdate) + 5 AS string) END"""
DIGITS = "lpad(cast((o_orderkey * 7919) % 10000000000 AS string), 10, '0')"
CODE_VALUE = f"""CASE WHEN {DIRTY} AND o_orderkey % 43 = 0 THEN NULL WHEN {DIRTY} AND o_orderkey % 47 = 0 THEN '  '
 WHEN {DIRTY} AND o_orderkey % 41 = 0 THEN 'abc' WHEN o_orderkey % 11 = 0 THEN '33.20'
 WHEN o_orderkey % 7 = 0 THEN substr({DIGITS}, 1, 2) WHEN o_orderkey % 7 = 1 THEN substr({DIGITS}, 1, 4)
 WHEN o_orderkey % 7 = 2 THEN substr({DIGITS}, 1, 5) WHEN o_orderkey % 7 = 3 THEN substr({DIGITS}, 1, 6)
 WHEN o_orderkey % 7 = 4 THEN substr({DIGITS}, 1, 7) WHEN o_orderkey % 7 = 5 THEN substr({DIGITS}, 1, 8)
 ELSE {DIGITS} END"""
PLACE_VALUE = "CASE WHEN o_orderkey % 3 = 0 THEN '  Kota   ' || o_orderstatus || ' ' ELSE 'Kota ' || o_orderstatus END"

# Columns of the ragged rows in order: name, value, and for which datasets (c = o_custkey % 40) the column exists.
LEGACY_COLUMNS = [
    ("tahun_data", YEAR_VALUE, "o_custkey % 40 < 5"),
    ("Tahun", YEAR_VALUE, "o_custkey % 40 IN (8, 9, 10)"),
    ("thn", YEAR_VALUE, "o_custkey % 40 IN (10, 11) OR o_custkey % 40 > 12"),
    ("Tahun ", YEAR_VALUE, "o_custkey % 40 = 11"),
    ("Tahun Ajaran", YEAR_VALUE, "o_custkey % 40 = 12"),
    ("kode_wilayah", CODE_VALUE, "o_custkey % 40 = 13"),
    ("kod_wil", CODE_VALUE, "o_custkey % 40 <> 14"),
    ("Kab_Kota", PLACE_VALUE, "true"),
    ("jml", "cast(cast(floor(o_totalprice) AS bigint) AS string)", "true"),
    ("Nama", "o_orderstatus", "o_custkey % 40 = 15"),
    ("nama", "o_orderpriority", "o_custkey % 40 = 15"),
    ("Keterangn", "o_orderpriority", "o_custkey % 40 = 16"),
    ("Prioritas", "o_orderpriority", "true"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def legacy_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``records(dataset_id, row_no, row, bare)``: one ragged dataset per customer, one row per order; ``jml`` is a number.

    Values are worked out once, before the map is made of them.
    """
    names = {value: f"_{n}" for n, value in enumerate(dict.fromkeys(value for _, value, _ in LEGACY_COLUMNS))}
    cells = [
        F.when(F.expr(exists), F.struct(F.lit(name).alias("key"), F.col(names[value]).alias("value")))
        for name, value, exists in LEGACY_COLUMNS
    ]
    row = F.map_from_entries(F.filter(F.array(*cells), lambda cell: cell.isNotNull()))
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", *[F.expr(value).alias(name) for value, name in names.items()])
    return orders.select(
        F.expr("'ds_' || o_custkey").alias("dataset_id"), F.col("o_orderkey").alias("row_no"), row.alias("row"), F.array(F.lit("jml")).alias("bare")
    )


def legacy_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``catalog(ord, id, judul)``: the customers."""
    return table(spark, sf_dir, "customer").selectExpr("c_custkey AS ord", "'ds_' || c_custkey AS id", "'Data ' || c_name AS judul")


def packed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The legacy rows as ready rows ``(Dataset_Id, Judul_Tabel, Row_Data_JSON, row_no)``."""
    rows, catalog = legacy_rows(spark, sf_dir), legacy_catalog(spark, sf_dir)
    return rows.join(catalog, rows["dataset_id"] == catalog["id"]).select(
        F.col("dataset_id").alias("Dataset_Id"), F.col("judul").alias("Judul_Tabel"), F.to_json("row").alias("Row_Data_JSON"), "row_no"
    )


def year_packed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a clean ready row with its year."""
    orders = table(spark, sf_dir, "orders")
    document = F.to_json(F.struct(F.expr("cast(year(o_orderdate) AS string)").alias("tahun"), F.col("o_orderstatus").alias("status")))
    return orders.select(
        F.expr("'ds_' || o_custkey").alias("Dataset_Id"),
        F.expr("'Data ' || o_custkey").alias("Judul_Tabel"),
        document.alias("Row_Data_JSON"),
        F.col("o_orderkey").alias("row_no"),
    )


SENTENCE_END = "[.\n]"
TITLE = r"<title>(.*?)</title>"


def page_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``catalog(ord, id, judul)``: web pages by title."""
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("ord"), F.col("page_id").cast("string").alias("id"), F.regexp_extract("html", TITLE, 1).alias("judul")
    )


def part_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``catalog(ord, id, judul)``: the parts by name, a column of titles in which most occur many times."""
    return table(spark, sf_dir, "part").selectExpr("p_partkey AS ord", "cast(p_partkey AS string) AS id", "p_name AS judul")


def page_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(dataset_id, row_no, teks)``: every sentence of the web pages, whole, with those of head, scripts, styles and nav."""
    text = F.regexp_replace("html", "<[^>]*>", "\n")
    rows = table(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("dataset_id"), F.posexplode(F.split(text, SENTENCE_END)).alias("pos", "teks")
    )
    return rows.where("trim(teks) <> ''").select("dataset_id", F.col("pos").cast("long").alias("row_no"), F.trim("teks").alias("teks"))


def document_catalog(spark: SparkSession, sf_dir: str, end: str = SENTENCE_END) -> DataFrame:
    """``catalog(ord, id, judul)``: documents by their first sentence (or line); copies and near copies occur."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ord"), F.col("doc_id").cast("string").alias("id"), F.element_at(F.split("text", end), 1).alias("judul")
    )


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the documents: every further sentence, whole."""
    rows = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("dataset_id"), F.posexplode(F.split("text", SENTENCE_END)).alias("pos", "teks")
    )
    return rows.where("pos > 0 AND trim(teks) <> ''").select(
        "dataset_id", F.col("pos").cast("long").alias("row_no"), F.create_map(F.lit("Teks"), F.trim("teks")).alias("row")
    )


def page_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The web pages as old datasets to be mapped."""
    return page_catalog(spark, sf_dir).select(F.col("id").alias("Dataset_Id"), F.col("judul").alias("Judul_Tabel"))


def customer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers served as catalog pages of 100 entries; every page names the page count."""
    customers = table(spark, sf_dir, "customer")
    entry = F.to_json(F.struct(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("judul"), F.col("c_mktsegment").alias("segmen")))
    numbered = customers.select((F.floor(F.col("c_custkey") / 100) + 1).cast("int").alias("page"), "c_custkey", entry.alias("entry"))
    last = numbered.agg(F.max("page")).first()[0] or 0
    pages = numbered.groupBy("page").agg(F.sort_array(F.collect_list(F.struct("c_custkey", "entry"))).alias("entries"))
    body = F.concat(
        F.lit('{"_meta":{"pageCount":"'), F.lit(str(last)), F.lit('"},"data":["noise",'), F.array_join(F.col("entries.entry"), ","), F.lit("]}")
    )
    return pages.select(F.lit("catalog").alias("dataset_id"), "page", body.alias("body"), F.lit(True).alias("ok"))


def conversation_pages(spark: SparkSession, sf_dir: str, unusable: str = "length(text) % 17 = 0") -> DataFrame:
    """Every conversation served as a dataset with one turn per page; the pages named by ``unusable`` can't be read."""
    turns = table(spark, sf_dir, "conversations")
    counts = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    body = F.to_json(
        F.struct(
            F.struct(F.col("n").cast("string").alias("pageCount")).alias("_meta"),
            F.array(F.struct("role", "text", F.col("turn").cast("string").alias("turn"))).alias("data"),
        )
    )
    bad = F.expr(unusable)
    return turns.join(counts, "conv_id").select(
        F.col("conv_id").cast("string").alias("dataset_id"),
        (F.col("turn") + 1).cast("int").alias("page"),
        F.when(bad, F.lit("<html>busy</html>")).otherwise(body).alias("body"),
        (~(bad & F.expr("length(text) % 34 = 0"))).alias("ok"),
    )


def delivery_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``old_id, new_id``: customers with a balance have a target."""
    return table(spark, sf_dir, "customer").where("c_acctbal >= 0").selectExpr("'ds_' || c_custkey AS old_id", "cast(c_custkey * 10 AS string) AS new_id")


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery outcomes: one payload per event."""
    return table(spark, sf_dir, "events").selectExpr(
        "cast(user_id * 31 + day(ts) AS string) AS target_id",
        "cast(user_id AS string) AS old_id",
        "event_id AS tahun_data",
        "event_id % 3 AS chunk",
        "event_type <> 'error' AS ok",
        "cast(get_json_object(props, '$.k') AS bigint) AS n_rows",
    )


def sent_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the outcomes as they were sent."""
    data = F.array(F.create_map(F.lit("props"), F.col("props")))
    return table(spark, sf_dir, "events").select(
        F.expr("cast(user_id * 31 + day(ts) AS string)").alias("target_id"), F.expr("cast(user_id AS string)").alias("old_id"), F.expr("event_id % 3").alias("chunk"),
        F.struct(F.col("event_id").alias("tahun_data"), data.alias("data")).alias("body"),
    )


def target_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suppliers of each nation and hundred as a target catalog of one page, and a second page that nobody asked for."""
    entry = F.to_json(F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("judul")))
    served = F.concat_ws("_", F.lit("target"), "s_nationkey", F.floor(F.col("s_suppkey") / 100)).alias("dataset_id")
    entries = table(spark, sf_dir, "supplier").groupBy(served).agg(F.sort_array(F.collect_list(F.struct("s_suppkey", entry.alias("entry")))).alias("entries"))
    body = F.concat(F.lit('{"_meta":{"pageCount":2},"data":['), F.array_join(F.col("entries.entry"), ","), F.lit("]}"))
    page = entries.select("dataset_id", F.lit(1).alias("page"), body.alias("body"), F.lit(True).alias("ok"))
    return page.unionByName(page.withColumn("page", F.lit(2)))


def progress_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress lines: one per event, the day being the batch."""
    return table(spark, sf_dir, "events").selectExpr(
        "cast(user_id AS string) AS new_id",
        "'Data ' || user_id AS new_title",
        "CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'partial' ELSE 'done' END AS status",
        "cast(get_json_object(props, '$.k') AS bigint) AS rows_sent",
        "day(ts) AS batch_number",
        "event_id AS seq",
    )


def target_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr("c_custkey AS ord", "cast(c_custkey AS string) AS id", "c_name AS judul")
