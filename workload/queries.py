"""One query per operator. Each takes ``(spark, sf_dir)`` and returns a DataFrame with primitive columns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabaudit.functions import similarity, text
from tabaudit.operators import availability, catalog, cleaning, mapping, payloads, progress, routing, rules, schema
from tabaudit.plans import audit, migrate
from tabaudit.session import cut_lineage, fresh_path, written
from tabaudit.settings import Settings
from tabaudit.sources import pages, reports
from tabaudit.sources.tables import complete_progress, parse_aliases, read_ready_csv
from workload import inputs

ALIASES, FUZZY = parse_aliases(inputs.ALIAS_CONFIG)
TARGET_COLUMNS = ["keterangan", "prioritas", "tahun", "jumlah"]
SETTINGS = replace(Settings(), max_datasets=None)
DOCUMENT_SETTINGS = replace(SETTINGS, require_columns=("teks",))
ROWS_PER_DOCUMENT = 2
YEARS = [1997, 1998, 1999, 2000, 2001]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- sources -------------------------------------------------------------------------------------------------------


@query
def page_scan(spark, sf_dir):
    found = pages.catalog_from_pages(inputs.customer_pages(spark, sf_dir))
    return found.select((F.shiftright("ord", pages.ROW_SHIFT)).cast("int").alias("page"), "id", "judul", F.col("extra")["segmen"].alias("segmen"))


@query
def detail_scan(spark, sf_dir):
    """All turns of all conversations; unusable pages are the input of ``prefix_until_bad_page``."""
    rows = pages.records_from_pages(inputs.conversation_pages(spark, sf_dir, "false"))
    return rows.select("dataset_id", F.col("row")["turn"].alias("turn"), F.col("row")["role"].alias("role"), F.md5(F.col("row")["text"]).alias("text_md5"))


@query
def prefix_until_bad_page(spark, sf_dir):
    rows = pages.records_from_pages(inputs.conversation_pages(spark, sf_dir), fail_fast=False)
    return rows.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.col("row")["turn"].cast("int")).alias("last_turn"))


@query
def target_catalog_scan(spark, sf_dir):
    """Target catalogs as they are served, one for each nation and hundred of suppliers: one page each, other pages don't count."""
    return pages.target_catalog(inputs.target_pages(spark, sf_dir)).select("ord", "id", "judul")


@query
def keyword_filter(spark, sf_dir):
    return catalog.keyword_filter(inputs.page_catalog(spark, sf_dir), [" The ", "aux"]).select("ord", "id", "judul")


@query
def catalog_head(spark, sf_dir):
    return routing.catalog_head(inputs.legacy_catalog(spark, sf_dir), 100).select("ord", "id", "judul")


@query
def ready_contract_scan(spark, sf_dir):
    """Ready rows written to files of the contract and read back: the document survives quoting, and values stay text."""
    path = fresh_path(spark)
    reports.write_csv(inputs.packed_rows(spark, sf_dir), path)
    rows = payloads.unpack_rows(read_ready_csv(spark, path))
    return rows.select("dataset_id", "row_no", F.col("row")["jml"].alias("jml"), F.col("row")["Kab_Kota"].alias("kab_kota"), F.col("row")["kod_wil"].alias("kod_wil"))


# --- schema --------------------------------------------------------------------------------------------------------


def _legacy_plan(spark, sf_dir):
    return audit.rename_plan(inputs.legacy_rows(spark, sf_dir), ALIASES)


@query
def rename_plan(spark, sf_dir):
    plan = schema.audit_rename_plan(schema.dataset_columns(inputs.legacy_rows(spark, sf_dir)), ALIASES)
    return plan.select("dataset_id", "ord", "old", "new", F.coalesce("method", F.lit("")).alias("method"))


@query
def rename_apply(spark, sf_dir):
    rows = inputs.legacy_rows(spark, sf_dir)
    layouts = written(schema.layouts(rows))
    models, plan = audit.model_plan(layouts, ALIASES)
    applied = schema.apply_plan(rows, plan, layouts, models=models)
    names = ["tahun", "kode_wilayah", "nama_wilayah", "jumlah", "nama", "prioritas", "kod_wil", "thn"]
    return applied.select("dataset_id", "row_no", *[F.col("row")[name].alias(name) for name in names], F.size("row").alias("n_keys"))


@query
def rename_report(spark, sf_dir):
    report = schema.rename_report(_legacy_plan(spark, sf_dir))
    return report.groupBy("old_column", "new_column", "match_method", "match_score").agg(F.count(F.lit(1)).alias("n_datasets"))


@query
def year_column(spark, sf_dir):
    found = schema.year_column(schema.dataset_columns(inputs.legacy_rows(spark, sf_dir)))
    return found.select("dataset_id", F.coalesce("year_col", F.lit("")).alias("year_col"), F.coalesce("method", F.lit("")).alias("method"))


@query
def schema_issues(spark, sf_dir):
    plan = _legacy_plan(spark, sf_dir)
    return schema.schema_issues(schema.final_columns(plan), SETTINGS.require_columns, plan)


def _key_plan(spark, sf_dir):
    return migrate.key_plan(inputs.packed_rows(spark, sf_dir), ALIASES, FUZZY, TARGET_COLUMNS)


@query
def key_normalize_plan(spark, sf_dir):
    plan = _key_plan(spark, sf_dir)
    return plan.select(
        "dataset_id", "old", "new", F.coalesce("method", F.lit("")).alias("method"), F.coalesce("score", F.lit(-1)).alias("score"), "dropped"
    )


@query
def key_normalize_apply(spark, sf_dir):
    ready = inputs.packed_rows(spark, sf_dir)
    applied = schema.apply_plan(payloads.unpack_rows(ready), migrate.key_plan(ready, ALIASES, FUZZY, TARGET_COLUMNS))
    names = ["tahun", "kode_wilayah", "nama_wilayah", "jumlah", "nama", "prioritas", "keterangan"]
    return applied.select("dataset_id", "row_no", *[F.col("row")[name].alias(name) for name in names], F.size("row").alias("n_keys"))


# --- cleaning ------------------------------------------------------------------------------------------------------


@query
def whitespace_clean(spark, sf_dir):
    """Every document text as one cell."""
    docs = inputs.table(spark, sf_dir, "documents")
    rows = docs.select(F.col("doc_id").cast("string").alias("dataset_id"), F.col("doc_id").alias("row_no"), F.create_map(F.lit("teks"), F.col("text")).alias("row"))
    cleaned = F.col("row")["teks"]
    return cleaning.clean_whitespace(rows).select("dataset_id", F.length(cleaned).alias("n_chars"), F.md5(cleaned).alias("md5"))


@query
def region_code(spark, sf_dir):
    rows = cleaning.fix_region_codes(inputs.legacy_rows(spark, sf_dir), "kod_wil")
    return rows.select("dataset_id", "row_no", F.col("row")["kod_wil"].alias("kod_wil"))


@query
def change_log(spark, sf_dir):
    return cleaning.change_log(inputs.legacy_rows(spark, sf_dir), "kod_wil")


# --- rules ---------------------------------------------------------------------------------------------------------


def _cleaned(spark, sf_dir):
    rows = inputs.legacy_rows(spark, sf_dir)
    plan = audit.rename_plan(rows, ALIASES)
    return audit.clean(rows, plan), plan


def _assessed(spark, sf_dir):
    rows = inputs.legacy_rows(spark, sf_dir)
    layouts = written(schema.layouts(rows))
    models, plan = audit.model_plan(layouts, ALIASES)
    return audit.assess(audit.clean(rows, plan, layouts, SETTINGS.require_columns, models), plan, SETTINGS), plan, models


def _status(audited):
    return audited.select("dataset_id", "row_no", "migration_status", "flag_reason")


@query
def flag_missing(spark, sf_dir):
    cleaned, plan = _cleaned(spark, sf_dir)
    return _status(rules.flag_missing(rules.start_audit(cleaned), SETTINGS.require_columns, schema.final_columns(plan)))


@query
def flag_duplicates(spark, sf_dir):
    rows = inputs.legacy_rows(spark, sf_dir)
    return _status(rules.flag_duplicates(rules.start_audit(rows), ["kod_wil", "Kab_Kota"], schema.dataset_columns(rows)))


@query
def duplicate_check_issues(spark, sf_dir):
    return rules.duplicate_check_issues(schema.dataset_columns(inputs.legacy_rows(spark, sf_dir)), ["kod_wil", "thn", "Kab_Kota"])


@query
def custom_rule(spark, sf_dir):
    audited = rules.start_audit(inputs.legacy_rows(spark, sf_dir))
    return _status(rules.flag_where(audited, F.col("row")["jml"].cast("bigint") > 200000, "jumlah terlalu besar"))


@query
def warn_year(spark, sf_dir):
    audited = rules.start_audit(inputs.legacy_rows(spark, sf_dir))
    return _status(rules.warn_year(audited, 2000, 2003, "thn"))


@query
def assess_rows(spark, sf_dir):
    return _status(_assessed(spark, sf_dir)[0])


# --- gate, quality, routing ----------------------------------------------------------------------------------------


@query
def gate_select(spark, sf_dir):
    return _status(routing.gate_select(_assessed(spark, sf_dir)[0], ["Ready ", ""]))


@query
def gate_summary(spark, sf_dir):
    return routing.gate_summary(_assessed(spark, sf_dir)[0])


def _quality(spark, sf_dir):
    audited, plan, models = _assessed(spark, sf_dir)
    issues = schema.of_all(schema.schema_issues(schema.final_columns(plan), SETTINGS.require_columns, plan), models)
    return audited, routing.quality_report(inputs.legacy_catalog(spark, sf_dir), audited, issues)


@query
def quality_report(spark, sf_dir):
    return _quality(spark, sf_dir)[1]


@query
def load_summary(spark, sf_dir):
    return routing.load_summary(_quality(spark, sf_dir)[1])


@query
def pack_ready(spark, sf_dir):
    packed = routing.pack_ready(*_quality(spark, sf_dir))
    row = F.from_json("Row_Data_JSON", "map<string,string>")
    names = ["tahun", "kode_wilayah", "nama_wilayah", "jumlah"]
    return packed.select("Dataset_Id", "Judul_Tabel", "row_no", *[row[name].alias(name) for name in names], F.size(row).alias("n_keys"), _types("jumlah", "nama_wilayah"))


def _types(*names):
    """The JSON types of some values of a packed row."""
    document = F.parse_json("Row_Data_JSON")
    return F.concat_ws(",", *[F.schema_of_variant(F.variant_get(document, F.lit(f"$.{name}"), "variant")) for name in names]).alias("types")


@query
def pack_review(spark, sf_dir):
    packed = routing.pack_review(*_quality(spark, sf_dir))
    row = F.from_json("Row_Data_JSON", "map<string,string>")
    return packed.select(
        "Dataset_Id", "Judul_Tabel", "Catalog_Suspect", "row_no", "migration_status", "flag_reason",
        row["tahun"].alias("tahun"), row["kode_wilayah"].alias("kode_wilayah"), F.size(row).alias("n_keys"),
    )


# --- fuzzy catalog -------------------------------------------------------------------------------------------------


@query
def title_normalize(spark, sf_dir):
    """Every document text normalised as if it were a title."""
    title = text.normalize_title(F.col("text"))
    return inputs.table(spark, sf_dir, "documents").select("doc_id", F.length(title).alias("n_chars"), F.md5(title).alias("md5"))


@query
def token_sort(spark, sf_dir):
    tokens = text.sort_tokens(F.col("text"))
    return inputs.table(spark, sf_dir, "documents").select("doc_id", F.length(tokens).alias("n_chars"), F.md5(tokens).alias("md5"))


@query
def indel_ratio(spark, sf_dir):
    """Title against every sentence of its page."""
    titles = inputs.page_catalog(spark, sf_dir).select(F.col("id").alias("dataset_id"), "judul")
    rows = inputs.page_sentences(spark, sf_dir).join(titles, "dataset_id")
    return rows.select("dataset_id", "row_no", similarity.indel_ratio(F.col("judul"), F.col("teks")).alias("score"))


@query
def token_sort_ratio(spark, sf_dir):
    """Title against the address of its page."""
    landed = inputs.table(spark, sf_dir, "pages").select("page_id", "url").join(inputs.page_catalog(spark, sf_dir), F.col("page_id") == F.col("ord"))
    return landed.select("page_id", similarity.token_sort_ratio(F.col("judul"), F.col("url")).alias("score"))


@query
def title_edges(spark, sf_dir):
    return catalog.title_edges(inputs.document_catalog(spark, sf_dir))


@query
def title_groups(spark, sf_dir):
    return catalog.title_groups(inputs.document_catalog(spark, sf_dir))


@query
def part_title_edges(spark, sf_dir):
    """Part names, which are titles by themselves."""
    return catalog.title_edges(inputs.part_catalog(spark, sf_dir), 75)


@query
def part_title_groups(spark, sf_dir):
    return catalog.title_groups(inputs.part_catalog(spark, sf_dir), 75).select("group_ord", "base_title", "dataset_id")


@query
def title_groups_low(spark, sf_dir):
    """Page titles at a threshold that has no usable join key."""
    return catalog.title_groups(inputs.page_catalog(spark, sf_dir), 60).select("group_ord", "base_title", "dataset_id")


@query
def document_title_groups(spark, sf_dir):
    """Groups over the first lines of all documents, which run to thousands of characters."""
    lines = inputs.document_catalog(spark, sf_dir, "\n")
    return catalog.title_groups(lines, 92).select("group_ord", "dataset_id", "ord")


@query
def sample_rows(spark, sf_dir):
    sampled = catalog.sample_rows(inputs.document_records(spark, sf_dir), 5)
    return sampled.select("dataset_id", "row_no", F.md5(F.col("row")["Teks"]).alias("md5"))


@query
def row_fingerprint(spark, sf_dir):
    rows = inputs.legacy_rows(spark, sf_dir)
    return rows.select("dataset_id", "row_no", catalog.fingerprint(F.col("row")).alias("fingerprint"))


def _duplicates(spark, sf_dir):
    return audit.find_duplicates(inputs.document_catalog(spark, sf_dir), inputs.document_records(spark, sf_dir), DOCUMENT_SETTINGS)


@query
def pair_similarity(spark, sf_dir):
    return _duplicates(spark, sf_dir)["pairs"].select("group_ord", "a_class", "b_class", F.round("similarity", 6).alias("similarity"))


@query
def dup_pairs(spark, sf_dir):
    return _duplicates(spark, sf_dir)["duplicates"]


@query
def suspect_ids(spark, sf_dir):
    return _duplicates(spark, sf_dir)["suspects"]


@query
def skipped_report(spark, sf_dir):
    """Document groups when German documents could not be read and short sentences count as blank."""
    groups = catalog.title_groups(inputs.document_catalog(spark, sf_dir))
    status = inputs.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("dataset_id"), (F.col("lang") != "de").alias("ok"), F.lit("timeout").alias("message")
    )
    rows = inputs.document_records(spark, sf_dir)
    blanked = F.transform_values("row", lambda k, v: F.when(F.length(v) > 60, v))
    return catalog.skipped_report(groups, rows.withColumn("row", blanked), status)


@query
def audit_quality(spark, sf_dir):
    """The whole audit of the documents, duplicates included."""
    tables = audit.audit(inputs.document_catalog(spark, sf_dir), inputs.document_records(spark, sf_dir), ALIASES, DOCUMENT_SETTINGS)
    return tables["quality"]


# --- mapping -------------------------------------------------------------------------------------------------------


def _mapped(spark, sf_dir):
    ready, targets = inputs.page_ready(spark, sf_dir), inputs.document_catalog(spark, sf_dir)
    return ready, targets, cut_lineage(mapping.automap(ready, targets))


@query
def automap(spark, sf_dir):
    return _mapped(spark, sf_dir)[2].drop("file_order")


@query
def automap_unmapped(spark, sf_dir):
    return mapping.automap_unmapped(*_mapped(spark, sf_dir))


@query
def automap_collisions(spark, sf_dir):
    return mapping.collisions(_mapped(spark, sf_dir)[2]).drop("file_order")


# --- payloads ------------------------------------------------------------------------------------------------------


@query
def json_unpack(spark, sf_dir):
    return availability.json_unpack(inputs.packed_rows(spark, sf_dir), "thn")


def _classified(spark, sf_dir):
    ready = inputs.packed_rows(spark, sf_dir)
    plan = migrate.key_plan(ready, ALIASES, FUZZY)
    return payloads.classify_rows(ready, inputs.delivery_mapping(spark, sf_dir), plan)


@query
def payload_groups(spark, sf_dir):
    return payloads.payload_groups(payloads.payload_rows(_classified(spark, sf_dir)))


@query
def payload_documents(spark, sf_dir):
    documents = payloads.payload_documents(payloads.payload_rows(_classified(spark, sf_dir)), ROWS_PER_DOCUMENT)
    data = F.transform("body.data", lambda record: F.from_json(F.to_json(record), "map<string,string>"))
    return documents.select(
        "target_id", "old_id", F.col("body.tahun_data").alias("tahun_data"), "chunk", F.size(data).alias("n_rows"),
        F.array_join(F.transform(data, lambda record: record["jumlah"]), ",").alias("jumlah"),
        F.array_join(F.transform(data, lambda record: record["prioritas"]), ",").alias("prioritas"),
        F.size(F.flatten(F.transform("body.data", lambda record: F.map_keys(record)))).alias("n_values"),
    )


@query
def payload_rejects(spark, sf_dir):
    return payloads.payload_rejects(_classified(spark, sf_dir))


@query
def outcome_fold(spark, sf_dir):
    return payloads.outcome_fold(inputs.outcomes(spark, sf_dir))


@query
def failed_payloads(spark, sf_dir):
    failed = payloads.failed_payloads(inputs.sent_documents(spark, sf_dir), inputs.outcomes(spark, sf_dir))
    return failed.select("target_id", "old_id", "tahun_data", "chunk", F.col("body.data")[0]["props"].alias("props"))


@query
def batch_totals(spark, sf_dir):
    return payloads.batch_totals(payloads.outcome_fold(inputs.outcomes(spark, sf_dir)))


# --- progress ------------------------------------------------------------------------------------------------------


@query
def progress_latest(spark, sf_dir):
    """Lines of an old log without a target title and a time: what is absent is NULL."""
    log = complete_progress(inputs.progress_log(spark, sf_dir).drop("new_title"))
    return progress.latest(log).select("new_id", "status", "rows_sent", "batch_number", F.col("new_title").isNull().alias("no_title"))


@query
def next_batch(spark, sf_dir):
    return progress.next_batch(inputs.progress_log(spark, sf_dir))


@query
def progress_summary(spark, sf_dir):
    return progress.progress_summary(inputs.progress_log(spark, sf_dir))


@query
def done_ids(spark, sf_dir):
    return progress.done_ids(inputs.progress_log(spark, sf_dir))


@query
def remaining_catalog(spark, sf_dir):
    return progress.remaining_catalog(inputs.target_customers(spark, sf_dir), inputs.progress_log(spark, sf_dir))


@query
def catalog_status(spark, sf_dir):
    return progress.catalog_status(inputs.target_customers(spark, sf_dir), inputs.progress_log(spark, sf_dir))


@query
def overall_progress(spark, sf_dir):
    return progress.overall_progress(inputs.target_customers(spark, sf_dir), inputs.progress_log(spark, sf_dir))


# --- availability --------------------------------------------------------------------------------------------------


def _years(spark, sf_dir):
    return availability.json_unpack(inputs.year_packed_rows(spark, sf_dir))


@query
def year_counts(spark, sf_dir):
    return availability.year_counts(_years(spark, sf_dir), 1996, 2000)


@query
def availability_matrix(spark, sf_dir):
    return availability.availability_matrix(_years(spark, sf_dir), YEARS)


@query
def availability_by_year(spark, sf_dir):
    """The matrix over the years that the data has, as lines, since its columns depend on the data."""
    rows = availability.year_range(_years(spark, sf_dir), 1996)
    matrix = availability.availability_matrix(rows)
    years = [name for name in matrix.columns if name.startswith("tahun_")]
    lines = F.explode(F.array(*[F.struct(F.lit(int(name[6:])).alias("tahun"), F.col(name).alias("status")) for name in years]))
    return matrix.select("Judul_Tabel", "Dataset_Id", lines.alias("line")).select("Judul_Tabel", "Dataset_Id", "line.*")


@query
def keep_last(spark, sf_dir):
    return availability.keep_last(availability.year_range(_years(spark, sf_dir), 1999))
