"""The audit as one plan: catalog and rows in, report tables out. Small tables that are read several times are written on the way."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabaudit.operators import catalog as cat
from tabaudit.operators import cleaning, routing, rules, schema
from tabaudit.session import cut_lineage, written
from tabaudit.settings import Settings


def rename_plan(records: DataFrame, aliases: dict[str, str], found: DataFrame | None = None) -> DataFrame:
    """Renames of the audit, the year column included; of columns that end up equal the first stays.

    Finding the columns reads every row, unless the layouts of the records are ``found`` already. The plan is made once for each
    list of columns and repeated for the datasets that have it.
    """
    models, plan = model_plan(written(schema.layouts(records)) if found is None else found, aliases)
    return schema.of_all(plan, models)


def model_plan(found: DataFrame, aliases: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """``(models, plan)``: the renames of the audit for one dataset of each column list, and which datasets it stands for.

    The columns of all datasets are never in one plan; that grew with datasets times columns.
    """
    models, columns = schema.models_of(found)
    plan = schema.audit_rename_plan(columns, aliases)
    return models, written(schema.settle_duplicates(schema.with_year_rename(plan)), packed=False)


def clean(
    records: DataFrame, plan: DataFrame, found: DataFrame | None = None, required: Sequence[str] | None = None, models: DataFrame | None = None
) -> DataFrame:
    return cleaning.fix_region_codes(cleaning.clean_whitespace(schema.apply_plan(records, plan, found, required, models)))


def assess(cleaned: DataFrame, plan: DataFrame, settings: Settings) -> DataFrame:
    audited = rules.start_audit(cleaned)
    columns = None if "present" in audited.columns else schema.final_columns(plan)
    audited = rules.flag_missing(audited, settings.require_columns, columns)
    audited = rules.warn_year(audited, settings.year_min, settings.year_max)
    return rules.mark_ready(audited)


def find_duplicates(catalog: DataFrame, records: DataFrame, settings: Settings) -> dict[str, DataFrame]:
    """Title groups, and inside them the datasets whose samples agree. Works on raw, uncleaned rows.

    Groups, samples and pairs are one row per suspect dataset or pair and are read several times, so they are
    written once to the checkpoint folder.
    """
    groups = cut_lineage(cat.title_groups(catalog, settings.dup_threshold))
    classes = cut_lineage(cat.sample_classes(groups, records, settings.dup_sample_size))
    pairs = cut_lineage(cat.class_pairs(classes, settings.verify_threshold))
    return {
        "groups": groups,
        "classes": classes,
        "pairs": pairs,
        "suspects": cat.suspect_ids(classes, pairs),
        "duplicates": cat.duplicate_report(classes, pairs, groups),
    }


def audit(
    catalog: DataFrame,
    records: DataFrame,
    aliases: dict[str, str],
    settings: Settings = Settings(),
    fetch_status: DataFrame | None = None,
    check_duplicates: bool = True,
) -> dict[str, DataFrame]:
    """All report tables of an audit run. Groups, plan and quality are written while this runs; the rows are read when a table is.

    ``fetch_status(dataset_id, ok, message)`` names datasets that could not be read; their rows are left out.
    """
    catalog = cat.unique_catalog(catalog)
    if fetch_status is not None:
        records = records.join(fetch_status.where("not ok").select("dataset_id"), "dataset_id", "left_anti")
    tables: dict[str, DataFrame] = {"catalog": catalog}
    suspects = None
    if check_duplicates:
        found = find_duplicates(catalog, records, settings)
        suspects = found["suspects"]
        tables["duplicates"] = found["duplicates"]
        tables["skipped"] = cat.skipped_report(found["groups"], records, fetch_status, settings.dup_sample_size)
    head = routing.catalog_head(catalog, settings.max_datasets)
    assessed = records
    if settings.max_datasets is not None:
        head = cut_lineage(head)
        assessed = records.join(head.select(F.col("id").alias("dataset_id")), "dataset_id", "left_semi")
    layouts = written(schema.layouts(assessed))
    models, plan = model_plan(layouts, aliases)
    audited = assess(clean(assessed, plan, layouts, settings.require_columns, models), plan, settings)
    issues = schema.of_all(schema.schema_issues(schema.final_columns(plan), settings.require_columns, plan), models)
    quality = cut_lineage(routing.quality_report(head, audited, issues, suspects, fetch_status, settings.allowed_load_statuses))
    tables["renames"] = schema.of_all(schema.rename_report(plan), models)
    tables["quality"] = quality
    tables["summary"] = routing.load_summary(quality)
    tables["load_ready"] = routing.pack_ready(audited, quality, settings.allowed_load_statuses)
    tables["manager_review"] = routing.pack_review(audited, quality)
    tables["routed"] = routing.route(audited, quality, settings.allowed_load_statuses)
    return tables
