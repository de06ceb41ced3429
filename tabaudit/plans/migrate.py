"""The migration in two jobs: plan the payloads, then fold the delivery outcomes into the progress log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tabaudit.operators import mapping as maps
from tabaudit.operators import payloads as pay
from tabaudit.operators import progress, schema
from tabaudit.session import cut_lineage
from tabaudit.settings import Settings


#: Rows of a payload document: bounds what one task gathers. None sends each payload whole, whatever its size.
ROWS_PER_DOCUMENT = 10_000


def key_plan(ready: DataFrame, aliases: dict[str, str], fuzzy_threshold: int = 80, targets: Sequence[str] = ()) -> DataFrame:
    """Key renames before delivery; of keys that end up equal the last one stays."""
    columns = cut_lineage(schema.dataset_columns(pay.unpack_rows(ready).where("row is not null")))
    plan = schema.key_rename_plan(columns, aliases, fuzzy_threshold, targets)
    return cut_lineage(schema.settle_duplicates(plan, keep="last"))


def plan_batch(
    ready: DataFrame,
    catalog: DataFrame,
    log: DataFrame,
    aliases: dict[str, str],
    settings: Settings = Settings(),
    fuzzy_threshold: int = 80,
    rows_per_document: int | None = ROWS_PER_DOCUMENT,
) -> dict[str, DataFrame]:
    """Mapping to the targets that are still open, and the payloads for them.

    Where nothing is left to do, because no target remains or there are no ready rows, the mapping isn't searched: the
    result has the remaining targets only.
    """
    remaining = progress.remaining_catalog(catalog, log)
    if remaining.isEmpty() or ready.isEmpty():
        return {"remaining": remaining}
    done = progress.done_ids(log)
    mapping = cut_lineage(maps.automap(ready, catalog, settings.dup_threshold, done))
    plan = key_plan(ready, aliases, fuzzy_threshold)
    classified = pay.classify_rows(ready, mapping, plan)
    rows = pay.payload_rows(classified)
    return {
        "remaining": remaining,
        "mapping": mapping,
        "unmapped": maps.automap_unmapped(ready, catalog, mapping, done),
        "collisions": maps.collisions(mapping),
        "renames": schema.rename_report(plan),
        "payloads": pay.payload_documents(rows, rows_per_document),
        "payload_groups": pay.payload_groups(rows),
        "rejects": pay.payload_rejects(classified),
    }


def fold_batch(outcomes: DataFrame, documents: DataFrame, catalog: DataFrame, batch_number: int) -> dict[str, DataFrame]:
    """Statuses, log lines, failed payloads and totals of a delivered batch. ``documents`` are the payloads that were sent."""
    fold = pay.outcome_fold(outcomes)
    return {
        "status": fold,
        "progress": progress.progress_lines(fold, catalog, batch_number),
        "failed": pay.failed_payloads(documents, outcomes),
        "totals": pay.batch_totals(fold, batch_number),
    }
