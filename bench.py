"""Time the headline queries: ``BENCH_SF_DIR`` (default sf0.1), ``BENCH_CPUS`` (default 8). Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from tabaudit.session import local_session
from workload.queries import QUERIES

HEADLINE = [
    "page_scan", "prefix_until_bad_page", "rename_apply", "key_normalize_apply", "whitespace_clean", "change_log", "flag_duplicates",
    "quality_report", "pack_ready", "pack_review", "row_fingerprint", "sample_rows", "indel_ratio", "title_edges", "title_groups",
    "dup_pairs", "automap", "automap_unmapped", "payload_groups", "payload_documents", "outcome_fold", "progress_latest",
    "catalog_status", "year_counts", "availability_matrix", "keep_last",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    QUERIES["quality_report"](spark, sf_dir.replace(os.path.basename(sf_dir), "sf0.001")).count()  # JVM and worker start
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_headline_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
