"""Time the headline queries, each on its second run: one JSON line.

`BENCH_SF_DIR` (default sf0.1), `BENCH_CPUS` (default 8), `BENCH_QUERIES` (names separated by commas, or `all`).
The first run of a query compiles its code and is not timed.
"""

from __future__ import annotations

import json
import os
import time

from tidemark.queries import QUERIES
from tidemark.session import build_session

HEADLINE = (
    "recon_daily_counts recon_daily_amounts recon_run_day recon_events_daily count_check_status modified_per_day "
    "three_way_diff diff_repeated_keys missing_rows multi_key_anti late_row_repair key_membership "
    "flatten_json_props flatten_nested_records embedded_json process_response clean_text multi_format_ts coerce_schema "
    "infer_types process_records_catalogued process_records_inferred explode_installments error_split "
    "any_slot_filter custom_field_pivot channel_custom_fields overlay_coalesce slot_group_minmax "
    "cdc_range page_set row_pages chunk_counts chunk_summary bookmark_advance ingest_event "
    "partition_overwrite_roundtrip append_evolve_roundtrip incremental_available_now "
    "page_slice page_slice_deep recon_parts_amounts digest_compare incremental_then_repair backfill_ingest_chunks refresh_installments_job"
).split()


def run(spark, name: str, sf_dir: str) -> float:
    begin = time.perf_counter()
    # The noop sink computes every row and column without gathering them.
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    times = {}
    for name in names:
        run(spark, name, sf_dir)
        times[name] = round(run(spark, name, sf_dir), 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir)}))


if __name__ == "__main__":
    main()
