"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3: the median is reported), BENCH_QUERIES (comma list).
Results go to Spark's no-op sink, so every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.catalogue import QUERIES  # noqa: E402
from millrace.session import get_session  # noqa: E402

HEADLINE = (
    "flagship_group_by", "group_two_keys", "group_many_keys", "group_text_extremes", "group_nulls_as_zero",
    "global_aggregate", "post_shuffle_filter", "job_group_with_ops", "job_projection", "project_rename",
    "project_last_nonempty", "default_values", "expression_columns", "expression_on_text", "string_template",
    "value_map", "reverse_fields", "rowop_chain", "regex_filter", "reject_split", "validate_only_counts",
    "hook_rows", "hook_lines", "decimal_texts", "digests", "measurement_counters", "drop_processed_inputs",
    "latest_row_per_key", "ordered_rows", "row_page", "split_integer_ranges", "split_text_ranges",
    "shard_by_int_key", "slot_by_string_key", "shard_by_whole_text", "rows_per_shard", "shard_files_read_back",
    "cells_from_rows", "cells_round_trip", "cell_scan", "cell_filters_and", "cell_bulk_files",
    "text_multi_char_separator", "text_plain_reader", "text_skip_head_line", "text_codecs", "sequence_file",
    "partitioned_output", "catalog_table_sink", "ledger_run_twice", "stream_new_files",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    spark = get_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    QUERIES[names[0]](spark, folder).write.format("noop").mode("overwrite").save()  # untimed: starts the JVM's compiler
    for name in names:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken), 4)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
