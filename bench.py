"""Time the headline queries; prints one JSON line.

Each query writes to Spark's `noop` sink, so the whole result is computed but not collected.
BENCH_QUERIES=all times every registered query.
"""

from __future__ import annotations

import json
import os
import time

from querytrail import plans
from querytrail.session import build_session

HEADLINE = [
    "jn1_three_log_join", "lv2_windows_batches_types_in_one_job", "ag11_extraction_row_totals",
    "fn8_calendar_windows", "wn2_batch_numbers", "jn2_pair_semi_join", "ag4_unique_pairs",
    "ag2_keep_first_by_key", "jn4_mapping_differences", "or1_ordered_difference_report",
    "ag3_lineage_dedup", "ag14_table_map_build", "jn8_catalog_lookup", "jn7_database_fill_join",
    "ag6_script_statistics", "pf7_statement_validity", "ag16_script_status", "ag17_good_statements_concatenated",
    "ag19_table_classification", "jn10_label_every_row", "wn1_adjacent_line_pairs",
    "tr1_flatten_trees", "tr5_first_named_child", "tr9_tree_strings", "tr11_detailed_flat_form",
    "tk1_explode_tokens", "wn5_token_look_ahead", "ag9_token_type_distribution",
    "lv1_level_expansion", "st3_extraction_records",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "querytrail-bench", f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    every = plans.queries()
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(every) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    seconds = {}
    for name in names:
        began = time.perf_counter()
        every[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
