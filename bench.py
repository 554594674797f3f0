"""Headline queries at one scale; prints one JSON line.

Each query runs twice and the second, warm run counts; one that takes over a minute
runs once. Results go to the noop sink, so every column of every row is computed and
nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidewright import get_session  # noqa: E402
from tidewright.queries import QUERIES  # noqa: E402

HEADLINE = [
    "click_feature_table", "nine_click_counts", "next_event_gap", "arrival_by_series", "latest_order", "kinetic_by_group",
    "scaled_columns", "mutual_information_with_target", "auc_all", "average_precision_by_group", "chunk_numbers", "label_folds",
    "sampled_per_class", "k_best_per_user", "pending_files", "part_and_supplier_of_lines", "box_label_columns", "box_classes",
    "matched_boxes", "suppressed_detections", "detection_average_precision", "pyramid_of_boxes", "near_neighbours",
    "neighbour_votes", "gram_matrix", "kernel_row_means", "bootstrap_plan", "out_of_bag_auc", "mined_negatives",
    "boosted_probabilities", "jobs_due", "loaded_orders", "next_gap_on_stream",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = get_session("bench", cores=cores, **{"spark__driver__memory": os.environ.get("BENCH_MEMORY", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
            if seconds[name] > 60:
                break
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"), "cpus": cores,
    }))


if __name__ == "__main__":
    main()
