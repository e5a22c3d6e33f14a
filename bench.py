"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the test data, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from mattercat.session import build_session
from workload import QUERIES

HEADLINE = [
    "scan_id_prefix", "scan_id_list", "metadata_lookup", "typed_table", "parse_list", "parse_matrix",
    "update_computed", "merge_po_co", "flatten_po_co", "attach_dataset", "remap_foreign_key",
    "anti_missing_children", "copy_closure", "dataset_energy_stats", "dataset_property_counts",
    "recreate_datasets", "recalculate_dataset", "duplicate_ids", "combine_duplicates", "count_by_prefix",
    "content_hash", "content_hash_parity", "structure_hash", "force_norms", "convert_energy",
    "convert_array", "standardize_properties", "standardize_properties_rows", "fix_pbc_and_rehash",
    "repair_duplicates", "purge_datasets", "export_all_datasets", "export_extxyz", "write_clustered",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
            # Listing the folders of an export takes no more tasks than there are cores.
            "spark.sql.sources.parallelPartitionDiscovery.parallelism": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["distinct_ids"](spark, folder).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for key in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[key](spark, folder).write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - start, 3)
    found = re.search(r"sf([0-9.]+)/?$", folder)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(found.group(1)) if found else folder,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
