"""Time the headline queries and print one JSON line.

$BENCH_SF_DIR   folder of test tables (default /root/testdata/sf0.1)
$BENCH_CPUS     local threads (default: all)
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from conceptree.session import build_session, clean_scratch
from conceptree.suite.queries import all_queries

HEADLINE = [
    "scan_filter",
    "semi_join_restrict",
    "count_distinct_grouped",
    "count_distinct_filtered",
    "demographic_concepts",
    "visit_concepts",
    "vital_concepts",
    "path_decode",
    "descendant_closure",
    "code_range_predicate",
    "dedupe_suffix",
    "universal_id_catalog",
    "range_join_codes",
    "cohort_counts",
    "hierarchy_levels",
    "transitive_closure",
    "closure_counts",
    "value_concepts",
    "numeric_concept_values",
    "demographic_extract_omop",
    "demographic_extract_pcornet",
    "build_catalog_omop",
    "build_catalog_pcornet",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    try:
        for name in ("visit_concepts", "path_decode"):  # start the engine
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds = {}
        for name in HEADLINE:
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        factor = re.search(r"sf([\d.]+)", folder)
        print(
            json.dumps(
                {
                    "metric": "total time of the headline queries",
                    "value": round(sum(seconds.values()), 3),
                    "unit": "sec",
                    "queries": seconds,
                    "sf": float(factor.group(1)) if factor else None,
                }
            )
        )
    finally:
        clean_scratch(spark)
        spark.stop()


if __name__ == "__main__":
    main()
