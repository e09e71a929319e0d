"""Wall seconds of the headline queries; prints one JSON line.

Every query is built and written to a sink that keeps nothing.  All queries run
twice, one round after the other, and the second round counts, so that class
loading and compilation are left out.
"""

from __future__ import annotations

import json
import os
import time

from schoolatlas.session import build_session
from workload.queries import QUERIES

HEADLINE = [
    "q01_wide_enrollment_totals",
    "q02_unpivot_all",
    "q03_sanitize_counts",
    "q04_label_split",
    "q05_invalid_audit",
    "q07_offered_levels",
    "q08_latest_per_key",
    "q09_last_occurrence",
    "q12_label_to_key",
    "q13_forward_fill",
    "q16_column_ranges",
    "q18_region_names",
    "q19_place_names",
    "q20_title_case",
    "q21_school_names",
    "q26_barangay",
    "q28_backfill",
    "q29_match_all",
    "q30_divisions",
    "q32_location_rules",
    "q33_address_dimension",
    "q34_geo_fact",
    "q35_teachers_fact",
    "q36_dropouts_2022",
    "q39_quality_metrics",
    "q40_orphans",
    "q41_schools_per_year",
    "q42_unmatched_names",
    "q48_csv_lines",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.log.level": "ERROR",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    seconds = {}
    names = os.environ.get("BENCH_QUERIES", " ".join(HEADLINE)).split()
    for _ in range(2):
        for name in names:
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "warm wall time, all headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
