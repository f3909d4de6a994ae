"""Times the headline queries: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (names or 'all').
"""

from __future__ import annotations

import json
import os
import sys
import time

from gazetta.plans import catalog
from gazetta.session import get_session

HEADLINE = (
    "snapshot_delta",
    "latest_before",
    "asof_previous",
    "previous_event",
    "dedupe_first",
    "group_sequence_ids",
    "distinct_sources",
    "quality_score",
    "fuzzy_link",
    "fuzzy_multi_source",
    "containment_align",
    "nearest",
    "point_in_polygon",
    "worst_severity",
    "links",
    "page_text",
    "combine_docs",
    "text_extract",
    "place_payload",
    "upsert_last_wins",
    "insert_only",
    "violations",
    "key_uniqueness",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(catalog.QUERIES) if wanted == "all" else (wanted.split() or list(HEADLINE))
    spark = get_session(
        "gazetta-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/nation.parquet").count()  # start the JVM's machinery
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": folder.rstrip("/").rsplit("/", 1)[-1].removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
