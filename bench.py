"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the
local threads (default 8).  Each time covers building the query, planning and
running it to the end with the result discarded.  Every query runs twice and
the second run counts: the first one also compiles its generated code.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from grainframe.plans import QUERIES  # noqa: E402
from grainframe.session import build_session, drop_scratch  # noqa: E402

HEADLINE = (
    "pricing_summary",
    "headline",
    "region_chain",
    "role_playing",
    "star_select_rev_by_region",
    "star_select_native",
    "dim_preserving",
    "both_preserving",
    "fanout_safe",
    "regrain",
    "pct_of_parent",
    "agg_by",
    "count_keys",
    "monthly_revenue",
    "min_cost_supplier",
    "nested_breakdown",
    "collect_label",
    "drill_across",
    "sales_vs_returns",
    "bridge",
    "rank_entities",
    "rank_both",
    "topn_entity",
    "running_total",
    "row_id",
    "top_customers",
    "hierarchy_root",
    "point_in_polygon",
    "rollup_reaggregate",
    "incremental_new_keys",
    "clean_strings",
    "minimise_text",
    "grain_violations",
    "fk_coverage",
    "candidate_keys",
    "validate_model",
    "check_edges",
    "suggest_binding",
    "explode_split",
    "star_select_partial",
    "ex_cumulative_fleet",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__driver__memory="12g",
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    drop_scratch(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(folder).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
