"""Time the headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from cohortlake import catalogue
from cohortlake.session import build_session

HEADLINE = [
    "c9_clean_eod", "c16_clean_lms", "c17_explode_mentors",
    "w1_dim_intern", "w6_bridge_intern_mentor", "w7_fact_eod_log", "w8_fact_lms_progress",
    "g1_weekly_hours", "g2_activity_summary", "g3_course_progress",
    "g4_intern_performance", "g5_mentor_workload", "q2_null_counts",
    "a1_kpis", "a2_kpis_of_mentor", "a4_hours_histogram", "a6_progress_distribution",
    "a9_mentee_treemap", "a11_kc_ranking", "a17_batch_trend", "a18_weekly_trend",
    "n4_leaderboard", "n6_activity_breakdown", "u1_except", "u1_except_by_key",
    "t5_top_k_course", "t9_daily_detail", "m2_course_features", "m3_person_features", "m6_medians",
    "s5_s6_bronze_upsert", "r1_bronze_stream", "m13_m19_scored", "m15_j9_pca_results",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    queries = catalogue.queries()
    seconds = {}
    start = time.perf_counter()
    list(catalogue.raw(spark, folder).values())
    seconds["load_bronze"] = round(time.perf_counter() - start, 3)
    start = time.perf_counter()
    list(catalogue.stored(spark, folder).values())
    seconds["load_layers"] = round(time.perf_counter() - start, 3)
    # One untimed query, so that the first timed one does not carry the compiler's warm-up.
    queries["g1_weekly_hours"](spark, folder).write.format("noop").mode("overwrite").save()
    for name in wanted:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
