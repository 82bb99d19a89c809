"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from checks.compare import session
from checks.queries import QUERIES

HEADLINE = [
    "s_csv_user_logs",
    "s_csv_skills",
    "x_string_to_real",
    "q_weekly_avg_events",
    "q_activity_by_basis_week",
    "q_courses_per_department",
    "q_shared_courses",
    "q_students_per_grade",
    "q_top_excellent_department",
    "m_week_stats",
    "w_latest_attributes",
    "w_engagement_quartile",
    "m_analytics_student",
    "m_student_performance_v1",
    "m_student_performance",
    "m_performance_refresh",
    "m_performance_arrivals",
    "u_upsert_all",
    "o_competencies",
    "o_positions",
    "o_missing_knowledge",
    "o_missing_competencies",
    "o_full_profile",
    "o_triples",
    "o_read_graph",
    "o_bank_triples",
    "o_class_graph",
    "b_first_transactions",
    "b_client_report",
    "b_client_report_flat",
    "g_salary_history",
    "g_transactions",
    "g_credits",
]

RUNS = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = session(cpus, partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    # Start-up of the JVM and first-time compilation are not part of any query.
    QUERIES["m_student_performance"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(RUNS):
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(runs), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": scale,
                "config": f"local[{cpus}], {cpus} shuffle partitions, median of {RUNS} runs after one warm-up query",
            }
        )
    )


if __name__ == "__main__":
    main()
