"""Explicit schemas of the raw exports and the order of every Silver and Gold column."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# The column headings of the two kinds of export.
RAW_EOD = _strings("Date", "First Name", "Last Name", "Activity", "Hours")
RAW_LMS = _strings(
    "User Name",
    "Course Name",
    "Start Date",
    "End Date",
    "Mentor Name",
    "Progress (%)",
    "Completed Assignment",
    "Reviewed / Submitted",
    "Overall Knowledge Check",
    "Overall Test",
    "Reviewed / Total Assignments",
    "Overall Status",
)

# Position of a row in the order of ingestion. Bronze stores it; "first row wins"
# rules and dense ids are decided by it, since a distributed table has no row order.
SEQ = "ingest_seq"

# The columns of every Silver and Gold table.
COLUMNS: dict[str, list[str]] = {
    "dim_intern": ["intern_id", "full_name", "first_name", "last_name"],
    "dim_course": ["course_id", "course_key", "course_name", "start_date", "end_date"],
    "dim_mentor": ["mentor_id", "mentor_name"],
    "dim_activity": ["activity_id", "activity_name", "activity_category"],
    "dim_date": ["date", "day_of_week", "week_number", "month", "month_name", "year"],
    "bridge_intern_mentor": ["intern_id", "course_id", "mentor_id"],
    "fact_eod_log": ["log_id", "intern_id", "date", "activity_id", "hours", "hours_outlier_flag"],
    "fact_lms_progress": [
        "progress_id", "intern_id", "course_id", "progress_pct",
        "completed_count", "total_assignments", "assignment_ratio",
        "kc_score", "kc_max", "kc_pct", "test_score", "test_max", "test_pct",
        "overall_status",
    ],
    "gold_weekly_hours": [
        "intern_id", "full_name", "year", "week_number", "month_name",
        "activity_count", "total_hours", "avg_hours_per_activity", "active_days",
    ],
    "gold_activity_summary": [
        "intern_id", "full_name", "activity_name", "activity_category",
        "activity_count", "total_hours", "avg_hours",
    ],
    "gold_course_progress": [
        "intern_id", "full_name", "course_name", "progress_pct", "overall_status",
        "assignment_ratio", "kc_pct", "test_pct", "completed_count", "total_assignments",
    ],
    "gold_intern_performance": [
        "intern_id", "full_name", "total_hours", "total_activity_entries",
        "distinct_activities", "avg_progress_pct", "avg_kc_pct", "avg_test_pct",
        "courses_completed", "avg_assignment_ratio",
    ],
    "gold_mentor_workload": [
        "mentor_id", "mentor_name", "course_name", "intern_count",
        "avg_mentee_progress", "completed_count", "not_started_count",
    ],
}

SILVER_TABLES = [t for t in COLUMNS if not t.startswith("gold_")]
GOLD_TABLES = [t for t in COLUMNS if t.startswith("gold_")]
