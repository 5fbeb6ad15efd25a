"""Dashboard queries over Silver and Gold.

Names that users pick are compared as column values, never pasted into SQL text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import week_label
from ..functions.numbers import (
    at_least, round_half_away, stable_avg, stable_sum, sum_parts, summed_parts,
)
from ..functions.text import principal_key, short_id
from ..operators.quantiles import box_stats, histogram
from ..operators.skew import join_one_per_key
from ..operators.topk import asc, desc, top, top_by_total
from .gold import Tables, eod_groups, lms_groups

TREND_PEOPLE = 3
AT_RISK_BELOW = 50
KC_THRESHOLD = 60.0


# ---- headline figures -------------------------------------------------------------

# The headline figures.
KPIS = ["total_interns", "total_hours", "total_eod", "avg_progress", "completions"]


def _one_row(parts: list[DataFrame]) -> DataFrame:
    """Put one-row frames side by side: each column is set in one of them and null in the rest."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(k).alias(k) for k in KPIS])


def _eod_figures(per_person: DataFrame) -> DataFrame:
    total = summed_parts("h")
    return per_person.agg(
        F.coalesce(round_half_away(total, 1), F.lit(0.0)).alias("total_hours"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_eod"),
    )


def _lms_figures(per_person: DataFrame) -> DataFrame:
    mean = F.try_divide(F.sum("progress").cast("double"), F.sum("n_progress"))
    return per_person.agg(
        F.coalesce(round_half_away(mean, 1), F.lit(0.0)).alias("avg_progress"),
        F.coalesce(F.sum("done"), F.lit(0)).alias("completions"),
    )


def _lms_per_person(t: Tables) -> DataFrame:
    return lms_groups(t, "intern_id").select("intern_id", "progress", "n_progress", F.col("completed").alias("done"))


def kpis(t: Tables) -> DataFrame:
    """Figures over everything: one aggregate per fact table."""
    done = F.count(F.when(F.col("overall_status") == "Completed", 1))
    return _one_row(
        [
            t["dim_intern"].agg(F.count("intern_id").alias("total_interns")),
            eod_groups(t).agg(
                F.coalesce(round_half_away(summed_parts("h"), 1), F.lit(0.0)).alias("total_hours"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("total_eod"),
            ),
            t["fact_lms_progress"].agg(
                F.coalesce(round_half_away(F.avg("progress_pct"), 1), F.lit(0.0)).alias("avg_progress"),
                done.alias("completions"),
            ),
        ]
    )


def _kpis_of(t: Tables, people: DataFrame, among: Column | None = None) -> list[DataFrame]:
    """Facts are reduced per person first, so the semi-join meets one row per person.

    ``among``, a condition on the person id that holds for all ``people``, is met where facts are read.
    """
    among = F.lit(True) if among is None else among
    return [
        _eod_figures(eod_groups(t, "intern_id").where(among).join(people, "intern_id", "left_semi")),
        _lms_figures(_lms_per_person(t).where(among).join(people, "intern_id", "left_semi")),
    ]


def mentee_ids(t: Tables, mentor: str) -> DataFrame:
    """The mentor id is a function of the name, so both tables are filtered where they are read.

    The join left over, with one row or none, is the check of the name as it is written.
    """
    mine = F.col("mentor_id") == short_id(F.lit(mentor))
    chosen = t["dim_mentor"].filter(mine & (F.col("mentor_name") == mentor)).select("mentor_id")
    rows = t["bridge_intern_mentor"].filter(mine).select("intern_id", "mentor_id").distinct()
    return rows.join(chosen, "mentor_id", "left_semi").select("intern_id")


def kpis_of_mentor(t: Tables, mentor: str) -> DataFrame:
    people = mentee_ids(t, mentor)
    counted = people.agg(F.count("intern_id").alias("total_interns"))
    return _one_row([counted, *_kpis_of(t, people)])


def kpis_of_intern(t: Tables, full_name: str) -> DataFrame:
    """The person id is a function of the name, so all tables are filtered where they are read.

    The join left over, with one row or none, is the check of the name as it is written.
    """
    mine = F.col("intern_id") == short_id(F.lit(full_name))
    people = t["dim_intern"].filter(mine & (F.col("full_name") == full_name)).select("intern_id")
    counted = people.agg(F.lit(1).cast("bigint").alias("total_interns"))
    return _one_row([counted, *_kpis_of(t, people, mine)])


# ---- exploration ------------------------------------------------------------------

def hours_histogram(t: Tables, bins: int = 30) -> DataFrame:
    return histogram(t["fact_eod_log"], "hours", bins)


def hours_by_activity(t: Tables) -> DataFrame:
    per_id = eod_groups(t, "activity_id").groupBy("activity_id").agg(summed_parts("h").alias("total_hours"))
    return (
        per_id.join(t["dim_activity"], "activity_id")
        .select("activity_name", "total_hours")
        .orderBy(desc("total_hours"), asc("activity_name"))
    )


def _label() -> Column:
    return week_label(F.col("year"), F.col("week_number")).alias("week_label")


def _total() -> Column:
    return stable_sum("total_hours")


def top_people(t: Tables, k: int = TREND_PEOPLE) -> DataFrame:
    return top_by_total(t["gold_weekly_hours"], "full_name", _total(), k)


def weekly_trend(t: Tables, names: list[str] | None = None, k: int = TREND_PEOPLE) -> DataFrame:
    """Weekly hours of the picked people, or of those with the most hours."""
    weekly = t["gold_weekly_hours"]
    if names is None:
        rows = weekly.join(top_people(t, k).select("full_name"), "full_name", "left_semi")
    else:
        rows = weekly.filter(F.col("full_name").isin(names))
    return rows.select("full_name", _label(), "total_hours").orderBy("week_label", "full_name")


def progress_distribution(t: Tables) -> DataFrame:
    return box_stats(t["gold_course_progress"], "course_name", "progress_pct")


def status_per_course(t: Tables) -> DataFrame:
    return t["gold_course_progress"].groupBy("course_name", "overall_status").agg(
        F.count(F.lit(1)).alias("intern_count")
    )


# ---- manager ----------------------------------------------------------------------

def leaderboard(t: Tables) -> DataFrame:
    """Rounded figures per person, the basis of the orderings below."""
    return t["gold_intern_performance"].select(
        "intern_id",
        "full_name",
        *[
            round_half_away(F.col(c), 1).alias(c)
            for c in ("total_hours", "avg_progress_pct", "avg_test_pct")
        ],
        "courses_completed",
    )


BEST_FIRST = (desc, desc, asc)
ORDER = ("total_hours", "avg_progress_pct", "full_name")


def ordered_leaderboard(t: Tables) -> DataFrame:
    """Ordered by the rounded figures, the name breaking ties."""
    return leaderboard(t).orderBy(*[f(c) for f, c in zip(BEST_FIRST, ORDER)]).drop("intern_id")


def best(t: Tables, k: int = 5) -> DataFrame:
    return top(leaderboard(t), k, *[f(c) for f, c in zip(BEST_FIRST, ORDER)])


def worst(t: Tables, k: int = 5) -> DataFrame:
    """The end of the leaderboard, found by the reversed order instead of a full sort."""
    return top(
        leaderboard(t), k, asc("total_hours"), asc("avg_progress_pct"), desc("full_name")
    )


def activity_breakdown(t: Tables, k: int = 10) -> DataFrame:
    people = best(t, k).select("intern_id")
    return t["gold_activity_summary"].join(people, "intern_id", "left_semi").select(
        "full_name", "activity_name", "total_hours"
    )


def batch_trend(t: Tables) -> DataFrame:
    """Grouped by label, which merges a week that falls in two months."""
    return (
        t["gold_weekly_hours"].groupBy(_label()).agg(_total().alias("batch_hours")).orderBy("week_label")
    )


# ---- mentor -----------------------------------------------------------------------

def mentee_progress(t: Tables, mentor: str) -> DataFrame:
    people = mentee_ids(t, mentor)
    return join_one_per_key(t["gold_course_progress"], people, "intern_id", "left_semi").select(
        "full_name", "course_name", "progress_pct", "overall_status",
        "kc_pct", "test_pct", "assignment_ratio",
    )


def ordered_mentee_progress(t: Tables, mentor: str) -> DataFrame:
    """By course, best progress first; the other columns keep equal keys, which cannot be split, few."""
    return mentee_progress(t, mentor).orderBy(
        asc("course_name"), desc("progress_pct"), asc("full_name"), asc("kc_pct"), asc("test_pct")
    )


def mentee_summary(t: Tables, mentor: str) -> DataFrame:
    """Number of mentees and mean scores; rows are reduced per name before names are counted."""
    kc = F.col("kc_pct")
    per_name = mentee_progress(t, mentor).groupBy("full_name").agg(
        F.sum("progress_pct").alias("p"),
        F.count("progress_pct").alias("np"),
        *sum_parts("kc_pct", "kc"),
        F.count(kc).alias("nkc"),
    )
    return per_name.agg(
        F.count("full_name").alias("mentees"),
        F.try_divide(F.sum("p").cast("double"), F.sum("np")).alias("avg_progress"),
        F.try_divide(summed_parts("kc"), F.sum("nkc")).alias("avg_kc"),
    )


def mentee_treemap(t: Tables, mentor: str) -> DataFrame:
    """Tile sizes: people within courses (level 0) and courses (level 1).

    Leaves are summed first; only they pass through the rollup's row expansion.
    """
    leaves = (
        mentee_progress(t, mentor)
        .groupBy("course_name", "full_name")
        .agg(F.sum(at_least(F.col("progress_pct"), 1)).alias("size"))
    )
    return (
        leaves.rollup("course_name", "full_name")
        .agg(F.grouping_id().cast("bigint").alias("level"), F.sum("size").alias("tile_size"))
        .filter(F.col("level") < 3)
    )


def mentees_at_risk(t: Tables, mentor: str, below: int = AT_RISK_BELOW) -> DataFrame:
    rows = mentee_progress(t, mentor)
    return (
        rows.filter((F.col("progress_pct") < below) & (F.col("overall_status") != "Completed"))
        .select("full_name", "course_name", "progress_pct", "overall_status")
        .distinct()
    )


def kc_ranking(t: Tables, mentor: str, threshold: float = KC_THRESHOLD) -> DataFrame:
    """Knowledge checks with the person's mean, lowest mean first.

    The means come from the counts per person and course; joined to the rows they also pick the mentees.
    """
    people = mentee_ids(t, mentor)
    known = lms_groups(t, "intern_id", "course_id").filter(F.col("course_id").isNotNull()).join(people, "intern_id", "left_semi")
    means = known.groupBy("intern_id").agg(F.try_divide(summed_parts("kc_pct"), F.sum("n_kc_pct")).alias("avg_kc"))
    rows = t["gold_course_progress"].filter(F.col("kc_pct").isNotNull())
    return (
        join_one_per_key(rows, means, "intern_id")
        .select(
            "full_name", "course_name", "kc_pct", "avg_kc",
            (F.col("kc_pct") < threshold).alias("below_threshold"),
        )
        .orderBy(asc("avg_kc"), asc("full_name"), asc("course_name"), asc("kc_pct"))
    )


def mentees_not_started(t: Tables, mentor: str) -> DataFrame:
    return mentee_progress(t, mentor).filter(F.col("overall_status") == "Not Started").select(
        "full_name", "course_name"
    )


def workload(t: Tables) -> DataFrame:
    return t["gold_mentor_workload"].orderBy(
        desc("intern_count"), asc("mentor_name"), asc("course_name")
    )


# ---- intern -----------------------------------------------------------------------

def _mine(df: DataFrame, full_name: str) -> DataFrame:
    return df.filter(F.col("full_name") == full_name)


def own_performance(t: Tables, full_name: str) -> DataFrame:
    return _mine(t["gold_intern_performance"], full_name)


def own_activities(t: Tables, full_name: str) -> DataFrame:
    return (
        _mine(t["gold_activity_summary"], full_name)
        .select("activity_name", "total_hours")
        .orderBy(desc("total_hours"), asc("activity_name"))
    )


def own_courses(t: Tables, full_name: str) -> DataFrame:
    return _mine(t["gold_course_progress"], full_name).select(
        "course_name", "progress_pct", "overall_status"
    )


def own_score_and_batch(t: Tables, full_name: str) -> DataFrame:
    """Own test scores next to the course averages; a course without own rows scores 0.

    A left join from the averages, written as its two halves: own rows meet the few
    averages, which the planner broadcasts by their size, instead of being shuffled by course.
    """
    progress = t["gold_course_progress"]
    # One row per registered course.
    batch = progress.groupBy("course_name").agg(stable_avg("test_pct").alias("avg_test"))
    mine = _mine(progress, full_name).select("course_name", "test_pct")
    own = mine.join(batch, "course_name")
    without = batch.join(mine.select("course_name").distinct(), "course_name", "left_anti")
    return (
        own.unionByName(without, allowMissingColumns=True)
        .select(
            "course_name",
            F.coalesce("test_pct", F.lit(0.0)).alias("my_score"),
            F.coalesce("avg_test", F.lit(0.0)).alias("batch_avg"),
        )
        .orderBy("course_name", "my_score")
    )


def own_weeks(t: Tables, full_name: str) -> DataFrame:
    return (
        _mine(t["gold_weekly_hours"], full_name).select(_label(), "total_hours").orderBy("week_label")
    )


# ---- pick-lists and principals ----------------------------------------------------

def mentor_names(t: Tables) -> DataFrame:
    return t["dim_mentor"].select("mentor_name").distinct().orderBy("mentor_name")


def intern_names(t: Tables) -> DataFrame:
    return t["dim_intern"].select("full_name").distinct().orderBy("full_name")


MANAGER_KEY, MANAGER_NAME = "admin", "Admin User"


def principals(t: Tables) -> DataFrame:
    """Everybody who has a view: (role, login key, name)."""
    def people(df: DataFrame, role: str, name: str) -> DataFrame:
        c = F.col(name)
        return df.filter(c != "").select(
            F.lit(role).alias("role"), principal_key(c).alias("login"), c.alias("real_name")
        )

    manager = t["dim_intern"].sparkSession.range(1).select(
        F.lit("Manager").alias("role"),
        F.lit(MANAGER_KEY).alias("login"),
        F.lit(MANAGER_NAME).alias("real_name"),
    )
    return (
        manager.unionByName(people(t["dim_mentor"], "Mentor", "mentor_name"))
        .unionByName(people(t["dim_intern"], "Intern", "full_name"))
    )


def principal(t: Tables, login: str, role: str) -> DataFrame:
    """The name behind a login; of several the first in alphabetical order. No password check."""
    key = login.strip().lower().replace(" ", "")
    rows = principals(t).filter((F.col("role") == role) & (F.col("login") == key))
    return top(rows, 1, asc("real_name"))


# ---- model results ----------------------------------------------------------------

def cluster_distribution(pca: DataFrame) -> DataFrame:
    return pca.groupBy("cluster_label").agg(F.count(F.lit(1)).alias("people")).orderBy(desc("people"), asc("cluster_label"))


def score_range(regression: DataFrame) -> DataFrame:
    a, p = "test_pct", "predicted_test_pct"
    return regression.agg(
        F.least(F.min(a), F.min(p)).alias("low"), F.greatest(F.max(a), F.max(p)).alias("high")
    )


def cluster_table(clusters: DataFrame) -> DataFrame:
    return clusters.select(
        "full_name", "cluster_label", "total_hours", "avg_progress_pct", "avg_test_pct", "courses_completed"
    ).orderBy(desc("total_hours"), asc("full_name"))
