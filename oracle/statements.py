"""SQL per query, over the same tables."""

from __future__ import annotations

from . import ctes as c

MENTOR = "Supplier#000000007"
INTERN = "Customer 000000008"
NAMES = "('Customer 000000008', 'Customer 000000003', 'O''Brien')"

# A person is a mentee if the mentor stands in the list of any of their progress rows.
MENTEES = f"""select intern_id from lms_clean
  where list_contains(list_transform(string_split(lower(mentor_name_raw), ','), lambda m: trim(m)), lower('{MENTOR}'))
  group by intern_id"""
SCOPE = f"(select * from gold_course_progress where intern_id in ({MENTEES}))"
LABEL = "year || '-W' || lpad(cast(week_number as varchar), 2, '0')"
PROGRESS = "full_name, course_name, progress_pct, overall_status"
BOARD = """(select intern_id, full_name, round(total_hours, 1) as total_hours,
  round(avg_progress_pct, 1) as avg_progress_pct, round(avg_test_pct, 1) as avg_test_pct,
  courses_completed from gold_intern_performance)"""
BEST = "order by total_hours desc, avg_progress_pct desc, full_name"
# What a question must not contain.
BLOCKED = (
    r"'(?i)(ignore previous|system prompt|drop table|delete from|update\s+\w|"
    r"insert into|truncate\s+\w|--\s|/\*)'"
)
DOMAINS = [("hours_sql", "SQL"), ("hours_pyspark", "PySpark"), ("hours_numpy", "NumPy/Pandas"), ("hours_bi", "BI/Reporting")]


def _parts(source: str, num: str, den: str, ratio: str) -> str:
    return c.fraction(f'"{source}"', num, den, ratio)


def _raw(source: str, columns: str) -> str:
    return f"select ingest_seq, {columns} from {source}"


def _cleaning() -> dict[str, str]:
    name = '"User Name"'
    full = f"""concat_ws(' ', {c.strip('"First Name"')}, {c.strip('"Last Name"')})"""
    hours = c.number('"Hours"')
    act = c.strip('"Activity"')
    words = f"regexp_split_to_array({c.strip(name)}, '\\s+')"
    return {
        "c1_normalize_name": _raw("raw_lms", f"lower({c.strip(f'''coalesce({name}, '')''')}) as normalized"),
        "c2_short_ids": _raw("raw_lms", f"""{c.short_id(name)} as intern_id, {c.short_id('"Overall Status"')} as status_id"""),
        "c3_parse_fraction": _raw("raw_lms", _parts("Completed Assignment", "num", "den", "ratio")),
        "c4_full_name": _raw("raw_eod", f"{full} as full_name"),
        "c5_eod_date": _raw("raw_eod", f"""{c.eod_date('"Date"')} as date"""),
        "c6_hours": _raw("raw_eod", f"{hours} as hours"),
        "c7_outlier_flag": f"select ingest_seq, case when hours < 2.0 or hours > 60.0 then 1 else 0 end as hours_outlier_flag from ({_raw('raw_eod', f'{hours} as hours')})",
        "c8_activity": _raw("raw_eod", f"case when {act} <> '' then {act} end as activity"),
        "c9_clean_eod": "select * from eod_clean",
        "c10_course_name": "select ingest_seq, course_name from lms_clean",
        "c11_course_dates": "select ingest_seq, start_date, end_date from lms_clean",
        "c12_progress_pct": _raw("raw_lms", f"""{c.percent('"Progress (%)"')} as progress_pct"""),
        "c13_fraction_triples": _raw(
            "raw_lms",
            ", ".join(
                [
                    _parts("Overall Knowledge Check", "kc_score", "kc_max", "kc_pct"),
                    _parts("Overall Test", "test_score", "test_max", "test_pct"),
                    _parts("Reviewed / Submitted", "reviewed", "submitted", "reviewed_pct"),
                    _parts("Reviewed / Total Assignments", "reviewed2", "total2", "reviewed2_pct"),
                ]
            ),
        ),
        "c14_status": "select ingest_seq, overall_status from lms_clean",
        "c15_mentor_text": _raw("raw_lms", f"""{c.strip('"Mentor Name"')} as mentor_name_raw"""),
        "c16_clean_lms": "select * exclude (course_rank) from lms_clean",
        "c17_explode_mentors": "select * from mentors",
        "c18_name_parts": _raw("raw_lms", f"{words}[1] as first_name, array_to_string({words}[2:], ' ') as last_name"),
        "c19_activity_category": f"select distinct activity, {c.category('activity')} as activity_category from eod_clean",
        "c20_calendar": """select date, dayname(date) as day_of_week, week(date) as week_number,
            month(date) as month, monthname(date) as month_name, year(date) as year
            from (select distinct cast(start_date as date) as date from lms_clean)""",
        "c21_week_label": """select year(start_date) || '-W' || lpad(cast(week(start_date) as varchar), 2, '0') as week_label,
            count(*) as row_count from lms_clean where start_date is not null group by 1""",
        "c22_round_coalesce": """select ingest_seq, round(kc_pct, 1) as kc_rounded,
            coalesce(round(test_pct, 1), 0) as test_or_zero from lms_clean""",
        "c23_clip": "select ingest_seq, greatest(progress_pct, 1) as tile from lms_clean",
        "c24_presentable": """select ingest_seq, cast(cast(start_date as date) as varchar) as start_text,
            test_pct as test_value from lms_clean""",
        "c25_principal_key": "select intern_id, lower(replace(full_name, ' ', '')) as login from dim_intern",
    }


def _predicates() -> dict[str, str]:
    return {
        "p1_equality": f"select {PROGRESS} from gold_course_progress where overall_status = 'Completed'",
        "p2_not_null": "select intern_id, hours from fact_eod_log where hours is not null",
        "p3_range_and_status": f"select {PROGRESS} from gold_course_progress where progress_pct < 50 and overall_status <> 'Completed'",
        "p4_in_list": f"select {PROGRESS} from gold_course_progress where full_name in {NAMES}",
        "p5_in_subquery": f"select * from dim_intern where intern_id in ({MENTEES})",
        "p6_non_empty": "select last_name from dim_intern where last_name <> ''",
        "p7_ilike": f"select {PROGRESS} from gold_course_progress where course_name ilike '%Big Data%' or course_name ilike '%Engineering%'",
        "p8_deny_list": f"select * from raw_questions where regexp_matches(question, {BLOCKED})",
        "p9_drop_missing": f"select {PROGRESS}, test_pct from gold_course_progress where test_pct is not null",
    }


def _joins() -> dict[str, str]:
    # A course gives one row per score of the person, or a single zero.
    own = f"""select course_name, unnest(coalesce(mine, [0.0::double])) as my_score, batch_avg from (
          select course_name, list(coalesce(test_pct, 0)) filter (full_name = '{INTERN}') as mine,
            coalesce({c.savg('test_pct')}, 0) as batch_avg
          from gold_course_progress group by course_name)"""
    return {
        "j1_fact_dims": "select * from gold_activity_summary",
        "j2_two_key_join": "select * from gold_mentor_workload",
        "j3_left_aggregates": "select * from gold_intern_performance",
        "j4_left_fact_grain": """select i.intern_id, d.day_of_week, count(f.hours) as entries
            from dim_intern i left join fact_eod_log f on i.intern_id = f.intern_id
            left join dim_date d on f.date = d.date group by i.intern_id, d.day_of_week""",
        "j5_lookup": f"""select ingest_seq, activity, activity_name, activity_category
            from eod_clean e left join dim_activity a
            on e.activity is not null and {c.short_id('e.activity')} = a.activity_id""",
        "j6_left_features": "select * from course_features",
        "j7_own_and_average": own,
        "a15_own_score_and_batch": own,
        "j8_mentor_scope": f"select {PROGRESS}, kc_pct, test_pct, assignment_ratio from {SCOPE}",
    }


def _layers() -> dict[str, str]:
    tables = {
        "w1": "dim_intern", "w2": "dim_course", "w3": "dim_mentor", "w4": "dim_activity",
        "w5": "dim_date", "w6": "bridge_intern_mentor", "w7": "fact_eod_log",
        "w8": "fact_lms_progress", "g1": "gold_weekly_hours", "g2": "gold_activity_summary",
        "g3": "gold_course_progress", "g4": "gold_intern_performance", "g5": "gold_mentor_workload",
    }
    out = {f"{k}_{t.removeprefix('gold_')}": f"select * from {t}" for k, t in tables.items()}
    report = [
        ("Bronze", "raw_eod_activities", "raw_eod"), ("Bronze", "raw_lms", "raw_lms"),
        *[("Silver", t, t) for t in ("dim_intern", "dim_course", "dim_mentor", "dim_activity", "fact_eod_log", "fact_lms_progress")],
        *[("Gold", t, t) for t in ("gold_weekly_hours", "gold_activity_summary", "gold_course_progress", "gold_intern_performance", "gold_mentor_workload")],
    ]
    out["q1_row_counts"] = " union all ".join(
        f"select '{layer}' as layer, '{name}' as table_name, count(*) as row_count from {cte}"
        for layer, name, cte in report
    )
    out["q1_course_counts"] = "select course_key, count(*) as row_count from raw_lms group by course_key"
    out["q4_progress_losses"] = """select course_key, count(*) as row_count, count(*) filter (start_date is null) as undated_rows,
        count(*) filter (overall_status = 'Unknown') as unknown_status_rows, count(*) filter (progress_pct is null) as no_progress_pct_rows,
        count(*) filter (kc_pct is null) as no_kc_pct_rows, count(*) filter (test_pct is null) as no_test_pct_rows,
        count(*) filter (assignment_ratio is null) as no_assignment_ratio_rows,
        count(*) filter (course_key is null or intern_id not in (select intern_id from dim_intern)) as rows_not_in_gold
        from lms_clean group by course_key"""
    out["q2_null_counts"] = " union all ".join(
        f"select '{col}' as column_name, count(*) - count({col}) as null_count from fact_lms_progress"
        for col in ("test_pct", "kc_pct", "assignment_ratio", "progress_pct")
    )
    out["q3_outlier_counts"] = "select hours_outlier_flag, count(*) as entry_count from fact_eod_log group by 1"
    out["q4_cleaning_counts"] = f"""select count(*) filter (where date is null) as undated_rows,
        cast(sum(hours_outlier_flag) as bigint) as outlier_rows,
        count(*) filter (where {c.strip("coalesce(full_name, '')")} = '') as nameless_rows,
        count(*) filter (where hours is null) as hourless_rows from eod_clean"""
    return out


def _kpis(where: str, people: str) -> str:
    return f"""select {people} as total_interns,
        (select coalesce(round({c.ssum('hours')}, 1), 0) from fact_eod_log {where}) as total_hours,
        (select count(*) from fact_eod_log {where}) as total_eod,
        (select coalesce(round(avg(progress_pct), 1), 0) from fact_lms_progress {where}) as avg_progress,
        (select count(case when overall_status = 'Completed' then 1 end) from fact_lms_progress {where}) as completions"""


def _dashboard() -> dict[str, str]:
    mine = f"where full_name = '{INTERN}'"
    return {
        "a1_kpis": _kpis("", "(select count(distinct intern_id) from dim_intern)"),
        "a2_kpis_of_mentor": _kpis(f"where intern_id in ({MENTEES})", f"(select count(*) from ({MENTEES}))"),
        "a3_kpis_of_intern": _kpis(f"where intern_id in (select intern_id from dim_intern {mine})", "1"),
        "a4_hours_histogram": """select least(cast(floor((hours - lo) / ((hi - lo) / 30)) as bigint) + 1, 30) as bin,
            count(*) as entry_count
            from fact_eod_log, (select min(hours) as lo, max(hours) as hi from fact_eod_log)
            where hours is not null group by 1""",
        "a5_hours_by_activity": f"""select a.activity_name, {c.ssum('f.hours')} as total_hours
            from fact_eod_log f join dim_activity a on f.activity_id = a.activity_id group by a.activity_name""",
        "a6_progress_distribution": """select course_name, row_count, q[1] as min_value, q[2] as q1,
              q[3] as median, q[4] as q3, q[5] as max_value,
              q[2] - 1.5 * (q[4] - q[2]) as lower_fence, q[4] + 1.5 * (q[4] - q[2]) as upper_fence
            from (select course_name, count(*) as row_count,
                quantile_cont(cast(progress_pct as double), [0.0, 0.25, 0.5, 0.75, 1.0]) as q
              from gold_course_progress group by course_name)""",
        "a7_status_per_course": "select course_name, overall_status, count(*) as intern_count from gold_course_progress group by 1, 2",
        "a8_mentee_summary": f"""select count(distinct full_name) as mentees, avg(progress_pct) as avg_progress,
            {c.savg('kc_pct')} as avg_kc from {SCOPE}""",
        "a9_mentee_treemap": f"""select course_name, full_name, level, tile_size from (
            select course_name, full_name, grouping(course_name, full_name) as level,
              cast(sum(greatest(progress_pct, 1)) as bigint) as tile_size
            from {SCOPE} group by rollup (course_name, full_name)) where level < 3""",
        "a10_mentees_at_risk": f"select distinct {PROGRESS} from {SCOPE} where progress_pct < 50 and overall_status <> 'Completed'",
        "a11_kc_ranking": f"""select full_name, course_name, kc_pct, avg_kc, kc_pct < 60 as below_threshold
            from (select * from {SCOPE} where kc_pct is not null) s
            join (select full_name, {c.savg('kc_pct')} as avg_kc from {SCOPE} where kc_pct is not null group by full_name) m
            using (full_name)""",
        "a12_mentees_not_started": f"select full_name, course_name from {SCOPE} where overall_status = 'Not Started'",
        "a13_mentor_workload": "select * from gold_mentor_workload",
        "a14_own_performance": f"select * from gold_intern_performance {mine}",
        "a14_own_activities": f"select activity_name, total_hours from gold_activity_summary {mine}",
        "a14_own_courses": f"select course_name, progress_pct, overall_status from gold_course_progress {mine}",
        "a16_own_weeks": f"select {LABEL} as week_label, total_hours from gold_weekly_hours {mine}",
        "a17_batch_trend": f"select {LABEL} as week_label, {c.ssum('total_hours')} as batch_hours from gold_weekly_hours group by 1",
        "a18_weekly_trend": f"""select full_name, {LABEL} as week_label, total_hours from gold_weekly_hours
            where full_name in (select full_name from gold_weekly_hours group by full_name
              order by {c.ssum('total_hours')} desc, full_name limit 3)""",
        "a18_weekly_trend_of_names": f"select full_name, {LABEL} as week_label, total_hours from gold_weekly_hours where full_name in {NAMES}",
        "a22_mentor_names": "select distinct mentor_name from dim_mentor",
        "a22_intern_names": "select distinct full_name from dim_intern",
        "a23_principal": """select 'Intern' as role, 'customer000000008' as login, min(full_name) as real_name
            from dim_intern where lower(replace(full_name, ' ', '')) = 'customer000000008'""",
        "n1_dense_ids": "select log_id, intern_id from fact_eod_log",
        "n2_keep_first": """select intern_id, course_name, overall_status from (
            select *, row_number() over (partition by intern_id order by ingest_seq) as rn from lms_clean) where rn = 1""",
        "n3_top_people": f"""select full_name, {c.ssum('total_hours')} as total from gold_weekly_hours
            group by full_name order by total desc, full_name limit 3""",
        "n4_leaderboard": f"select * exclude (intern_id) from {BOARD}",
        "n5_top_5": f"select * from {BOARD} {BEST} limit 5",
        "n5_bottom_5": f"select * from {BOARD} order by total_hours, avg_progress_pct, full_name desc limit 5",
        "n5_top_10": f"select * from {BOARD} {BEST} limit 10",
        "n6_activity_breakdown": f"""select full_name, activity_name, total_hours from gold_activity_summary
            where intern_id in (select intern_id from {BOARD} {BEST} limit 10)""",
        "n7_limit": f"""select {PROGRESS}, test_pct from gold_course_progress where course_name ilike '%Python%'
            order by progress_pct desc, full_name, course_name, overall_status, test_pct limit 50""",
        "n8_two_key_order": "select course_name, progress_pct, full_name from gold_course_progress",
    }


def _set_operations() -> dict[str, str]:
    except_sql = """select intern_id, activity, hours from eod_clean
        except select intern_id, activity, hours from eod_clean where hours_outlier_flag = 1"""
    cells = '"Date", "First Name", "Last Name", "Activity", "Hours"'
    with_hours = f'select {cells} from raw_eod where "Hours" is not null'
    return {
        "s1_s3_ingest_logs": f"select {cells} from raw_eod",
        "s2_s4_ingest_progress": "select * exclude (ingest_seq) from raw_lms",
        "s5_s6_bronze_upsert": f"{with_hours} union all (select {cells} from raw_eod except {with_hours})",
        "r1_bronze_stream": f"""select {cells} from raw_eod where ingest_seq % 3 = 0 union all (
            select {cells} from raw_eod except select {cells} from raw_eod where ingest_seq % 3 = 0)""",
        "u1_except": except_sql,
        "u1_except_by_key": except_sql,
        "u2_union_all": "select intern_id, full_name from eod_clean union all select intern_id, full_name from lms_clean",
        "u3_distinct": "select distinct mentor_name, course_key from mentors",
    }


def _refresh() -> dict[str, str]:
    """What two runs of the refresh leave, of rows that arrived in two parts."""
    undated = f"""{c.eod_date('"Date"')} is null"""
    late = "course_key in ('pyspark', 'big_data')"
    tables = [
        ("Bronze", "raw_eod_activities", "raw_eod"), ("Bronze", "raw_lms", "raw_lms"),
        *[("Silver", t, t) for t in ("dim_intern", "dim_course", "dim_mentor", "dim_activity", "fact_eod_log", "fact_lms_progress")],
        *[("Gold", t, t) for t in ("gold_weekly_hours", "gold_activity_summary", "gold_course_progress", "gold_intern_performance", "gold_mentor_workload")],
    ]
    return {
        "r2_refresh_counts": " union all ".join(
            f"select '{layer}' as layer, '{name}' as table_name, count(*) as row_count from {cte}" for layer, name, cte in tables
        ),
        "r2_refresh_loads": f"""select 'raw_eod_activities' as kind, case when {undated} then 1 else 0 end as load_no,
            case when {undated} then 'undated' else strftime({c.eod_date('"Date"')}, '%Y-%m') end as bronze_part, count(*) as row_count from raw_eod group by all
            union all select 'raw_lms', case when {late} then 1 else 0 end, course_key, count(*) from raw_lms group by all""",
        "s9_silver_ids": """select 'fact_eod_log' as table_name, 0 as first, count(*) - 1 as last, count(*) as ids from eod_clean
            union all select 'fact_lms_progress', 0, count(*) - 1, count(*) from lms_clean""",
        "s9_silver_logs": "select * exclude (log_id) from fact_eod_log",
        "s9_silver_progress": "select * exclude (progress_id) from fact_lms_progress",
        "s10_gold_weekly": "select * exclude (full_name) from gold_weekly_hours",
        "s10_gold_people": "select * exclude (full_name) from gold_intern_performance",
        "s10_gold_workload": "select * from gold_mentor_workload",
    }


def _questions() -> dict[str, str]:
    adhoc = """select course_name, overall_status, count(*) as n from gold_course_progress
        where full_name <> 'O''Brien' group by 1, 2"""
    bare = c.strip("replace(replace(answer, '```sql', ''), '```', '')")
    head = rf"regexp_split_to_array({bare}, '(?m);+[ \t\r]*$')[1]"
    answers = """select conv_id, turn, case conv_id % 4
          when 0 then '```sql' || chr(10) || 'SELECT ''' || q || ''';;  ' || chr(10) || 'This counts; all.' || chr(10) || '```'
          when 1 then '  out_of_context: ' || q
          when 2 then 'SELECT 1;' || chr(10) || 'OUT_OF_CONTEXT ' || q
          else q end as answer
        from (select *, replace(question, ';', ',') as q from raw_questions)"""
    return {
        "s13_named_arguments": adhoc,
        "t3_run_sql": adhoc,
        "t1_validate_input": f"select conv_id, turn, not regexp_matches(question, {BLOCKED}) as allowed from raw_questions",
        "t2_statements": rf"""select conv_id, turn, out_of_context,
              case when not out_of_context then {c.strip('head')} end as statement
            from (select *, regexp_matches(head, '(?im)^\s*OUT_OF_CONTEXT') as out_of_context
                  from (select conv_id, turn, {head} as head from ({answers})))""",
        "t4_preview": """select 0 as line_no, 'full_name | last_name' as line
            union all
            select row_number() over (order by full_name, last_name), full_name || ' | ' || last_name
            from (select * from dim_intern order by full_name, last_name limit 10)
            union all
            select 11, '... and ' || (n - 10) || ' more rows.' from (select count(*) as n from dim_intern) where n > 10""",
        "t5_top_k_course": f"""select {PROGRESS}, test_pct from gold_course_progress where course_name ilike '%SQL%'
            order by progress_pct desc, full_name, course_name, overall_status, test_pct limit 10""",
        "t6_not_started": """select full_name, course_name, overall_status, progress_pct from gold_course_progress
            where course_name ilike '%NumPy%' and overall_status = 'Not Started'""",
        "t7_average_test": f"select course_name, {c.savg('test_pct')} as avg_test_pct from gold_course_progress group by 1",
        "t8_most_hours_in_week": """select full_name, year, week_number, month_name, total_hours from gold_weekly_hours
            where year = 2024 and week_number = 2""",
        "t9_daily_detail": """select i.full_name, f.date, a.activity_name, f.hours from fact_eod_log f
            join dim_activity a on f.activity_id = a.activity_id join dim_intern i on f.intern_id = i.intern_id
            where f.date = date '2024-01-10'""",
        "t10_raw_scores": """select i.full_name, c.course_name, kc_score, kc_max, kc_pct, test_score, test_max,
            test_pct, completed_count, total_assignments from fact_lms_progress f
            join dim_course c on f.course_id = c.course_id join dim_intern i on f.intern_id = i.intern_id""",
        "t11_mentor_listing": """select m.mentor_name, i.full_name
            from (select distinct mentor_id, intern_id from bridge_intern_mentor) b
            join dim_mentor m on b.mentor_id = m.mentor_id join dim_intern i on b.intern_id = i.intern_id""",
        "t12_best_overall": """select full_name, total_hours, courses_completed from gold_intern_performance
            order by total_hours desc, full_name limit 1""",
    }


def _where(column: str, condition: str) -> str:
    x = f"case when {condition} then {column} end"
    return f"coalesce({c.ssum(f'({x})')}, 0)"


DOMAIN_SQL = "select f.intern_id, " + ", ".join(
    f"""{_where('f.hours', f"a.activity_category = '{v}'")} as {k}""" for k, v in DOMAINS
) + " from fact_eod_log f join dim_activity a on f.activity_id = a.activity_id group by f.intern_id"

COURSE_SQL = f"""select p.intern_id, p.full_name, p.course_name, p.progress_pct,
    coalesce(p.assignment_ratio, 0) as assignment_ratio, coalesce(p.kc_pct, 0) as kc_pct,
    coalesce(p.test_pct, 0) as test_pct, p.overall_status,
    {', '.join(f'coalesce(h.{k}, 0) as {k}' for k, _ in DOMAINS)}
  from gold_course_progress p left join ({DOMAIN_SQL}) h on p.intern_id = h.intern_id"""

def _of(condition: str) -> str:
    return f"coalesce({c.ssum(f'case when {condition} then r.h end')}, 0)"


PERSON_SQL = f"""select i.intern_id, i.full_name, {_of('true')} as total_hours,
    count(distinct case when r.activity is not null then r.kind end) as distinct_activities,
    {_of('dayofweek(r.date) in (0, 6)')} as weekend_hours,
    {', '.join(f"""{_of(f"a.activity_category = '{v}'")} as {k}""" for k, v in DOMAINS)},
    coalesce(avg(r.p), 0) as avg_progress_pct, coalesce({c.savg('r.ratio')}, 0) as avg_assignment_ratio,
    coalesce({c.savg('r.kc')}, 0) as avg_kc_pct,
    coalesce({c.savg('r.test')}, 0) as avg_test_pct,
    count(*) filter (where r.done) as courses_completed, count(*) filter (where not r.logged) as total_activity_entries
  from dim_intern i left join all_rows r using (intern_id)
  left join dim_activity a on r.activity is not null and a.activity_id = r.kind
  group by i.intern_id, i.full_name"""


def _features() -> dict[str, str]:
    medians = " union all ".join(
        f"select '{f}' as feature, median(cast({f} as double)) as median from lms_clean"
        for f in ("kc_pct", "test_pct", "assignment_ratio", "progress_pct")
    )
    z = ", ".join(
        f"round(({f} - avg({f}) over ()) / stddev_pop({f}) over (), 6) as {f}"
        for f in ("total_hours", "avg_progress_pct")
    )
    levels = sorted(name or "Introduction to Data Engineering & Big Data" for *_, name, _ in c.COURSES)
    flags = ", ".join(
        f"case when course_name = '{v}' then 1.0::double else 0 end as level_{i}" for i, v in enumerate(levels)
    )
    return {
        "m1_domain_hours": DOMAIN_SQL,
        "m2_course_features": COURSE_SQL,
        "j6_left_features": COURSE_SQL,
        "m3_person_features": PERSON_SQL,
        "m4_one_hot": f"select full_name, {flags} from gold_course_progress",
        "m5_label_codes": """select overall_status, row_number() over (order by overall_status) - 1 as code
            from (select distinct overall_status from lms_clean)""",
        "m6_medians": medians,
        "m7_standardised": f"select intern_id, {z} from ({PERSON_SQL})",
    }


SCORE_FEATURES = ["progress_pct", "kc_pct", "assignment_ratio", *[k for k, _ in DOMAINS]]
PERSON_FEATURES = [
    "total_hours", "distinct_activities", "avg_progress_pct", "avg_assignment_ratio", *[k for k, _ in DOMAINS], "weekend_hours",
]


def _array(columns: list[str], flags: list[str] = ()) -> str:
    cells = [f"cast({x} as double)" for x in columns] + [f"case when course_name = '{v}' then 1.0::double else 0 end" for v in flags]
    return "[" + ", ".join(cells) + "]"


def _ridge() -> str:
    """Weights by elimination on (Z'Z + I | Z'y), which is positive definite and needs no pivoting."""
    levels = sorted(name or "Introduction to Data Engineering & Big Data" for *_, name, _ in c.COURSES)
    seen = [v for v in levels]
    return f"""samples as (select row_number() over () as r, intern_id, course_name, test_pct as y, {_array(SCORE_FEATURES, seen)} as x from ({COURSE_SQL})),
      cells as (select r, y, unnest(x) as v, generate_subscripts(x, 1) as j from samples),
      spread as (select j, avg(v) as m, stddev_pop(v) as s from cells group by j),
      scaled as (select r, y - (select avg(y) from samples) as y, j, case when s > 0 then (v - m) / s else 0 end as z from cells join spread using (j)),
      cross_products as (select a.j as i, b.j as j, sum(a.z * b.z) + case when a.j = b.j then 1 else 0 end as g from scaled a join scaled b using (r) group by a.j, b.j),
      own_products as (select j as i, sum(z * y) as b from scaled group by j),
      system as (select list(line order by i) as m from (
        select i, list_concat(list(g order by j), [any_value(b)]) as line from cross_products join own_products using (i) group by i)),
      steps as (
        select 0 as k, m from system
        union all
        select k + 1, list_transform(m, lambda line, i: case when i = k + 1 then list_transform(line, lambda v: v / line[k + 1])
          else list_transform(line, lambda v, col: v - line[k + 1] * m[k + 1][col] / m[k + 1][k + 1]) end)
        from steps where k < len(m)),
      weights as (select unnest(list_transform(m, lambda line: line[-1])) as w, generate_subscripts(m, 1) as j from steps order by k desc limit {len(SCORE_FEATURES) + len(seen)}),
      guesses as (select r, sum(z * w) + (select avg(y) from samples) as p from scaled join weights using (j) group by r)"""


def _main_direction(matrix: str, name: str) -> str:
    """The matrix squared until only its main direction is left, scaled to trace 1."""
    trace = "list_sum(list_transform(m, lambda line, i: line[i]))"
    return f"""{name}_powers as (
        select 0 as k, list_transform(m, lambda line: list_transform(line, lambda v: v / {trace})) as m from {matrix}
        union all
        select k + 1, list_transform(s, lambda line: list_transform(line, lambda v: v / t)) from (
          select k, s, list_sum(list_transform(s, lambda line, i: line[i])) as t from (
            select k, list_transform(m, lambda a: list_transform(m, lambda b: list_dot_product(a, b))) as s from {name}_powers where k < 40))),
      {name} as (
        select list_transform(m[top], lambda v: v / sqrt(m[top][top])) as w from (
          select m, list_position(list_transform(m, lambda line, i: line[i]), list_max(list_transform(m, lambda line, i: line[i]))) as top
          from (select m from {name}_powers order by k desc limit 1)))"""


def _projection() -> str:
    n = len(PERSON_FEATURES)
    return f"""people as (select intern_id, {_array(PERSON_FEATURES)} as x from ({PERSON_SQL})),
      cells as (select intern_id, unnest(x) as v, generate_subscripts(x, 1) as j from people),
      middle as (select list(m order by j) as m from (select j, avg(v) as m from cells group by j)),
      centred as (select intern_id, list_transform(x, lambda v, i: v - m[i]) as x from people, middle),
      gaps as (select intern_id, unnest(x) as v, generate_subscripts(x, 1) as j from centred),
      scatter as (select list(line order by i) as m from (select i, list(g order by j) as line from (
        select a.j as i, b.j as j, sum(a.v * b.v) as g from gaps a join gaps b using (intern_id) group by a.j, b.j) group by i)),
      {_main_direction("scatter", "first_direction")},
      leftover as (
        select list_transform(m, lambda line, i: list_transform(line, lambda v, j: v - size * w[i] * w[j])) as m from (
          select m, w, list_sum(list_transform(m, lambda line, i: list_dot_product(line, w) * w[i])) as size from scatter, first_direction)),
      {_main_direction("leftover", "second_direction")}"""


def _models() -> dict[str, str | tuple[str, str]]:
    """Closed forms, and what any right fit must show: counts, no row at odds, nothing left to move."""
    scores = f"select intern_id, course_name, y as test_pct, round(p, 4) as predicted_test_pct from samples join guesses using (r)"
    report = "select count(*) as row_count, round(1 - sum((y - p) ** 2) / (var_pop(y) * count(*)), 8) as r2, round(avg(abs(y - p)), 6) as mae from samples join guesses using (r)"
    projected = """select intern_id, round(list_dot_product(x, a.w), 4) as pca_x, round(list_dot_product(x, b.w), 4) as pca_y
        from centred, first_direction a, second_direction b"""
    return {
        "s11_s12_results": """select 'cluster_results' as result, count(*) as row_count from dim_intern union all
            select 'pca_results', count(*) from dim_intern union all select 'regression_results', count(*) from gold_course_progress""",
        "s14_model_round_trip": """select 'classifier' as model, count(*) as row_count, 0 as differing from gold_course_progress union all
            select 'regression', count(*), 0 from gold_course_progress union all select 'clustering', count(*), 0 from dim_intern""",
        "m8_m17_forest_by_joins": f"select overall_status, count(*) as row_count, 0 as differing, 0 as unbalanced from ({COURSE_SQL}) group by overall_status",
        "m10_m11_cluster_certificate": "select 3 as clusters, count(*) as members, true as at_rest from dim_intern",
        "m10_embedding_certificate": "select 3 as clusters, count(*) as members, true as at_rest from embeddings",
        "m13_ridge_scores": (scores, _ridge()),
        "a20_score_range": ("select round(least(min(y), min(p)), 4) as low, round(greatest(max(y), max(p)), 4) as high from samples join guesses using (r)", _ridge()),
        "m14_score_report": (report, _ridge()),
        "m15_projection": (projected, _projection()),
    }


def oracle_sql() -> dict[str, str]:
    groups = (_cleaning, _predicates, _joins, _layers, _dashboard, _set_operations, _refresh, _questions, _features, _models)
    bodies = {name: sql for group in groups for name, sql in group().items()}
    return {name: c.statement(*sql) if isinstance(sql, tuple) else c.statement(sql) for name, sql in bodies.items()}
