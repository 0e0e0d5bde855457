"""The SQL each query is compared with, for DuckDB.

Written from the definitions, in plain SQL over named sub-queries. Two habits:
rounding goes through the shortest decimal text of a double, which is what Spark
rounds, and integer results are cast to Spark's widths.
"""

from __future__ import annotations

from collections.abc import Sequence

from lectern import schema
from lectern.operators import advice
from lectern.sources.views import LEARNING, ODS_LEARNING, RAW_COLUMNS, RAW_LEARNING, TABLES

_PLAIN = {name: name for name in (*TABLES, "learning")}


def r(expression: str, digits: int = 2) -> str:
    """Half-up rounding of a double by its decimal text."""
    text = f"cast(cast({expression} AS string) AS decimal(38,18))"
    return f"cast(round({text}, {digits}) AS double)"


def avg(column: str, digits: int = 2) -> str:
    return r(f"avg({column})", digits)


def pct(part: str, total: str) -> str:
    return f"CASE WHEN {total} = 0 THEN 0.0 ELSE {r(f'cast({part} AS double) / {total} * 100')} END"


def _in(values) -> str:
    return ", ".join("'" + str(v) + "'" for v in values)


# --------------------------------------------------------------------------
# Named sub-queries: name -> (needs, text)
# --------------------------------------------------------------------------
def _num(text: str) -> str:
    pattern = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
    return (
        f"CASE WHEN regexp_matches(trim({text}), '{pattern}') "
        f"THEN try_cast(trim({text}) AS double) END"
    )


def _tidy(text: str) -> str:
    return rf"regexp_replace(trim({text}), '\s+', ' ', 'g')"


def _token(text: str) -> str:
    return f"CASE WHEN {text} IN ({_in(schema.NULL_TOKENS)}) THEN NULL ELSE {text} END"


_YES = [k for k, v in schema.FLAG_SPELLINGS.items() if v == 1]
_NO = [k for k, v in schema.FLAG_SPELLINGS.items() if v == 0]


def _gender(text: str) -> str:
    cases = " ".join(
        f"WHEN '{k}' THEN '{v}'" for k, v in schema.GENDER_SPELLINGS.items()
    )
    return f"CASE lower({text}) {cases} ELSE 'Unknown' END"


def _flag(text: str) -> str:
    return (
        f"CASE WHEN lower(trim({text})) IN ({_in(_YES)}) THEN 1.0e0 "
        f"WHEN lower(trim({text})) IN ({_in(_NO)}) THEN 0.0e0 ELSE {_num(text)} END"
    )


_SPACE = "chr(12288) || ' '"


def _percent(text: str) -> str:
    text = f"trim({text}, {_SPACE})"
    number = _num(f"replace({text}, '%', '')")
    return (
        f"CASE WHEN NOT contains({text}, '%') AND ({number}) BETWEEN 0 AND 1 "
        f"THEN ({number}) * 100 ELSE {number} END"
    )


def _date(text: str) -> str:
    iso = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T].*)?$"
    return (
        f"CASE WHEN regexp_matches({text}, '{iso}') THEN try_cast(regexp_extract({text}, '^[0-9-]+') AS date)"
        f" ELSE cast(coalesce(try_strptime({text}, '%Y/%m/%d'), try_strptime({text}, '%Y.%m.%d')) AS date) END"
    )


def _even(value: str) -> str:
    return f"round_even(({value}) * 100, 0) / 100"


def _clean_column(name: str) -> str:
    """A raw column after the steps that look at one row."""
    if name == "Gender":
        return _gender(_token(_tidy(name)))
    if name in schema.RAW_TEXT:
        text = _token(_tidy(name))
        return f"coalesce({text}, 'Unknown')" if name in schema.RAW_CATEGORY else text
    if name in schema.RAW_PERCENT:
        return _percent(name)
    if name in schema.RAW_FLAG:
        return _flag(name)
    if name in schema.RAW_DATE:
        return _date(name)
    return _num(name)


_MEASURES = [
    c
    for c in [*schema.RAW_INTEGER, *schema.RAW_FLOAT, *schema.RAW_PERCENT, *schema.RAW_FLAG]
    if c != schema.RAW_TARGET
]


def _finished(name: str) -> str:
    """A cleaned column as it leaves: filled, rounded, dates as text."""
    if name in schema.RAW_DATE:
        return f"cast({name} AS string)"
    if name in schema.RAW_TEXT:
        return f"coalesce({name}, 'Unknown')"
    filled = f"coalesce({name}, m_{name})" if name in _MEASURES else name
    if name in schema.RAW_INTEGER or name in schema.RAW_FLAG:
        return f"cast(round_even({filled}, 0) AS bigint)"
    return _even(filled)


_SUBMITTED, _MISSED = (f"coalesce({c}, m_{c})" for c in ("Assignments_Submitted", "Assignments_Missed"))
_RATE = _even(
    f"CASE WHEN {_SUBMITTED} + {_MISSED} > 0 THEN "
    + _even(f"{_SUBMITTED} / ({_SUBMITTED} + {_MISSED}) * 100")
    + " ELSE 0.0 END"
)

LINE = "l_orderkey, l_linenumber, l_suppkey, l_extendedprice"
LINE_DESC = ", ".join(f"{c} DESC" for c in LINE.split(", "))

_NEWEST = "row_number() OVER (PARTITION BY Student_ID, Course_ID ORDER BY " + LINE_DESC + ")"
_BAD = " OR ".join(
    f"({c} IS NOT NULL AND NOT {c} BETWEEN {low} AND {high})" for c, (low, high) in schema.RAW_RANGES.items()
)
_INCOMPLETE = (
    "Student_ID IS NULL OR Course_ID IS NULL OR Course_Name IS NULL OR Completed IS NULL"
)

# Every rule reads a missing measure as 0.
_RULES = {
    "login": "coalesce(login_frequency, 0) < 4 OR coalesce(days_since_last_login, 0) > 10",
    "assignment": "coalesce(assignment_submission_rate, 0) < 50 OR coalesce(assignments_missed, 0) > 4",
    "progress": "coalesce(progress_percentage, 0) < 30 AND coalesce(video_completion_rate, 0) < 40",
    "score": "coalesce(quiz_score_avg, 0) < 55",
}
_FLAGS = ", ".join(f"({rule}) AS {name}_risk" for name, rule in _RULES.items())
_RISK_SUM = " + ".join(f"cast({name}_risk AS int)" for name in _RULES)

_TREND = f"""count(*) AS learning_times, count(DISTINCT student_id) AS learner_count,
 count(DISTINCT course_id) AS course_count,
 {r('sum(time_spent_hours)')} AS total_study_time_hours, {avg('time_spent_hours')} AS avg_study_time_hours,
 {avg('average_session_duration_min')} AS avg_session_duration_min,
 {avg('progress_percentage')} AS avg_progress_percentage, {avg('quiz_score_avg')} AS avg_quiz_score"""
_TREND_FILTER = (
    "enrollment_date IS NOT NULL AND student_id IS NOT NULL"
    " AND course_id IS NOT NULL AND time_spent_hours IS NOT NULL"
)


def _typed_column(name: str, kind: str) -> str:
    if kind == "double":
        return f"{_num(name)} AS {name}"
    if kind == "int":
        number = _num(name)
        return f"cast(trunc({number}) AS int) AS {name}"
    if kind == "date":
        return f"{_date(name)} AS {name}"
    return name


CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "learning": ((), LEARNING.format(**_PLAIN)),
    "raw": ((), RAW_LEARNING.format(**_PLAIN)),
    "tokens": (
        ("raw",),
        f"""SELECT {LINE}, {_token(_tidy('Student_ID'))} AS Student_ID,
 {_token(_tidy('Gender'))} AS Gender, {_token(_tidy('City'))} AS City FROM raw""",
    ),
    "normal": (
        ("raw",),
        f"SELECT {LINE}, " + ", ".join(f"{_clean_column(c)} AS {c}" for c in RAW_COLUMNS) + " FROM raw",
    ),
    "complete": (("normal",), f"SELECT * FROM normal WHERE NOT ({_INCOMPLETE})"),
    "newest": (
        ("complete",),
        f"SELECT * EXCLUDE nth FROM (SELECT *, {_NEWEST} AS nth FROM complete) WHERE nth = 1",
    ),
    "valid": (("newest",), f"SELECT * FROM newest WHERE NOT ({_BAD})"),
    "medians": (
        ("valid",),
        "SELECT " + ", ".join(f"coalesce(median({c}), 0) AS m_{c}" for c in _MEASURES) + " FROM valid",
    ),
    "enrolled": (
        ("learning",),
        """SELECT * EXCLUDE nth FROM (SELECT *, row_number() OVER (PARTITION BY student_id, course_id
 ORDER BY enrollment_date DESC, payment_amount DESC, login_frequency DESC) AS nth FROM learning) WHERE nth = 1""",
    ),
    "ods": (("learning",), ODS_LEARNING.format(**_PLAIN)),
    "typed": (
        ("ods",),
        "SELECT "
        + ", ".join(_typed_column(n, k) for n, k in schema.ENROLMENT_COLUMNS)
        + " FROM ods",
    ),
    "scored": (
        ("learning",),
        f"""SELECT *, CASE WHEN risk_sum >= 3 THEN '{schema.HIGH}' WHEN risk_sum = 2 THEN '{schema.MID}'
 WHEN risk_sum = 1 THEN '{schema.LOW}' ELSE '{schema.SAFE}' END AS warning_level
 FROM (SELECT *, cast({_RISK_SUM} AS int) AS risk_sum FROM (SELECT *, {_FLAGS} FROM learning))""",
    ),
    "course_risk": (
        ("scored",),
        f"""SELECT course_id, max(course_name) AS course_name, count(*) AS student_count,
 count(*) FILTER (WHERE warning_level = '{schema.HIGH}') AS high_risk_count,
 count(*) FILTER (WHERE warning_level = '{schema.MID}') AS mid_risk_count,
 count(*) FILTER (WHERE warning_level = '{schema.LOW}') AS low_risk_count,
 count(*) FILTER (WHERE warning_level = '{schema.SAFE}') AS safe_count,
 {avg('quiz_score_avg')} AS avg_quiz_score, {avg('assignment_submission_rate')} AS avg_submit_rate,
 {avg('progress_percentage')} AS avg_progress,
 {avg('video_completion_rate')} AS avg_video_completion_rate,
 {avg('time_spent_hours')} AS avg_study_time_hours,
 {pct(f"count(*) FILTER (WHERE warning_level = '{schema.HIGH}')", 'count(*)')} AS high_risk_pct
 FROM scored GROUP BY course_id""",
    ),
    "platform": (
        ("course_risk",),
        """SELECT avg(avg_quiz_score) AS platform_score, avg(avg_submit_rate) AS platform_submit,
 avg(avg_progress) AS platform_progress, avg(avg_video_completion_rate) AS platform_video,
 avg(high_risk_pct) AS platform_risk FROM course_risk""",
    ),
    "course_stat": (
        ("learning",),
        f"""SELECT course_id, max(course_name) AS course_name, max(category) AS category,
 max(course_level) AS course_level, max(course_duration_days) AS course_duration_days,
 count(*) AS learner_count, cast(sum(completed) AS bigint) AS completion_count,
 {r('avg(completed) * 100')} AS completion_rate,
 {avg('time_spent_hours', 6)} AS avg_study_time_hours,
 {avg('progress_percentage', 6)} AS avg_progress_percentage,
 {avg('video_completion_rate', 6)} AS avg_video_completion_rate,
 {avg('assignment_submission_rate', 6)} AS avg_assignment_submit_rate,
 {avg('quiz_score_avg', 6)} AS avg_quiz_score, {avg('project_grade', 6)} AS avg_project_grade,
 {avg('instructor_rating', 6)} AS avg_instructor_rating,
 {avg('satisfaction_rating', 6)} AS avg_satisfaction_rating,
 {avg('app_usage_percentage', 6)} AS avg_app_usage_percentage
 FROM learning GROUP BY course_id""",
    ),
    "student_feature": (
        ("learning",),
        f"""SELECT student_id, count(*) AS course_count,
 cast(sum(completed) AS bigint) AS completed_course_count,
 {r('avg(completed) * 100')} AS completion_rate,
 {r('sum(time_spent_hours)', 6)} AS total_study_time_hours,
 {avg('average_session_duration_min', 6)} AS avg_session_duration_min,
 {avg('login_frequency', 6)} AS avg_login_frequency,
 {avg('video_completion_rate', 6)} AS avg_video_completion_rate,
 {avg('progress_percentage', 6)} AS avg_progress_percentage,
 {avg('assignment_submission_rate', 6)} AS avg_assignment_submit_rate,
 {avg('quiz_score_avg', 6)} AS avg_quiz_score, {avg('project_grade', 6)} AS avg_project_grade,
 {avg('discussion_participation', 6)} AS avg_discussion_participation,
 {avg('peer_interaction_score', 6)} AS avg_peer_interaction_score,
 {avg('app_usage_percentage', 6)} AS avg_app_usage_percentage,
 {avg('satisfaction_rating', 6)} AS avg_satisfaction_rating,
 {avg('days_since_last_login', 6)} AS avg_days_since_last_login,
 cast(sum(assignments_missed) AS bigint) AS total_assignments_missed
 FROM learning GROUP BY student_id""",
    ),
    "enrollment": (
        ("learning",),
        """SELECT cast(dense_rank() OVER (ORDER BY learner_count DESC) AS int) AS enrollment_rank,
 course_id, course_name, learner_count
 FROM (SELECT course_id, course_name, count(DISTINCT student_id) AS learner_count
  FROM learning WHERE course_id IS NOT NULL AND course_id <> '' AND course_name IS NOT NULL
  AND course_name <> '' AND student_id IS NOT NULL AND student_id <> ''
  GROUP BY course_id, course_name)""",
    ),
    "resources": (
        ("learning",),
        f"""SELECT course_id AS resource_id, course_name AS resource_name, category AS resource_category,
 course_level AS resource_level, count(DISTINCT student_id) AS learner_count,
 cast(sum(login_frequency) AS double) AS access_volume, {avg('app_usage_percentage')} AS avg_usage_rate,
 {avg('video_completion_rate')} AS avg_video_completion_rate,
 cast(sum(rewatch_count) AS bigint) AS total_rewatch_count,
 {avg('notifications_checked')} AS avg_notifications_checked,
 {avg('reminder_emails_clicked')} AS avg_reminder_clicks,
 {avg('time_spent_hours')} AS avg_study_time_hours
 FROM learning WHERE course_id IS NOT NULL AND course_name IS NOT NULL
 GROUP BY course_id, course_name, category, course_level""",
    ),
    "weekly": (
        ("learning",),
        f"""SELECT stat_year, stat_week,
 concat(cast(stat_year AS string), '-W', lpad(cast(stat_week AS string), 2, '0')) AS week_label, * EXCLUDE (stat_year, stat_week)
 FROM (SELECT cast(year(enrollment_date) AS int) AS stat_year,
  cast(weekofyear(enrollment_date) AS int) AS stat_week, {_TREND}
  FROM learning WHERE {_TREND_FILTER} GROUP BY 1, 2)""",
    ),
    "features": (
        ("learning",),
        f"""SELECT student_id, {r('avg(completed) * 100')} AS f_completion, {avg('project_grade')} AS f_grade,
 {avg('quiz_score_avg')} AS f_score, {avg('video_completion_rate')} AS f_video
 FROM learning GROUP BY student_id""",
    ),
    "profile": (
        ("scored", "features", "course_risk"),
        """SELECT s.*, coalesce(s.time_spent_hours, 0) AS value_time, coalesce(f_completion, 0) AS value_completion,
 coalesce(f_video, 0) AS value_video, coalesce(f_grade, 0) AS value_grade, coalesce(f_score, 0) AS value_score,
 coalesce(c.avg_study_time_hours, 0) AS bench_time, coalesce(c.avg_progress, 0) AS bench_completion,
 coalesce(c.avg_video_completion_rate, 0) AS bench_video, coalesce(c.avg_submit_rate, 0) AS bench_grade,
 coalesce(c.avg_quiz_score, 0) AS bench_score
 FROM scored s LEFT JOIN features f ON s.student_id = f.student_id
 LEFT JOIN course_risk c ON s.course_id = c.course_id""",
    ),
    "weakest": (
        ("profile",),
        "SELECT *, CASE "
        + " ".join(
            f"WHEN ratio_{m} = lowest THEN '{label}'"
            for m, label in schema.STUDENT_MEASURES.items()
        )
        + f" ELSE '{schema.STABLE_MEASURE}' END AS weakest_measure FROM (SELECT *, least("
        + ", ".join(f"ratio_{m}" for m in schema.STUDENT_MEASURES)
        + ") AS lowest FROM (SELECT *, "
        + ", ".join(
            f"CASE WHEN value_{m} < bench_{m} * 0.92e0 THEN value_{m} / bench_{m} END AS ratio_{m}"
            for m in schema.STUDENT_MEASURES
        )
        + " FROM profile))",
    ),
    "personas": (
        ("profile",),
        f"""SELECT *, CASE
 WHEN value_completion >= bench_completion * 1.08e0 AND value_score >= bench_score * 1.05e0
  AND value_time >= bench_time * 1.05e0 THEN '{schema.PERSONA_LABELS["leader"]}'
 WHEN value_completion >= bench_completion AND value_video >= bench_video
  AND value_grade >= bench_grade THEN '{schema.PERSONA_LABELS["advancing"]}'
 WHEN warning_level = '{schema.HIGH}' THEN '{schema.PERSONA_LABELS["at_risk"]}'
 WHEN warning_level = '{schema.MID}' THEN '{schema.PERSONA_LABELS["wavering"]}'
 ELSE '{schema.PERSONA_LABELS["steady"]}' END AS persona_label FROM profile""",
    ),
    "details": (
        ("scored",),
        "SELECT student_id, course_id, course_name, warning_level, risk_sum, "
        + ", ".join(
            f"CASE WHEN {n}_risk THEN '{schema.RULE_LABELS[n][0]}' ELSE '{schema.RULE_LABELS[n][1]}' END AS {n}_rule"
            for n in _RULES
        )
        + ", progress_percentage, concat("
        + ", ' / ', ".join(
            f"'{schema.RULE_TITLES[n]}:', CASE WHEN {n}_risk THEN '{schema.RULE_WORDS[0]}' ELSE '{schema.RULE_WORDS[1]}' END"
            for n in _RULES
        )
        + ") AS rule_summary FROM scored",
    ),
}


def _needed(names: tuple[str, ...], found: list[str]) -> list[str]:
    for name in names:
        _needed(CTES[name][0], found)
        if name not in found:
            found.append(name)
    return found


def query(body: str, *names: str) -> str:
    parts = [f"{n} AS ({CTES[n][1]})" for n in _needed(names, [])]
    return "WITH " + ",\n".join(parts) + "\n" + body


def _summed(name: str, table: str, texts: Sequence[str], numbers: Sequence[str]) -> str:
    """One row on a table: its rows, the sum of all its numbers, the characters of its texts."""

    def total(cells: list[str]) -> str:
        return " + ".join(f"coalesce(sum({c}), 0)" for c in cells) or "0"

    return (
        f"SELECT '{name}' AS name, count(*) AS row_count,"
        f" round(cast({total([f'cast({c} AS double)' for c in numbers])} AS double), 2) AS number_sum,"
        f" cast({total([f'length({c})' for c in texts])} AS bigint) AS text_chars FROM ({table})"
    )


def _kinds(columns: Sequence[tuple[str, str]]) -> tuple[list[str], list[str]]:
    """Text and number columns of a served table, without the times of the load."""
    kept = [(n, k) for n, k in columns if n not in ("update_date", "create_time", "update_time")]
    return [n for n, k in kept if k == "string"], [n for n, k in kept if k != "string"]


# Dataset of the report: text columns, number columns.
_EXPORTED = {
    "overview_metrics": ([], ["student_count", "course_count", "resource_count", "total_study_time_hours"]),
    "weekly_learning_statistics": (
        ["week_label"],
        ["stat_year", "stat_week", "learning_times", "learner_count", "course_count", "total_study_time_hours"]
        + ["avg_study_time_hours", "avg_session_duration_min", "avg_progress_percentage", "avg_quiz_score"],
    ),
    "course_enrollment_ranking": (["course_id", "course_name"], ["enrollment_rank", "learner_count"]),
    "warning_level_summary": (["warning_level"], ["student_count", "risk_ratio_pct"]),
    "course_risk_summary": (
        ["course_id", "course_name"],
        ["student_count", "high_risk_count", "mid_risk_count", "low_risk_count", "safe_count", "avg_quiz_score"]
        + ["avg_submit_rate", "avg_progress", "avg_video_completion_rate", "avg_study_time_hours", "high_risk_pct"],
    ),
    "education_risk_summary": (
        ["education_level"],
        ["student_count", "high_risk_count", "safe_count", "avg_total_study_hours", "avg_quiz_score"]
        + ["avg_submit_rate", "ratio_pct", "high_risk_pct", "safe_pct"],
    ),
    "student_warning_detail": (
        ["student_id", "course_id", "course_name", "warning_level", "login_rule", "assignment_rule"]
        + ["progress_rule", "score_rule", "rule_summary"],
        ["risk_sum", "progress_percentage"],
    ),
}


# --------------------------------------------------------------------------
# One statement per query
# --------------------------------------------------------------------------
_TEXT_DATE = "* REPLACE (cast(enrollment_date AS string) AS enrollment_date)"
_ALL_FACTS = f"SELECT {_TEXT_DATE} FROM learning"
_PLATFORM = {
    "avg_quiz_score": "platform_score",
    "avg_submit_rate": "platform_submit",
    "avg_progress": "platform_progress",
    "avg_video_completion_rate": "platform_video",
}


def _decimal(value: str, kind: str) -> str:
    exact = f"cast(cast({value} AS string) AS decimal(38,18))"
    return f"coalesce(cast(try_cast({exact} AS {kind}) AS double), 0.0)"


def _served(table: str, source: str) -> str:
    """A served summary: its averages straight from the facts, as exact decimals."""
    means = {
        "avg_study_time_hours": "time_spent_hours",
        "avg_session_duration_min": "average_session_duration_min",
        "avg_assignment_submit_rate": "assignment_submission_rate",
        "avg_quiz_score": "quiz_score_avg",
    }
    own = {
        "learner_count": "count(*)",
        "course_count": "count(*)",
        "completion_count": "cast(sum(completed) AS bigint)",
        "completed_course_count": "cast(sum(completed) AS bigint)",
        "total_assignments_missed": "cast(sum(assignments_missed) AS bigint)",
        "completion_rate": r("avg(completed) * 100"),
        "total_study_time_hours": "sum(time_spent_hours)",
    }
    key = schema.TARGET_KEYS[table][0]
    out = []
    for name, kind in schema.TARGETS[table]:
        if name == key:
            out.append(name)
        elif kind.startswith("decimal"):
            value = own.get(name) or f"avg({means.get(name, name.removeprefix('avg_'))})"
            out.append(f"{_decimal(value, kind)} AS {name}")
        elif kind in ("string", "int", "bigint"):
            out.append(f"{own.get(name, f'max({name})')} AS {name}")
    return f"SELECT {', '.join(out)} FROM {source} GROUP BY {key}"


def _conformed(table: str = "typed") -> str:
    source = {
        "total_study_time_hours": "time_spent_hours",
        "avg_session_duration_min": "average_session_duration_min",
        "course_progress_rate": "progress_percentage",
        "course_completed": "completed",
        "assignment_submit_rate": "assignment_submission_rate",
    }
    out = []
    for name, kind in schema.TARGETS["student_stat"]:
        column = source.get(name, name)
        if kind.startswith("decimal"):
            value = _decimal(column, kind)
        elif kind in ("int", "tinyint"):
            value = f"coalesce(try_cast({column} AS {kind}), 0)"
        elif kind == "string":
            value = column
        else:
            continue
        out.append(f"{value} AS {name}")
    return "SELECT " + ", ".join(out) + f" FROM {table}"


def _overflow(column: str, limit: str) -> str:
    return f"count(*) FILTER (WHERE abs({column}) >= {limit})"


def all_oracles() -> dict[str, str]:
    high = schema.HIGH
    marts = {
        "course_score": query(
            f"""SELECT course_id, course_name, count(*) AS student_count,
 {avg('quiz_score_avg')} AS avg_quiz_score, {avg('project_grade')} AS avg_project_grade
 FROM learning WHERE course_id IS NOT NULL AND course_name IS NOT NULL AND quiz_score_avg IS NOT NULL
 GROUP BY course_id, course_name""",
            "learning",
        ),
        "course_core": query(
            f"""SELECT course_id, course_name, count(*) AS learner_count,
 count(*) FILTER (WHERE completed = 1) AS completion_count,
 {r('cast(count(*) FILTER (WHERE completed = 1) AS double) / count(*) * 100')} AS completion_rate,
 {avg('quiz_score_avg')} AS avg_quiz_score, {avg('project_grade')} AS avg_project_grade,
 {avg('progress_percentage')} AS avg_progress, {avg('time_spent_hours')} AS avg_study_time,
 {avg('video_completion_rate')} AS avg_video_completion,
 {avg('average_session_duration_min')} AS avg_session_duration,
 {avg('login_frequency')} AS avg_login_frequency
 FROM learning WHERE course_id IS NOT NULL AND course_name IS NOT NULL GROUP BY course_id, course_name""",
            "learning",
        ),
        "student_core": query(
            f"""SELECT student_id, count(DISTINCT course_id) AS course_count,
 {r('sum(time_spent_hours)')} AS total_study_time,
 count(*) FILTER (WHERE completed = 1) AS completed_course_count,
 {avg('progress_percentage')} AS avg_progress, {avg('quiz_score_avg')} AS avg_quiz_score,
 {avg('project_grade')} AS avg_project_grade, {avg('video_completion_rate')} AS avg_video_completion,
 {avg('login_frequency')} AS avg_login_frequency,
 {avg('average_session_duration_min')} AS avg_session_duration,
 count(DISTINCT enrollment_date) AS study_days FROM learning GROUP BY student_id""",
            "learning",
        ),
        "resource_core": query(
            "SELECT *, dense_rank() OVER (ORDER BY access_volume DESC) AS usage_rank FROM resources",
            "resources",
        ),
        "rank_enrollment": query("SELECT * FROM enrollment", "enrollment"),
        "rank_enrollment_load": query("SELECT * FROM enrollment", "enrollment"),
        "rank_enrollment_scaled": query(
            "SELECT * REPLACE (cast(enrollment_rank AS bigint) AS enrollment_rank) FROM enrollment",
            "enrollment",
        ),
        "trend_daily": query(
            f"""SELECT cast(enrollment_date AS string) AS stat_date, {_TREND}
 FROM learning WHERE {_TREND_FILTER} GROUP BY enrollment_date""",
            "learning",
        ),
        "trend_weekly": query("SELECT * FROM weekly", "weekly"),
        "trend_weekly_iso": query(
            f"""SELECT *, concat(cast(stat_year AS string), '-W', lpad(cast(stat_week AS string), 2, '0')) AS week_label
 FROM (SELECT cast(isoyear(enrollment_date) AS int) AS stat_year,
 cast(weekofyear(enrollment_date) AS int) AS stat_week, {_TREND}
 FROM learning WHERE {_TREND_FILTER} GROUP BY 1, 2)""",
            "learning",
        ),
        "trend_latest": query(
            "SELECT * FROM weekly ORDER BY stat_year DESC, stat_week DESC LIMIT 24",
            "weekly",
        ),
        "trend_latest_days": query(
            f"""SELECT concat(week_label, '-D', cast(day + 1 AS string)) AS week_label,
 {r('total_study_time_hours / 7 * (0.86e0 + day * 0.04e0)')} AS total_study_time_hours,
 cast(floor(learner_count * (0.82e0 + day * 0.03e0) + 0.5e0) AS bigint) AS learner_count,
 avg_quiz_score, cast(28 + (23 - age + day) % 6 AS int) AS avg_session_duration_min, true AS is_estimate
 FROM (SELECT *, row_number() OVER (ORDER BY stat_year DESC, stat_week DESC) - 1 AS age FROM weekly),
 (SELECT unnest([0, 1, 2, 3, 4, 5, 6]) AS day) WHERE age < 4""",
            "weekly",
        ),
        "trend_week_spread": query(
            f"""SELECT concat(week_label, '-D', cast(day + 1 AS string)) AS week_label,
 {r('total_study_time_hours / 7 * (0.86e0 + day * 0.04e0)')} AS total_study_time_hours,
 cast(floor(learner_count * (0.82e0 + day * 0.03e0) + 0.5e0) AS bigint) AS learner_count,
 avg_quiz_score, cast(28 + (ordinal + day) % 6 AS int) AS avg_session_duration_min, true AS is_estimate
 FROM (SELECT *, row_number() OVER (ORDER BY stat_year, stat_week) - 1 AS ordinal FROM weekly),
 (SELECT unnest([0, 1, 2, 3, 4, 5, 6]) AS day)""",
            "weekly",
        ),
        "top_resources": query(
            "SELECT * FROM resources ORDER BY access_volume DESC, resource_id LIMIT 20",
            "resources",
        ),
    }
    layers = {
        "dwd_typed": query(f"SELECT {_TEXT_DATE} FROM typed", "typed"),
        "dws_student_stat": query(
            """SELECT student_id, course_id, time_spent_hours AS total_study_time_hours,
 average_session_duration_min AS avg_session_duration_min, progress_percentage AS course_progress_rate,
 completed AS course_completed, assignment_submission_rate AS assignment_submit_rate, quiz_score_avg,
 project_grade, login_frequency, video_completion_rate, discussion_participation,
 peer_interaction_score, days_since_last_login, app_usage_percentage, satisfaction_rating FROM learning""",
            "learning",
        ),
        "dws_course_stat": query("SELECT * FROM course_stat", "course_stat"),
        "dws_student_feature": query("SELECT * FROM student_feature", "student_feature"),
        "dim_student": query(
            "SELECT DISTINCT student_id, " + ", ".join(schema.STUDENT_ATTRIBUTES) + " FROM learning",
            "learning",
        ),
        "dim_course": query(
            "SELECT DISTINCT course_id, " + ", ".join(schema.COURSE_ATTRIBUTES) + " FROM learning",
            "learning",
        ),
        "conform_columns": query("SELECT * FROM course_stat", "course_stat"),
        "conform_decimals": query(_conformed(), "typed"),
        "conform_overflow": query(
            f"""SELECT {_overflow('payment_amount', '999.995')} AS payment_amount,
 {_overflow('time_spent_hours', '9999999999.995')} AS time_spent_hours,
 {_overflow('days_since_last_login', '128')} AS days_since_last_login FROM learning""",
            "learning",
        ),
        "key_violations": query(
            "SELECT student_id, count(*) AS row_count FROM (SELECT DISTINCT student_id, "
            + ", ".join(schema.STUDENT_ATTRIBUTES)
            + " FROM learning) GROUP BY student_id HAVING count(*) > 1",
            "learning",
        ),
        "row_quality_counts": query(
            f"""SELECT count(*) AS input_rows, count(*) FILTER (WHERE {_TREND_FILTER}) AS valid_rows,
 count(*) - count(*) FILTER (WHERE {_TREND_FILTER}) AS rejected_rows FROM typed""",
            "typed",
        ),
        "reconcile_counts": query(
            "SELECT count(*) AS source_rows, count(*) AS target_rows, true AS matched FROM learning",
            "learning",
        ),
        "sync_student_info": query(
            "SELECT student_id, cast(NULL AS string) AS student_name, "
            + ", ".join(f"max({c}) AS {c}" for c in schema.STUDENT_ATTRIBUTES)
            + " FROM enrolled GROUP BY student_id",
            "enrolled",
        ),
        "sync_course_info": query(
            "SELECT course_id, "
            + ", ".join(
                f"cast(cast(max({c}) AS decimal(4,2)) AS double) AS {c}" if c == "instructor_rating" else f"max({c}) AS {c}"
                for c in schema.COURSE_ATTRIBUTES
            )
            + " FROM enrolled GROUP BY course_id",
            "enrolled",
        ),
        "sync_student_stat": query(_conformed("enrolled"), "enrolled"),
        "sync_course_stat": query(_served("course_stat", "enrolled"), "enrolled"),
        "sync_student_feature": query(_served("student_feature", "enrolled"), "enrolled"),
        "managed_table": query(_ALL_FACTS, "learning"),
        "replace_path": query(_ALL_FACTS, "learning"),
        "typed_reload_year": query(
            """SELECT * REPLACE (cast(enrollment_date AS string) AS enrollment_date,
  CASE WHEN year(enrollment_date) = 1995 THEN payment_amount ELSE -1.0e0 END AS payment_amount),
 cast(year(enrollment_date) AS int) AS enrollment_year FROM learning""",
            "learning",
        ),
        "trend_daily_years": query(
            f"""SELECT cast(enrollment_date AS string) AS stat_date, {_TREND} FROM learning
 WHERE {_TREND_FILTER} AND year(enrollment_date) IN (1995, 1997) GROUP BY enrollment_date""",
            "learning",
        ),
        "trend_load_counts": query(
            f"""SELECT count(*) AS input_rows, count(*) FILTER (WHERE {_TREND_FILTER}) AS valid_rows,
 count(*) - count(*) FILTER (WHERE {_TREND_FILTER}) AS rejected_rows,
 count(*) FILTER (WHERE {_TREND_FILTER}) AS arrived_rows FROM typed""",
            "typed",
        ),
    }
    layers["sync_tables"] = " UNION ALL ".join(
        _summed(table, layers[f"sync_{table}"], *_kinds(schema.TARGETS[table])) for table in schema.TARGETS
    )
    clean_columns = f"{LINE}, Student_ID, Gender, City"
    cleaning = {
        "clean_headers": query(_ALL_FACTS, "learning"),
        "clean_text": query(
            f"""SELECT {LINE}, {_tidy('Student_ID')} AS Student_ID, {_tidy('Gender')} AS Gender,
 {_tidy('City')} AS City FROM raw""",
            "raw",
        ),
        "clean_null_tokens": query(f"SELECT {clean_columns} FROM tokens", "tokens"),
        "clean_category_map": query(
            f"SELECT {LINE}, {_gender('Gender')} AS Gender FROM tokens", "tokens"
        ),
        "clean_fill_unknown": query(
            f"SELECT {LINE}, coalesce(City, 'Unknown') AS City FROM tokens", "tokens"
        ),
        "clean_numeric": query(f"SELECT {LINE}, {_num('Age')} AS Age FROM raw", "raw"),
        "clean_percentage": query(
            f"SELECT {LINE}, {_percent('Progress_Percentage')} AS Progress_Percentage FROM raw",
            "raw",
        ),
        "clean_boolean": query(
            f"SELECT {LINE}, {_flag('Completed')} AS Completed FROM raw", "raw"
        ),
        "clean_date": query(
            f"SELECT {LINE}, cast({_date('Enrollment_Date')} AS string) AS Enrollment_Date FROM raw",
            "raw",
        ),
        "clean_drop_critical": query(
            f"SELECT {LINE}, Student_ID, Course_ID, Completed FROM complete", "complete"
        ),
        "clean_dedupe_last": query(
            f"""SELECT * EXCLUDE nth FROM (SELECT {LINE}, Student_ID, Course_ID, Age, {_NEWEST} AS nth
 FROM normal) WHERE nth = 1""",
            "normal",
        ),
        "clean_range_filter": query(
            f"SELECT {LINE}, Age, Progress_Percentage, Completed FROM normal WHERE NOT ({_BAD})",
            "normal",
        ),
        "clean_median_fill": query(
            """SELECT Student_ID, Course_ID, coalesce(Age, m_Age) AS Age,
 coalesce(Progress_Percentage, m_Progress_Percentage) AS Progress_Percentage FROM valid, medians""",
            "medians",
        ),
        "clean_submission_rate": query(
            """SELECT student_id, course_id, payment_amount,
 CASE WHEN assignments_submitted + assignments_missed > 0 THEN round_even(
  cast(assignments_submitted AS double) / (assignments_submitted + assignments_missed) * 100 * 100, 0) / 100
 ELSE 0.0 END AS rate FROM learning""",
            "learning",
        ),
        "clean_int_round": query(
            """SELECT student_id, course_id, cast(round_even(time_spent_hours, 0) AS bigint) AS time_spent_hours,
 cast(round_even(project_grade, 0) AS bigint) AS project_grade FROM learning""",
            "learning",
        ),
        "clean_float_round": query(
            """SELECT student_id, course_id,
 round_even(assignment_submission_rate * 100, 0) / 100 AS assignment_submission_rate FROM learning""",
            "learning",
        ),
        "clean_report": query(
            " UNION ALL ".join(
                f"SELECT '{m}' AS metric, cast(({v}) AS bigint) AS value"
                for m, v in zip(
                    schema.CLEANING_METRICS,
                    [
                        "SELECT count(*) FROM raw",
                        "40",
                        f"SELECT count(*) FROM normal WHERE {_INCOMPLETE}",
                        "(SELECT count(*) FROM complete) - (SELECT count(*) FROM newest)",
                        f"SELECT count(*) FROM newest WHERE {_BAD}",
                        "SELECT count(*) FROM valid",
                        "40",
                    ],
                )
            ),
            "valid",
        ),
        "clean_enrollments": query(
            "SELECT "
            + ", ".join(f"{_finished(c)} AS {c}" for c in RAW_COLUMNS if c not in schema.RAW_PERSONAL)
            + f", {_RATE} AS Assignment_Submission_Rate FROM valid, medians",
            "medians",
        ),
    }
    weak_items = ", ".join(
        f"CASE WHEN coalesce({m}, 0) < {_PLATFORM[m]} THEN '{label}' END"
        for m, label in schema.COURSE_WEAK_ITEMS.items()
    )
    peers = ", ".join(
        (f"least({top}, {r(f'{column} * {factor}e0', digits)})" if top else r(f"{column} * {factor}e0", digits))
        + f" AS peer_{m}"
        for (m, (factor, digits, top)), column in zip(
            schema.STRONG_PEER.items(),
            [
                "avg_study_time_hours",
                "avg_progress",
                "avg_video_completion_rate",
                "avg_submit_rate",
                "avg_quiz_score",
            ],
        )
    )
    advice_cases = " ".join(
        f"WHEN '{label}' THEN '{text}'" for label, text in advice.MEASURE_ADVICE.items()
    )
    measures = list(schema.STUDENT_MEASURES)
    types = " ".join(f"WHEN {k} THEN '{t}'" for k, t in enumerate(schema.COURSE_TYPES))
    type_advice = " ".join(f"WHEN '{t}' THEN '{a}'" for t, a in advice.COURSE_ADVICE.items())
    risk = {
        "course_advice": query(
            f"""SELECT course_id, course_type, CASE course_type {type_advice} ELSE '{advice.COURSE_DEFAULT}' END AS advice
 FROM (SELECT course_id, CASE student_count % 5 {types} END AS course_type FROM course_risk)""",
            "course_risk",
        ),
        "risk_flags": query(
            "SELECT student_id, course_id, payment_amount, login_risk, assignment_risk, progress_risk, score_risk FROM scored",
            "scored",
        ),
        "risk_level": query(
            "SELECT student_id, course_id, warning_level, risk_sum, payment_amount FROM scored",
            "scored",
        ),
        "risk_detail": query("SELECT * FROM details", "details"),
        "warning_distribution": query(
            f"""SELECT warning_level, count(*) AS student_count,
 {pct('count(*)', '(SELECT count(*) FROM scored)')} AS risk_ratio_pct FROM scored GROUP BY warning_level""",
            "scored",
        ),
        "course_risk_summary": query("SELECT * FROM course_risk", "course_risk"),
        "education_risk_summary": query(
            f"""SELECT education_level, count(*) AS student_count,
 count(*) FILTER (WHERE warning_level = '{high}') AS high_risk_count,
 count(*) FILTER (WHERE warning_level = '{schema.SAFE}') AS safe_count,
 {avg('time_spent_hours')} AS avg_total_study_hours, {avg('quiz_score_avg')} AS avg_quiz_score,
 {avg('assignment_submission_rate')} AS avg_submit_rate,
 {pct('count(*)', '(SELECT count(*) FROM scored)')} AS ratio_pct,
 {pct(f"count(*) FILTER (WHERE warning_level = '{high}')", 'count(*)')} AS high_risk_pct,
 {pct(f"count(*) FILTER (WHERE warning_level = '{schema.SAFE}')", 'count(*)')} AS safe_pct
 FROM scored GROUP BY education_level""",
            "scored",
        ),
        "overview_metrics": query(
            f"""SELECT count(DISTINCT student_id) AS student_count, count(DISTINCT course_id) AS course_count,
 (SELECT count(*) FROM resources) AS resource_count,
 {r('sum(time_spent_hours)')} AS total_study_time_hours FROM learning""",
            "learning",
            "resources",
        ),
        "summary_totals": query(
            f"""SELECT cast(sum(learning_times) AS bigint) AS learning_times,
 {r('sum(total_study_time_hours)', 6)} AS total_study_time_hours FROM weekly""",
            "weekly",
        ),
        "platform_average": query(
            "SELECT "
            + ", ".join(
                f"{r(c, 6)} AS {c}"
                for c in ("platform_score", "platform_submit", "platform_progress", "platform_video", "platform_risk")
            )
            + " FROM platform",
            "platform",
        ),
        "filter_share": query(
            f"""SELECT count(*) FILTER (WHERE warning_level = '{high}') AS matched_rows, count(*) AS total_rows,
 {pct(f"count(*) FILTER (WHERE warning_level = '{high}')", 'count(*)')} AS share_pct FROM scored""",
            "scored",
        ),
        "course_weak_items": query(
            f"""SELECT course_id, course_name, concat_ws('{schema.COURSE_WEAK_SEPARATOR}', {weak_items}) AS weak_items,
 high_risk_pct > platform_risk AS risk_above_platform FROM course_risk, platform""",
            "course_risk",
            "platform",
        ),
        "course_merged": query(
            """SELECT e.*, c.* EXCLUDE (course_id, course_name) FROM enrollment e
 LEFT JOIN course_risk c ON e.course_id = c.course_id""",
            "enrollment",
            "course_risk",
        ),
        "teacher_profile": query(
            f"""SELECT s.course_id, s.course_name, s.category AS course_category, s.learner_count AS student_count,
 {r('''CASE WHEN cast(s.completion_count AS double) / s.learner_count <= 1
  THEN cast(s.completion_count AS double) / s.learner_count * 100
  ELSE cast(s.completion_count AS double) / s.learner_count END''')} AS finish_rate,
 c.avg_quiz_score, c.avg_submit_rate AS avg_assignment_submit_rate, c.avg_progress AS avg_student_progress,
 c.avg_video_completion_rate AS avg_video_completion, {r('s.avg_satisfaction_rating')} AS avg_student_satisfaction,
 c.high_risk_pct, c.high_risk_count, c.mid_risk_count, c.low_risk_count, c.safe_count
 FROM course_stat s LEFT JOIN course_risk c ON s.course_id = c.course_id""",
            "course_stat",
            "course_risk",
        ),
        "teacher_rank": query(
            """SELECT course_id, avg_quiz_score, high_risk_pct,
 row_number() OVER (ORDER BY coalesce(avg_quiz_score, 0) DESC, course_id) AS score_position,
 row_number() OVER (ORDER BY coalesce(high_risk_pct, 0), course_id) AS risk_position,
 count(*) OVER () AS peer_count FROM course_risk""",
            "course_risk",
        ),
        "student_profile": query(
            """SELECT s.student_id, b.education_level, b.device_type, f.course_count, f.completion_rate, f.avg_quiz_score,
 s.course_id, s.time_spent_hours AS total_study_time_hours, s.warning_level, s.risk_sum
 FROM scored s LEFT JOIN student_feature f ON s.student_id = f.student_id
 LEFT JOIN (SELECT student_id, education_level, device_type FROM (SELECT *, row_number() OVER (PARTITION BY student_id
  ORDER BY gender DESC, age DESC, education_level DESC, employment_status DESC, city DESC, device_type DESC,
  internet_connection_quality DESC) AS nth FROM learning) WHERE nth = 1) b ON s.student_id = b.student_id""",
            "scored",
            "student_feature",
        ),
        "student_profile_nested": query(
            f"""SELECT s.student_id, any_value(b.education_level) AS education_level,
 any_value(f.course_count) AS course_count, any_value(f.completion_rate) AS completion_rate,
 arg_max(warning_level, risk_sum) AS warning_level, max(risk_sum) AS risk_sum,
 count(*) FILTER (WHERE warning_level = '{schema.HIGH}') AS high_risk_count,
 count(*) FILTER (WHERE warning_level = '{schema.MID}') AS mid_risk_count,
 count(*) FILTER (WHERE warning_level = '{schema.LOW}') AS low_risk_count,
 count(*) FILTER (WHERE warning_level = '{schema.SAFE}') AS safe_count,
 cast(count(*) AS int) AS courses_listed, string_agg(course, ';' ORDER BY course) AS courses_sorted,
 string_agg(place, ';' ORDER BY place) AS courses_in_order
 FROM (SELECT *, concat_ws('|', cast(enrollment_date AS string), course_id, course_name, warning_level,
   cast(risk_sum AS string), cast(cast(progress_percentage AS int) AS string)) AS course,
  concat(cast(enrollment_date AS string), ' ', course_id) AS place FROM scored) s
 LEFT JOIN student_feature f ON s.student_id = f.student_id
 LEFT JOIN (SELECT student_id, max(education_level) AS education_level FROM learning GROUP BY student_id) b
  ON s.student_id = b.student_id
 GROUP BY s.student_id""",
            "scored",
            "student_feature",
        ),
        "student_benchmark": query(
            "SELECT student_id, course_id, "
            + ", ".join(
                f"value_{m}, bench_{m}, value_{m} >= bench_{m} AS above_{m}" for m in measures
            )
            + " FROM profile",
            "profile",
        ),
        "weakest_measure": query(
            "SELECT student_id, course_id, value_time, weakest_measure FROM weakest",
            "weakest",
        ),
        "advice_lookup": query(
            f"""SELECT student_id, course_id, warning_level, weakest_measure,
 concat(CASE WHEN warning_level = '{high}' THEN '{advice.URGENT}' ELSE '{advice.NORMAL}' END,
 CASE weakest_measure {advice_cases} END) AS advice FROM weakest""",
            "weakest",
        ),
        "strong_peer": query(f"SELECT course_id, {peers} FROM course_risk", "course_risk"),
        "persona_label": query(
            "SELECT student_id, course_id, warning_level, value_time, persona_label FROM personas",
            "personas",
        ),
        "persona_share": query(
            f"""SELECT persona_label, count(*) AS student_count,
 {pct('count(*)', '(SELECT count(*) FROM personas)')} AS ratio_percent FROM personas GROUP BY persona_label""",
            "personas",
        ),
        "student_report": query(
            """SELECT student_id, '--' AS student_name, education_level, course_id, course_name,
 value_time AS total_study_time_hours, bench_time AS class_avg_study_time_hours,
 value_completion AS completion_rate, value_video AS video_completion_rate,
 coalesce(assignment_submission_rate, 0) AS assignment_submission_rate, value_score AS avg_quiz_score,
 warning_level, risk_sum FROM profile""",
            "profile",
        ),
    }
    risk_key = "student_id, course_id, warning_level, risk_sum"
    selecting = {
        "filter_equals": query(
            f"""SELECT {risk_key}, education_level FROM scored
 WHERE education_level = 'BUILDING' AND warning_level = '{high}'""",
            "scored",
        ),
        "filter_search": query(
            f"""SELECT {risk_key}, course_name FROM scored WHERE contains(student_id, '1')
 AND contains(concat(course_id, course_name), '7') AND warning_level = '{schema.MID}'""",
            "scored",
        ),
        "filter_selected": query(
            f"""SELECT {risk_key} FROM scored WHERE student_id IN
 (SELECT concat('S', cast(c_custkey AS string)) FROM customer WHERE c_acctbal < 0)""",
            "scored",
        ),
        "export_high_risk": query(
            f"SELECT {risk_key} FROM scored WHERE warning_level = '{high}'", "scored"
        ),
        "export_student": query(
            f"SELECT {risk_key} FROM scored WHERE student_id = 'S7'", "scored"
        ),
        "rank_by_measure": query(
            """SELECT course_id, high_risk_count,
 row_number() OVER (ORDER BY high_risk_count DESC, course_id) AS position FROM course_risk""",
            "course_risk",
        ),
        "pinned_sort": query(
            """SELECT course_id, avg_quiz_score, row_number() OVER (ORDER BY course_id = 'C7' DESC,
 coalesce(avg_quiz_score, 0) DESC, course_id) AS position FROM course_risk""",
            "course_risk",
        ),
        "page_rows": query(
            f"""SELECT student_id, course_id, cast(enrollment_date AS string) AS enrollment_date, payment_amount
 FROM scored WHERE warning_level = '{high}'
 ORDER BY student_id, course_id, scored.enrollment_date, payment_amount LIMIT 20 OFFSET 40""",
            "scored",
        ),
        "page_rows_deep": query(
            """SELECT student_id, course_id, cast(enrollment_date AS string) AS enrollment_date, payment_amount
 FROM (SELECT *, count(*) OVER () AS total, row_number() OVER
  (ORDER BY student_id, course_id, enrollment_date, payment_amount) - 1 AS before FROM scored)
 WHERE before >= (total - 1) // 20 * 20""",
            "scored",
        ),
        "page_rows_stored": query(
            """SELECT student_id, course_id, cast(enrollment_date AS string) AS enrollment_date, payment_amount
 FROM (SELECT *, count(*) OVER () AS total, row_number() OVER
  (ORDER BY student_id, course_id, enrollment_date, payment_amount) - 1 AS before FROM scored)
 WHERE before BETWEEN 40 AND 59 OR before >= (total - 1) // 20 * 20""",
            "scored",
        ),
        "student_lookup": query(
            f"SELECT {risk_key} FROM scored WHERE student_id = 'S7'", "scored"
        ),
        "rate_to_percent": query(
            """SELECT student_id, course_id, CASE WHEN assignment_submission_rate / 50 <= 1
 THEN assignment_submission_rate / 50 * 100 ELSE assignment_submission_rate / 50 END AS percent FROM learning""",
            "learning",
        ),
        "first_text": query(
            f"""SELECT {LINE}, coalesce(nullif(City, ''), nullif(Gender, ''), '{schema.UNCATEGORISED}') AS label
 FROM tokens""",
            "tokens",
        ),
    }
    na = _in(schema.CSV_NA_TOKENS)
    files = {
        "scan_raw_csv": query(
            "SELECT "
            + ", ".join(
                [f"cast({c} AS string) AS {c}" for c in LINE.split(", ")]
                + [f"CASE WHEN {c} IN ({na}) THEN NULL ELSE {c} END AS {c}" for c in RAW_COLUMNS]
            )
            + " FROM raw",
            "raw",
        ),
        "scan_clean_csv": query(_ALL_FACTS, "learning"),
        "ods_load": layers["dwd_typed"],
        "scan_orc": query(_ALL_FACTS, "learning"),
        "export_csv": query(
            """SELECT * REPLACE (concat('  "', course_name, '", x ') AS course_name) FROM details""", "details"
        ),
        "export_overview_metrics": risk["overview_metrics"],
        "export_weekly": marts["trend_weekly"],
        "export_ranking": marts["rank_enrollment"],
        "export_warning_levels": risk["warning_distribution"],
        "export_course_risk": risk["course_risk_summary"],
        "export_education_risk": risk["education_risk_summary"],
        "export_warning_detail": risk["risk_detail"],
    }
    cleaning["clean_load_report"] = cleaning["clean_report"]
    sources = {
        "overview_metrics": "export_overview_metrics",
        "weekly_learning_statistics": "export_weekly",
        "course_enrollment_ranking": "export_ranking",
        "warning_level_summary": "export_warning_levels",
        "course_risk_summary": "export_course_risk",
        "education_risk_summary": "export_education_risk",
        "student_warning_detail": "export_warning_detail",
    }
    files["export_bundle"] = " UNION ALL ".join(
        _summed(dataset, files[key], *_EXPORTED[dataset]) for dataset, key in sources.items()
    )
    return {**marts, **layers, **cleaning, **risk, **selecting, **files}
