"""Enrolment views over the star-schema test tables.

Student = customer, course = part, one enrolment per line item. The statements
use a dialect that Spark and DuckDB share, so both sides start from one text;
``{table}`` is replaced by a DataFrame here and by a table name there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lectern.schema import (
    ENROLMENT_NAMES,
    RAW_FLAG,
    RAW_PERCENT,
    RAW_RANGES,
    RAW_TEXT,
)
from lectern.session import limit_methods

# The columns the views read; declared, so that no footer is opened to infer them.
TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
}

_COLUMNS = """concat('S', cast(o.o_custkey AS string)) AS student_id,
 CASE o.o_custkey % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' ELSE 'Other' END AS gender,
 cast(18 + o.o_custkey % 50 AS int) AS age,
 c.c_mktsegment AS education_level,
 CASE WHEN c.c_acctbal < 0 THEN 'Unemployed' WHEN c.c_acctbal < 5000 THEN 'Student' ELSE 'Employed' END AS employment_status,
 n.n_name AS city,
 CASE o.o_orderstatus WHEN 'F' THEN 'Mobile' WHEN 'O' THEN 'Laptop' ELSE 'Tablet' END AS device_type,
 CASE o.o_custkey % 4 WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' ELSE 'High' END AS internet_connection_quality,
 concat('C', cast(l.l_partkey AS string)) AS course_id, p.p_name AS course_name,
 p.p_type AS category, p.p_brand AS course_level, p.p_size AS course_duration_days,
 (p.p_partkey % 11) / 2.0e0 AS instructor_rating,
 l.l_linenumber AS login_frequency, cast(p.p_size AS double) AS average_session_duration_min,
 l.l_linenumber * 12.5e0 AS video_completion_rate,
 cast(l.l_suppkey % 9 AS int) AS discussion_participation, l.l_quantity / 4 AS time_spent_hours,
 cast(l.l_suppkey % 15 AS int) AS days_since_last_login,
 cast(l.l_suppkey % 10 AS int) AS notifications_checked,
 cast(l.l_suppkey % 101 AS double) AS peer_interaction_score,
 l.l_linenumber AS assignments_submitted, cast(l.l_quantity AS int) % 6 AS assignments_missed,
 cast(l.l_partkey % 5 AS int) AS quiz_attempts,
 round(l.l_discount * 100) * 10 AS quiz_score_avg, round(l.l_tax * 100) * 12.5e0 AS project_grade,
 l.l_quantity * 2 AS progress_percentage, l.l_linenumber - 1 AS rewatch_count,
 cast(o.o_orderdate AS date) AS enrollment_date, l.l_returnflag AS payment_mode,
 CASE WHEN o.o_orderstatus = 'P' THEN 0 ELSE 1 END AS fee_paid,
 CASE WHEN l.l_discount > 0 THEN 1 ELSE 0 END AS discount_used,
 l.l_extendedprice AS payment_amount, cast(l.l_partkey % 101 AS double) AS app_usage_percentage,
 cast(l.l_partkey % 4 AS int) AS reminder_emails_clicked,
 cast(l.l_suppkey % 3 AS int) AS support_tickets_raised,
 cast(substr(o.o_orderpriority, 1, 1) AS double) AS satisfaction_rating,
 CASE WHEN l.l_linestatus = 'F' THEN 1 ELSE 0 END AS completed,
 l.l_linenumber * 100.0e0 / (l.l_linenumber + cast(l.l_quantity AS int) % 6) AS assignment_submission_rate
"""
_JOINS = """FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey
JOIN {part} p ON l.l_partkey = p.p_partkey
"""
LEARNING = f"SELECT {_COLUMNS}{_JOINS}"

# The same inner joins for Spark: an order meets its customer before its lines, so the lines
# are shuffled twice, not three times.
_ORDERS_FIRST = """FROM {lineitem} l JOIN ({orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey) ON l.l_orderkey = o.o_orderkey
JOIN {part} p ON l.l_partkey = p.p_partkey
"""

# The dirty file: all enrolment columns as text, spoilt by key arithmetic. ``k`` parts the
# columns, so that not all of them are spoilt in the same rows.
_LINES = (
    "SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_extendedprice, l.l_partkey, l.l_quantity,"
    f" o.o_custkey, {_COLUMNS}{_JOINS}"
)


def _dirty_text(column: str, k: int) -> str:
    return (
        f"CASE l_suppkey % 37 WHEN {k} THEN concat('  ', {column}, '   B ') WHEN {k + 1} THEN 'None'"
        f" WHEN {k + 2} THEN NULL ELSE {column} END"
    )


def _dirty_number(column: str, k: int, outside: str) -> str:
    text = f"cast({column} AS string)"
    return (
        f"CASE l_orderkey % 211 WHEN {k} THEN 'x1' WHEN {k + 1} THEN NULL WHEN {k + 2} THEN concat(' ', {text}, ' ')"
        f" WHEN {k + 3} THEN '{outside}' ELSE {text} END"
    )


def _dirty_percent(column: str, k: int) -> str:
    text = f"cast({column} AS string)"
    return (
        f"CASE l_orderkey % 53 WHEN {k} THEN concat({text}, ' %') WHEN {k + 1} THEN concat('\u3000', {text}, '%')"
        f" WHEN {k + 2} THEN '0.5' WHEN {k + 3} THEN 'n/a' WHEN {k + 4} THEN '250%' ELSE {text} END"
    )


def _dirty_flag(column: str, k: int) -> str:
    return (
        f"CASE WHEN l_orderkey % 101 = {k} THEN 'maybe' WHEN l_orderkey % 101 = {k + 1} THEN '3'"
        f" WHEN {column} = 1 THEN ' Yes' ELSE 'n' END"
    )


_DIRTY = {
    "Student_ID": "CASE WHEN l_suppkey % 50 = 7 THEN '  ' ELSE concat(' ', student_id, '  ') END",
    "Name": "concat(' Student ', student_id)",
    "Gender": "CASE l_suppkey % 6 WHEN 0 THEN ' male ' WHEN 1 THEN 'F' WHEN 2 THEN '男' WHEN 3 THEN 'OTHER'"
    " WHEN 4 THEN 'x?' ELSE NULL END",
    "City": "CASE l_partkey % 7 WHEN 0 THEN 'nan' WHEN 1 THEN '' WHEN 2 THEN concat('  ', city, '   A ')"
    " WHEN 3 THEN 'NULL' ELSE city END",
    "Course_ID": "course_id",
    "Age": "CASE l_suppkey % 9 WHEN 3 THEN 'abc' WHEN 4 THEN '7' WHEN 5 THEN NULL"
    " ELSE cast(10 + l_partkey % 90 AS string) END",
    "Progress_Percentage": "CASE l_linenumber % 4 WHEN 0 THEN concat(cast(cast(l_quantity * 2 AS int) AS string), ' %')"
    " WHEN 1 THEN cast(cast(l_quantity / 50 AS decimal(5,2)) AS string)"
    " WHEN 2 THEN cast(cast(floor(l_quantity * 2.1e0) AS int) AS string) ELSE 'n/a' END",
    "Completed": "CASE l_partkey % 8 WHEN 0 THEN 'Yes' WHEN 1 THEN ' completed' WHEN 2 THEN '1' WHEN 3 THEN 'no'"
    " WHEN 4 THEN '未完成' WHEN 5 THEN '0' WHEN 6 THEN '2' ELSE 'maybe' END",
    "Enrollment_Date": "CASE l_suppkey % 20 WHEN 1 THEN 'bad-date' WHEN 2 THEN concat(cast(enrollment_date AS string), ' 10:00:00')"
    " WHEN 3 THEN replace(cast(enrollment_date AS string), '-', '/') WHEN 4 THEN replace(cast(enrollment_date AS string), '-0', '-')"
    " WHEN 5 THEN replace(replace(cast(enrollment_date AS string), '-0', '.'), '-', '.') ELSE cast(enrollment_date AS string) END",
}


def _dirty_columns() -> dict[str, str]:
    """The expression of each column of the dirty file, in its order."""
    out = {}
    names = ["Name", *[n for n in ENROLMENT_NAMES if n != "assignment_submission_rate"]]
    for k, name in enumerate(names):
        raw = name.title().replace("_Id", "_ID")
        low = name.lower()
        if raw in _DIRTY:
            out[raw] = _DIRTY[raw]
        elif raw in RAW_TEXT:
            out[raw] = _dirty_text(low, k % 34)
        elif raw in RAW_PERCENT:
            out[raw] = _dirty_percent(low, k % 48)
        elif raw in RAW_FLAG:
            out[raw] = _dirty_flag(low, k)
        else:
            out[raw] = _dirty_number(low, 5 * k, "1e9" if raw in RAW_RANGES else "12")
    return out


RAW_COLUMNS = _dirty_columns()
RAW_LEARNING = "SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice, {columns} FROM ({lines})".format(
    columns=", ".join(f"{text} AS {name}" for name, text in RAW_COLUMNS.items()), lines=_LINES
)

# Enrolments as the text layer receives them, some values spoilt by key arithmetic.
_SPOILT = {
    "age": "CASE WHEN days_since_last_login = 7 THEN 'n/a' ELSE cast(age AS string) END",
    "course_duration_days": "concat(cast(course_duration_days AS string), '.5')",
    "quiz_score_avg": "CASE WHEN quiz_attempts = 3 THEN NULL ELSE cast(quiz_score_avg AS string) END",
    "time_spent_hours": "CASE WHEN notifications_checked = 4 THEN '' ELSE cast(time_spent_hours AS string) END",
    "enrollment_date": "CASE notifications_checked WHEN 9 THEN '31/12/1995'"
    " WHEN 8 THEN concat(cast(enrollment_date AS string), ' 10:00:00') ELSE cast(enrollment_date AS string) END",
    "city": "CASE notifications_checked WHEN 7 THEN concat(' ', city, ' \"x\", y ') ELSE city END",
    "completed": "CASE WHEN login_frequency = 5 THEN '?' ELSE cast(completed AS string) END",
}
ODS_LEARNING = "SELECT {columns} FROM {{learning}}".format(
    columns=", ".join(
        f"{_SPOILT.get(name, f'cast({name} AS string)')} AS {name}"
        for name in ENROLMENT_NAMES
    )
)


def scan_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _view(spark: SparkSession, sf_dir: str, statement: str) -> DataFrame:
    limit_methods(spark)
    statement = statement.replace(_JOINS, _ORDERS_FIRST)
    tables = {
        name: scan_table(spark, sf_dir, name)
        for name in TABLES
        if "{" + name + "}" in statement
    }
    return spark.sql(statement, **tables)


def learning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean enrolment facts, 40 columns in layer order."""
    return _view(spark, sf_dir, LEARNING)


def raw_learning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same enrolments as dirty text, with the order columns of the file."""
    return _view(spark, sf_dir, RAW_LEARNING)


def ods_learning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enrolments as text, with bad values in six columns."""
    return spark.sql(ODS_LEARNING, learning=learning(spark, sf_dir))
