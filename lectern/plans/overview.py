"""Overview figures, trend estimates and the report bundle."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.numeric import half_up, zero_if_null
from lectern.operators.aggregate import summarise_distinct, total
from lectern.operators.selecting import latest
from lectern.plans import marts, warnings
from lectern.staging import stage


def overview_metrics(facts: DataFrame) -> DataFrame:
    """Students, courses, resources and study hours in one row. The columns that are
    needed are stored once, as each distinct count reads them."""
    resource = ("course_id", "course_name", "category", "course_level")
    needed = stage(facts.select("student_id", *resource, "time_spent_hours"))
    distinct = {
        "student_count": "student_id",
        "course_count": "course_id",
        "resource_count": F.when(marts.known(*marts.COURSE), F.struct(*resource)),
    }
    metrics = summarise_distinct(
        needed, [], distinct, {"total_study_time_hours": total("time_spent_hours")}
    )
    return metrics.select(*distinct, "total_study_time_hours")


def week_spread(weekly: DataFrame) -> DataFrame:
    """Seven estimated day rows per week, for display only; real days come from
    the daily trend. ``is_estimate`` says so in the data."""
    # Calendar weeks: 53 a year at most, so numbering them in one task is bounded.
    ordinal = F.row_number().over(Window.orderBy("stat_year", "stat_week")) - 1
    days = weekly.withColumn("_ordinal", ordinal).withColumn(
        "day", F.explode(F.sequence(F.lit(0), F.lit(6)))
    )
    hours = zero_if_null(F.col("total_study_time_hours")) / 7
    learners = zero_if_null(F.col("learner_count"))
    # The factors of the estimate.
    return days.select(
        F.concat("week_label", F.lit("-D"), (F.col("day") + 1).cast("string")).alias(
            "week_label"
        ),
        half_up(hours * (F.col("day") * 0.04e0 + 0.86e0)).alias(
            "total_study_time_hours"
        ),
        F.floor(learners * (F.col("day") * 0.03e0 + 0.82e0) + 0.5e0).alias(
            "learner_count"
        ),
        zero_if_null(F.col("avg_quiz_score")).alias("avg_quiz_score"),
        (F.lit(28) + (F.col("_ordinal") + F.col("day")) % 6).alias(
            "avg_session_duration_min"
        ),
        F.lit(True).alias("is_estimate"),
    )


def latest_days(weekly: DataFrame, weeks: int = 24, days: int = 28) -> DataFrame:
    """The last day rows of the estimate over the last weeks."""
    recent = latest(weekly, weeks, "stat_year", "stat_week")
    return latest(week_spread(recent), days, "week_label")


# What the datasets of the report read.
REPORT_COLUMNS = (
    "student_id",
    "course_id",
    "course_name",
    "category",
    "course_level",
    "education_level",
    "enrollment_date",
    "time_spent_hours",
    "average_session_duration_min",
    "login_frequency",
    "days_since_last_login",
    "assignment_submission_rate",
    "assignments_missed",
    "progress_percentage",
    "video_completion_rate",
    "quiz_score_avg",
)


def report_datasets(facts: DataFrame) -> dict[str, DataFrame]:
    """The seven datasets of the report export. Each reads ``facts``, so pass a stored
    table."""
    scored = warnings.scored_enrolments(facts)
    return {
        "overview_metrics": overview_metrics(facts),
        "weekly_learning_statistics": marts.trend_weekly(facts),
        "course_enrollment_ranking": marts.rank_enrollment(facts),
        "warning_level_summary": warnings.warning_distribution(scored),
        "course_risk_summary": warnings.course_risk_summary(scored),
        "education_risk_summary": warnings.education_risk_summary(scored),
        "student_warning_detail": warnings.warning_details(scored),
    }
