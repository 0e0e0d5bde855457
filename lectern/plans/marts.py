"""The course, student, resource, ranking and trend marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.numeric import all_of, half_up
from lectern.functions.parsing import week_label
from lectern.operators.aggregate import mean, summarise_distinct, tally, total
from lectern.operators.numbering import dense_rank, dense_rank_counts
from lectern.staging import stage

COURSE = ["course_id", "course_name"]


def known(*columns: str) -> Column:
    return all_of([F.col(c).isNotNull() for c in columns])


def filled(*columns: str) -> Column:
    return all_of([F.col(c).isNotNull() & (F.col(c) != "") for c in columns])


def course_score(facts: DataFrame) -> DataFrame:
    return (
        facts.filter(known(*COURSE, "quiz_score_avg"))
        .groupBy(*COURSE)
        .agg(
            F.count("*").alias("student_count"),
            mean("quiz_score_avg").alias("avg_quiz_score"),
            mean("project_grade").alias("avg_project_grade"),
        )
        .orderBy(F.col("avg_quiz_score").desc(), "course_id")
    )


def course_core(facts: DataFrame) -> DataFrame:
    """``learner_count`` is rows; an unknown completion counts as not completed."""
    summary = (
        facts.filter(known(*COURSE))
        .groupBy(*COURSE)
        .agg(
            F.count("*").alias("learner_count"),
            tally(F.col("completed") == 1).alias("completion_count"),
            mean("quiz_score_avg").alias("avg_quiz_score"),
            mean("project_grade").alias("avg_project_grade"),
            mean("progress_percentage").alias("avg_progress"),
            mean("time_spent_hours").alias("avg_study_time"),
            mean("video_completion_rate").alias("avg_video_completion"),
            mean("average_session_duration_min").alias("avg_session_duration"),
            mean("login_frequency").alias("avg_login_frequency"),
        )
    )
    rate = half_up(F.col("completion_count") / F.col("learner_count") * 100)
    return summary.withColumn("completion_rate", rate).orderBy(
        F.col("completion_rate").desc(), "course_id"
    )


def _student_measures() -> dict[str, Column]:
    return {
        "total_study_time": total("time_spent_hours"),
        "completed_course_count": tally(F.col("completed") == 1),
        "avg_progress": mean("progress_percentage"),
        "avg_quiz_score": mean("quiz_score_avg"),
        "avg_project_grade": mean("project_grade"),
        "avg_video_completion": mean("video_completion_rate"),
        "avg_login_frequency": mean("login_frequency"),
        "avg_session_duration": mean("average_session_duration_min"),
    }


def student_core(facts: DataFrame) -> DataFrame:
    """No row is filtered: a missing student id is a group of its own. The columns that
    are needed are stored once, as each distinct count reads them."""
    needed = stage(
        facts.select(
            "student_id",
            "course_id",
            "enrollment_date",
            "time_spent_hours",
            "completed",
            "progress_percentage",
            "quiz_score_avg",
            "project_grade",
            "video_completion_rate",
            "login_frequency",
            "average_session_duration_min",
        )
    )
    distinct = {"course_count": "course_id", "study_days": "enrollment_date"}
    measures = _student_measures()
    found = summarise_distinct(needed, ["student_id"], distinct, measures)
    return found.select("student_id", "course_count", *measures, "study_days")


def resource_summary(facts: DataFrame) -> DataFrame:
    """A course seen as a teaching resource; ``learner_count`` is distinct."""
    return (
        facts.filter(known(*COURSE))
        .groupBy(
            F.col("course_id").alias("resource_id"),
            F.col("course_name").alias("resource_name"),
            F.col("category").alias("resource_category"),
            F.col("course_level").alias("resource_level"),
        )
        .agg(
            F.count_distinct("student_id").alias("learner_count"),
            F.sum(F.col("login_frequency").cast("double")).alias("access_volume"),
            mean("app_usage_percentage").alias("avg_usage_rate"),
            mean("video_completion_rate").alias("avg_video_completion_rate"),
            F.sum("rewatch_count").alias("total_rewatch_count"),
            mean("notifications_checked").alias("avg_notifications_checked"),
            mean("reminder_emails_clicked").alias("avg_reminder_clicks"),
            mean("time_spent_hours").alias("avg_study_time_hours"),
        )
    )


def resource_core(facts: DataFrame) -> DataFrame:
    """Resources with their dense rank by access volume."""
    summary = stage(resource_summary(facts))
    return dense_rank(summary, "access_volume", "usage_rank").orderBy(
        "usage_rank", "resource_id"
    )


def enrollment_counts(facts: DataFrame) -> DataFrame:
    """Distinct learners per course; blank ids and names do not count."""
    return (
        facts.filter(filled(*COURSE, "student_id"))
        .groupBy(*COURSE)
        .agg(F.count_distinct("student_id").alias("learner_count"))
    )


def rank_enrollment(facts: DataFrame) -> DataFrame:
    """Courses by distinct learners, equal counts share a rank (1, 2, 2, 3)."""
    ranked = dense_rank_counts(
        enrollment_counts(facts), "learner_count", "enrollment_rank"
    )
    return ranked.select(
        "enrollment_rank", *COURSE, "learner_count"
    ).orderBy("enrollment_rank", "course_id")


def rank_enrollment_scaled(facts: DataFrame) -> DataFrame:
    """The same ranking with no one-task step at all, for a measure whose number
    of different values has no bound."""
    ranked = dense_rank(
        stage(enrollment_counts(facts)), "learner_count", "enrollment_rank"
    )
    return ranked.select(
        "enrollment_rank", *COURSE, "learner_count"
    ).orderBy("enrollment_rank", "course_id")


TREND_REQUIRED = ("enrollment_date", "student_id", "course_id", "time_spent_hours")


def trend_valid() -> Column:
    return known(*TREND_REQUIRED)


def _trend(facts: DataFrame, **period: Column) -> DataFrame:
    """Stores the columns that are needed once, as each distinct count reads them."""
    needed = stage(
        facts.filter(trend_valid()).select(
            *[column.alias(name) for name, column in period.items()],
            "student_id",
            "course_id",
            "time_spent_hours",
            "average_session_duration_min",
            "progress_percentage",
            "quiz_score_avg",
        )
    )
    measures = {
        "learning_times": F.count("*"),
        "total_study_time_hours": total("time_spent_hours"),
        "avg_study_time_hours": mean("time_spent_hours"),
        "avg_session_duration_min": mean("average_session_duration_min"),
        "avg_progress_percentage": mean("progress_percentage"),
        "avg_quiz_score": mean("quiz_score_avg"),
    }
    distinct = {"learner_count": "student_id", "course_count": "course_id"}
    found = summarise_distinct(needed, list(period), distinct, measures)
    first, *others = measures
    return found.select(*period, first, *distinct, *others)


def trend_daily(facts: DataFrame) -> DataFrame:
    return _trend(facts, stat_date=F.col("enrollment_date")).orderBy("stat_date")


def _weekly(facts: DataFrame, year: Column) -> DataFrame:
    week = F.weekofyear("enrollment_date")
    label = week_label(F.col("stat_year"), F.col("stat_week"))
    return (
        _trend(facts, stat_year=year, stat_week=week)
        .withColumn("week_label", label)
        .orderBy("stat_year", "stat_week")
    )


def trend_weekly(facts: DataFrame) -> DataFrame:
    """Calendar year with ISO week number: 2024-12-30 is labelled 2024-W01."""
    return _weekly(facts, F.year("enrollment_date"))


def trend_weekly_iso(facts: DataFrame) -> DataFrame:
    """ISO year with ISO week number: 2024-12-30 is labelled 2025-W01."""
    return _weekly(
        facts, F.extract(F.lit("YEAROFWEEK"), F.col("enrollment_date"))
    )
