"""Typed layer, dimensions and the stored summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql import functions as F

from lectern import schema
from lectern.functions.numeric import to_int, to_number
from lectern.functions.parsing import parse_date
from lectern.operators.aggregate import summarise_labelled
from lectern.operators.joining import first_per_key
from lectern.sinks.files import write_partitioned

_PARSERS = {
    "string": lambda c: c,
    "int": to_int,
    "double": to_number,
    "date": parse_date,
}


def typed(ods: DataFrame) -> DataFrame:
    """All-text enrolments to layer types; a bad value becomes NULL."""
    return ods.select(
        *[_PARSERS[kind](F.col(n)).alias(n) for n, kind in schema.ENROLMENT_COLUMNS]
    )


YEAR = "enrollment_year"
YEARS_SCHEMA = T.StructType([*schema.ENROLMENT_SCHEMA.fields, T.StructField(YEAR, T.IntegerType())])


def load_years(facts: DataFrame, path: str) -> None:
    """Store enrolments in one folder per year; years that ``facts`` does not hold stay as they
    are, so a year can be loaded again alone. Rows without a date have a folder too."""
    write_partitioned(facts.withColumn(YEAR, F.year("enrollment_date")), path, YEAR)


def scan_years(spark: SparkSession, path: str, *years: int) -> DataFrame:
    """Enrolments of the given years, or of all; other years' folders are not opened."""
    facts = spark.read.schema(YEARS_SCHEMA).orc(path)
    return facts.filter(F.col(YEAR).isin(*years)) if years else facts


def with_audit(df: DataFrame, *columns: str) -> DataFrame:
    """Load date and times, as of the run."""
    sources: dict[str, Column] = {
        "update_date": F.current_date(),
        "create_time": F.current_timestamp(),
        "update_time": F.current_timestamp(),
    }
    return df.withColumns({c: sources[c] for c in columns})


def student_dimension(facts: DataFrame) -> DataFrame:
    """Distinct attribute tuples. A student with two values of an attribute has
    two rows; ``key_violations`` reports them."""
    return facts.select("student_id", *schema.STUDENT_ATTRIBUTES).distinct()


def course_dimension(facts: DataFrame) -> DataFrame:
    return facts.select("course_id", *schema.COURSE_ATTRIBUTES).distinct()


def student_info(facts: DataFrame) -> DataFrame:
    """The dimension in its served form, one row per student; names are not kept after
    cleaning."""
    named = first_per_key(student_dimension(facts), ["student_id"]).withColumn(
        "student_name", F.lit(None).cast("string")
    )
    return with_audit(named, "create_time", "update_time")


def course_info(facts: DataFrame) -> DataFrame:
    """One row per course."""
    courses = first_per_key(course_dimension(facts), ["course_id"])
    return with_audit(courses, "create_time", "update_time")


# served name -> fact column
_STUDENT_STAT = {
    "student_id": "student_id",
    "course_id": "course_id",
    "total_study_time_hours": "time_spent_hours",
    "avg_session_duration_min": "average_session_duration_min",
    "course_progress_rate": "progress_percentage",
    "course_completed": "completed",
    "assignment_submit_rate": "assignment_submission_rate",
    "quiz_score_avg": "quiz_score_avg",
    "project_grade": "project_grade",
    "login_frequency": "login_frequency",
    "video_completion_rate": "video_completion_rate",
    "discussion_participation": "discussion_participation",
    "peer_interaction_score": "peer_interaction_score",
    "days_since_last_login": "days_since_last_login",
    "app_usage_percentage": "app_usage_percentage",
    "satisfaction_rating": "satisfaction_rating",
}


def student_stat(facts: DataFrame) -> DataFrame:
    """One row per enrolment under the served names."""
    return facts.select(*[F.col(c).alias(n) for n, c in _STUDENT_STAT.items()])


def course_stat(facts: DataFrame) -> DataFrame:
    """One row per course. The completion rate averages over known values."""
    summary = summarise_labelled(
        facts,
        "course_id",
        ["course_name", "category", "course_level", "course_duration_days"],
        rows="learner_count",
        sums={"completion_count": "completed"},
        means={
            "completion_rate": "completed",
            "avg_study_time_hours": "time_spent_hours",
            "avg_progress_percentage": "progress_percentage",
            "avg_video_completion_rate": "video_completion_rate",
            "avg_assignment_submit_rate": "assignment_submission_rate",
            "avg_quiz_score": "quiz_score_avg",
            "avg_project_grade": "project_grade",
            "avg_instructor_rating": "instructor_rating",
            "avg_satisfaction_rating": "satisfaction_rating",
            "avg_app_usage_percentage": "app_usage_percentage",
        },
    )
    return summary.withColumn(
        "completion_rate", F.round(F.col("completion_rate") * 100, 2)
    )


def student_feature(facts: DataFrame) -> DataFrame:
    """One row per student: the inputs of a student profile."""
    return facts.groupBy("student_id").agg(
        F.count("*").alias("course_count"),
        F.sum("completed").alias("completed_course_count"),
        F.round(F.avg("completed") * 100, 2).alias("completion_rate"),
        F.sum("time_spent_hours").alias("total_study_time_hours"),
        F.avg("average_session_duration_min").alias("avg_session_duration_min"),
        F.avg("login_frequency").alias("avg_login_frequency"),
        F.avg("video_completion_rate").alias("avg_video_completion_rate"),
        F.avg("progress_percentage").alias("avg_progress_percentage"),
        F.avg("assignment_submission_rate").alias("avg_assignment_submit_rate"),
        F.avg("quiz_score_avg").alias("avg_quiz_score"),
        F.avg("project_grade").alias("avg_project_grade"),
        F.avg("discussion_participation").alias("avg_discussion_participation"),
        F.avg("peer_interaction_score").alias("avg_peer_interaction_score"),
        F.avg("app_usage_percentage").alias("avg_app_usage_percentage"),
        F.avg("satisfaction_rating").alias("avg_satisfaction_rating"),
        F.avg("days_since_last_login").alias("avg_days_since_last_login"),
        F.sum("assignments_missed").alias("total_assignments_missed"),
    )


def served_tables(facts: DataFrame) -> dict[str, DataFrame]:
    """The five tables of the serving database. Each reads ``facts``, so pass a stored
    table."""
    return {
        "student_info": student_info(facts),
        "course_info": course_info(facts),
        "student_stat": with_audit(
            student_stat(facts), "update_date", "create_time", "update_time"
        ),
        "course_stat": with_audit(
            course_stat(facts), "update_date", "create_time", "update_time"
        ),
        "student_feature": with_audit(
            student_feature(facts), "update_date", "update_time"
        ),
    }
