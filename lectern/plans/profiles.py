"""Student and teacher profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern import schema
from lectern.functions.numeric import half_up, rate_to_percent, zero_if_null
from lectern.operators import benchmark
from lectern.operators.joining import first_per_key, lookup, lookup_or_zero
from lectern.operators.nesting import nest
from lectern.operators.selecting import filter_equals
from lectern.plans.layers import course_stat, student_dimension, student_feature
from lectern.staging import stage

BENCHMARKS = {
    "bench_time": "avg_study_time_hours",
    "bench_completion": "avg_progress",
    "bench_score": "avg_quiz_score",
    "bench_grade": "avg_submit_rate",
    "bench_video": "avg_video_completion_rate",
}
# Student-level measures as served, with two decimals.
_FEATURES = (
    "completion_rate",
    "avg_project_grade",
    "avg_quiz_score",
    "avg_video_completion_rate",
)


def student_table(facts: DataFrame) -> DataFrame:
    """Stored summary per student: measures, and attributes as one struct."""
    basic = first_per_key(student_dimension(facts), ["student_id"])
    return stage(
        student_feature(facts).join(
            basic.select(
                "student_id",
                F.struct("student_id", *schema.STUDENT_ATTRIBUTES).alias("basic"),
            ),
            "student_id",
            "left",
        )
    )


def _feature_or(feature: str, fallback: str) -> Column:
    """The student's own measure, or the enrolment's when the student has none
    stored. A stored NULL reads as 0."""
    stored = F.col("has_features").isNotNull()
    return zero_if_null(F.when(stored, F.col(feature)).otherwise(F.col(fallback)))


def attach_features(scored: DataFrame, students: DataFrame) -> DataFrame:
    """Enrolments with ``value_<measure>``. Study time is the enrolment's own, the
    other measures describe the student, rounded as they are served."""
    measures = [half_up(F.col(c)).alias(f"feature_{c}") for c in _FEATURES]
    joined = lookup(
        scored,
        students,
        "student_id",
        [*measures, F.lit(True).alias("has_features")],
        rows="course_count",
        spread=["course_id", "enrollment_date"],
    )
    return joined.withColumns(
        {
            "value_time": zero_if_null(F.col("time_spent_hours")),
            "value_completion": _feature_or(
                "feature_completion_rate", "progress_percentage"
            ),
            "value_video": _feature_or(
                "feature_avg_video_completion_rate", "video_completion_rate"
            ),
            "value_grade": _feature_or(
                "feature_avg_project_grade", "assignment_submission_rate"
            ),
            "value_score": _feature_or("feature_avg_quiz_score", "quiz_score_avg"),
        }
    ).drop("has_features", *[f"feature_{c}" for c in _FEATURES])


def benchmarked(
    scored: DataFrame, students: DataFrame, course_risk: DataFrame
) -> DataFrame:
    """Enrolments with ``value_*`` and ``bench_*`` measures, from the stored
    student and course summaries."""
    valued = attach_features(scored, students)
    return lookup_or_zero(
        valued,
        course_risk,
        "course_id",
        BENCHMARKS,
        rows="student_count",
        spread=["student_id", "time_spent_hours"],
    )


def student_benchmark(profiles: DataFrame) -> DataFrame:
    names = [f"{kind}_{m}" for kind in ("value", "bench", "above") for m in benchmark.MEASURES]
    return benchmark.add_comparison(profiles).select("student_id", "course_id", *names)


def student_report(profiles: DataFrame) -> DataFrame:
    """The thirteen fields of a student's report, one row per enrolment."""
    dash = "--"
    name = (
        F.col("student_name") if "student_name" in profiles.columns else F.lit(None)
    ).cast("string")

    def text(column: Column) -> Column:
        return F.coalesce(F.nullif(column, F.lit("")), F.lit(dash))

    return profiles.select(
        text(F.col("student_id")).alias("student_id"),
        text(name).alias("student_name"),
        text(F.col("education_level")).alias("education_level"),
        text(F.col("course_id")).alias("course_id"),
        text(F.col("course_name")).alias("course_name"),
        F.col("value_time").alias("total_study_time_hours"),
        F.col("bench_time").alias("class_avg_study_time_hours"),
        F.col("value_completion").alias("completion_rate"),
        F.col("value_video").alias("video_completion_rate"),
        zero_if_null(F.col("assignment_submission_rate")).alias(
            "assignment_submission_rate"
        ),
        F.col("value_score").alias("avg_quiz_score"),
        text(F.col("warning_level")).alias("warning_level"),
        "risk_sum",
    )


def student_profile(
    scored: DataFrame, students: DataFrame, student_id: str | None = None
) -> DataFrame:
    """Nested profile: who the student is, the student's measures, and one row per
    course taken with its warning.

    The courses stay rows. Gathered into one array per student they would make a
    single value of a student with very many enrolments.
    """
    scored = filter_equals(scored, student_id=student_id)
    measures = [c for c in students.columns if c not in ("student_id", "basic")]
    courses = scored.select(
        "student_id",
        F.struct(
            "course_id",
            "course_name",
            "category",
            "course_level",
            F.col("time_spent_hours").alias("total_study_time_hours"),
            "progress_percentage",
            "quiz_score_avg",
        ).alias("course"),
        F.struct(
            "warning_level", "risk_sum", *[f"{r}_risk" for r in schema.RULE_LABELS]
        ).alias("warning"),
    )
    return lookup(
        courses,
        students,
        "student_id",
        ["basic", F.struct(*measures).alias("feature")],
        rows="course_count",
        spread=["course"],
    )


COURSE_ORDER = ("enrollment_date", "course_id")
_LEVEL_COUNTS = {
    schema.HIGH: "high_risk_count",
    schema.MID: "mid_risk_count",
    schema.LOW: "low_risk_count",
    schema.SAFE: "safe_count",
}


def nested_profile(
    scored: DataFrame, students: DataFrame, student_id: str | None = None
) -> DataFrame:
    """A profile as one object per student: ``basic``, ``feature``, ``warning`` and the array
    ``courses``, by date of enrolment and course.

    ``warning`` is the student's greatest risk with its level and the number of courses on
    each level. A course holds its measures and its own warning. The courses of one student
    are gathered in bounded runs (``operators.nesting``).
    """
    scored = filter_equals(scored, student_id=student_id)
    course = F.struct(
        "course_id",
        "course_name",
        "category",
        "course_level",
        "enrollment_date",
        F.struct(
            F.col("time_spent_hours").alias("total_study_time_hours"),
            "progress_percentage",
            "quiz_score_avg",
        ).alias("feature"),
        F.struct(
            "warning_level", "risk_sum", *[f"{r}_risk" for r in schema.RULE_LABELS]
        ).alias("warning"),
    )
    courses = nest(scored, ["student_id"], COURSE_ORDER, course, "courses")
    worst = scored.groupBy("student_id").agg(
        F.max(F.struct("risk_sum", "warning_level")).alias("worst"),
        *[F.count_if(F.col("warning_level") == v).alias(n) for v, n in _LEVEL_COUNTS.items()],
    )
    warning = worst.select(
        F.col("student_id").alias("_warned"),
        F.struct("worst.warning_level", "worst.risk_sum", *_LEVEL_COUNTS.values()).alias("warning"),
    )
    measures = [c for c in students.columns if c not in ("student_id", "basic")]
    known = students.select(
        F.col("student_id").alias("_known"), "basic", F.struct(*measures).alias("feature")
    )
    # A missing student id is a student of its own.
    return (
        courses.join(warning, F.col("student_id").eqNullSafe(F.col("_warned")))
        .join(known, F.col("student_id").eqNullSafe(F.col("_known")), "left")
        .select("student_id", "basic", "feature", "warning", "courses")
    )


# detail name -> (fallback in the risk summary)
_TEACHER_FALLBACK = {
    "avg_quiz_score": "avg_quiz_score",
    "avg_assignment_submit_rate": "avg_submit_rate",
    "avg_student_progress": "avg_progress",
    "avg_video_completion": "avg_video_completion_rate",
}


def teacher_detail(facts: DataFrame) -> DataFrame:
    """A teacher's course: the course summary under the names of the profile."""
    summary = course_stat(facts)
    return summary.select(
        "course_id",
        "course_name",
        F.col("category").alias("course_category"),
        F.col("learner_count").alias("total_student_count"),
        F.try_divide("completion_count", "learner_count").alias("course_finish_rate"),
        half_up(F.col("avg_quiz_score")).alias("avg_quiz_score"),
        half_up(F.col("avg_assignment_submit_rate")).alias("avg_assignment_submit_rate"),
        half_up(F.col("avg_progress_percentage")).alias("avg_student_progress"),
        half_up(F.col("avg_video_completion_rate")).alias("avg_video_completion"),
        half_up(F.col("avg_satisfaction_rating")).alias("avg_student_satisfaction"),
    )


def teacher_profile(detail: DataFrame, course_risk: DataFrame) -> DataFrame:
    """Detail with the risk row of its course; a measure the detail lacks comes
    from the risk row."""
    risk = course_risk.select(
        "course_id",
        *[F.col(c).alias(f"risk_{c}") for c in {*_TEACHER_FALLBACK.values()}],
        F.col("student_count").alias("risk_student_count"),
        "high_risk_pct",
        "high_risk_count",
        "mid_risk_count",
        "low_risk_count",
        "safe_count",
    )
    joined = detail.join(risk, "course_id", "left")
    measures = [
        F.coalesce(F.col(name), F.col(f"risk_{fallback}"), F.lit(0.0)).alias(name)
        for name, fallback in _TEACHER_FALLBACK.items()
    ]
    counts = ("high_risk_count", "mid_risk_count", "low_risk_count", "safe_count")
    return joined.select(
        "course_id",
        "course_name",
        "course_category",
        F.coalesce(
            F.nullif(F.col("total_student_count"), F.lit(0)),
            F.col("risk_student_count"),
        ).alias("student_count"),
        half_up(rate_to_percent(F.col("course_finish_rate"))).alias("finish_rate"),
        *measures,
        "avg_student_satisfaction",
        "high_risk_pct",
        *[zero_if_null(F.col(c)).alias(c) for c in counts],
    )
