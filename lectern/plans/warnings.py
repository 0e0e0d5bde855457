"""Risk summaries over all enrolments and what is read from them.

``scored`` is the enrolment table with ``risk_sum`` and ``warning_level``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern import schema
from lectern.functions.numeric import half_up, percent_of, zero_if_null
from lectern.operators.aggregate import (
    average_columns,
    mean,
    share_by_label,
    summarise_labelled,
    tally,
)
from lectern.operators.benchmark import add_persona
from lectern.operators.joining import merge_left
from lectern.operators.numbering import number_rows
from lectern.operators.risk import add_risk_detail, add_risk_level
from lectern.staging import stage

LEVELS = {
    "high_risk_count": schema.HIGH,
    "mid_risk_count": schema.MID,
    "low_risk_count": schema.LOW,
    "safe_count": schema.SAFE,
}
PLATFORM_MEASURES = {
    "platform_score": "avg_quiz_score",
    "platform_submit": "avg_submit_rate",
    "platform_progress": "avg_progress",
    "platform_video": "avg_video_completion_rate",
    "platform_risk": "high_risk_pct",
}


def scored_enrolments(facts: DataFrame) -> DataFrame:
    return add_risk_level(facts)


def warning_details(scored: DataFrame) -> DataFrame:
    return add_risk_detail(scored).select(
        "student_id",
        "course_id",
        "course_name",
        "warning_level",
        "risk_sum",
        "login_rule",
        "assignment_rule",
        "progress_rule",
        "score_rule",
        "progress_percentage",
        "rule_summary",
    )


def warning_distribution(scored: DataFrame) -> DataFrame:
    """``student_count`` counts enrolments: a warning belongs to a student in a
    course."""
    return share_by_label(scored, "warning_level", "student_count", "risk_ratio_pct")


def _is(level: str):
    return F.col("warning_level") == level


def course_risk_summary(scored: DataFrame) -> DataFrame:
    """One row per course."""
    summary = summarise_labelled(
        scored,
        "course_id",
        ["course_name"],
        rows="student_count",
        tallies={name: _is(level) for name, level in LEVELS.items()},
        means={
            "avg_quiz_score": "quiz_score_avg",
            "avg_submit_rate": "assignment_submission_rate",
            "avg_progress": "progress_percentage",
            "avg_video_completion_rate": "video_completion_rate",
            "avg_study_time_hours": "time_spent_hours",
        },
    )
    averages = [c for c in summary.columns if c.startswith("avg_")]
    return summary.withColumns(
        {
            **{c: half_up(F.col(c)) for c in averages},
            "high_risk_pct": percent_of(
                F.col("high_risk_count"), F.col("student_count")
            ),
        }
    )


def education_risk_summary(scored: DataFrame) -> DataFrame:
    """One row per education level, with its share of all enrolments."""
    grouped = scored.groupBy("education_level").agg(
        F.count("*").alias("student_count"),
        tally(_is(schema.HIGH)).alias("high_risk_count"),
        tally(_is(schema.SAFE)).alias("safe_count"),
        mean("time_spent_hours").alias("avg_total_study_hours"),
        mean("quiz_score_avg").alias("avg_quiz_score"),
        mean("assignment_submission_rate").alias("avg_submit_rate"),
    )
    count = F.col("student_count")
    everyone = grouped.agg(F.sum("student_count")).scalar()
    return grouped.withColumns(
        {
            "ratio_pct": percent_of(count, everyone),
            "high_risk_pct": percent_of(F.col("high_risk_count"), count),
            "safe_pct": percent_of(F.col("safe_count"), count),
        }
    )


def platform_average(course_risk: DataFrame) -> DataFrame:
    """Unweighted mean over courses: every course counts the same."""
    return average_columns(course_risk, PLATFORM_MEASURES)


def course_weak_items(course_risk: DataFrame) -> DataFrame:
    """Measures of a course below the platform average, as a list, and whether
    its share of high risk lies above. ``course_risk`` is read twice, so pass a
    stored table."""
    platform = {m: F.col(f"_platform.{n}") for n, m in PLATFORM_MEASURES.items()}
    averages = platform_average(course_risk).select(F.struct("*")).scalar()
    weak = [
        F.when(zero_if_null(F.col(m)) < platform[m], label)
        for m, label in schema.COURSE_WEAK_ITEMS.items()
    ]
    above = zero_if_null(F.col("high_risk_pct")) > platform["high_risk_pct"]
    return course_risk.withColumn("_platform", averages).select(
        "course_id",
        "course_name",
        F.concat_ws(schema.COURSE_WEAK_SEPARATOR, *weak).alias("weak_items"),
        above.alias("risk_above_platform"),
    )


def course_merged(enrollment: DataFrame, course_risk: DataFrame) -> DataFrame:
    """Enrolment ranking with the risk columns of the course."""
    return merge_left(enrollment, course_risk, "course_id")


def course_positions(course_risk: DataFrame) -> DataFrame:
    """Place of every course by score (high first) and by risk (low first)."""
    wanted = course_risk.select("course_id", "avg_quiz_score", "high_risk_pct")
    by_score = number_rows(
        wanted,
        zero_if_null(F.col("avg_quiz_score")).desc(),
        F.col("course_id"),
        name="score_position",
    )
    by_risk = number_rows(
        by_score,
        zero_if_null(F.col("high_risk_pct")),
        F.col("course_id"),
        name="risk_position",
    )
    peers = wanted.agg(F.count("*").alias("n"))
    return by_risk.withColumn("peer_count", peers.scalar())


def persona_share(profiles: DataFrame) -> DataFrame:
    """Rows per persona label and their share."""
    return share_by_label(
        add_persona(profiles), "persona_label", "student_count", "ratio_percent"
    )


def stored_course_risk(scored: DataFrame) -> DataFrame:
    """The summary as a stored table, for consumers that read it repeatedly."""
    return stage(course_risk_summary(scored))
