"""The four risk rules of an enrolment and the level they add up to.

A missing measure counts as 0, so it is a risk for every rule with a lower bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern import schema
from lectern.functions.numeric import zero_if_null

RULES = ("login", "assignment", "progress", "score")


def _measure(name: str) -> Column:
    return zero_if_null(F.col(name))


def risk_rules() -> dict[str, Column]:
    # The thresholds.
    return {
        "login": (_measure("login_frequency") < 4)
        | (_measure("days_since_last_login") > 10),
        "assignment": (_measure("assignment_submission_rate") < 50)
        | (_measure("assignments_missed") > 4),
        "progress": (_measure("progress_percentage") < 30)
        & (_measure("video_completion_rate") < 40),
        "score": _measure("quiz_score_avg") < 55,
    }


def add_risk_flags(df: DataFrame) -> DataFrame:
    return df.withColumns({f"{r}_risk": c for r, c in risk_rules().items()})


def level_of(risk_sum: Column) -> Column:
    return (
        F.when(risk_sum >= 3, schema.HIGH)
        .when(risk_sum == 2, schema.MID)
        .when(risk_sum == 1, schema.LOW)
        .otherwise(schema.SAFE)
    )


def add_risk_level(
    df: DataFrame, supplied_level: str | None = None, supplied_sum: str | None = None
) -> DataFrame:
    """Flags, their sum and the level; supplied values win over computed ones."""
    flagged = add_risk_flags(df)
    computed = sum(
        (F.col(f"{r}_risk").cast("int") for r in RULES[1:]),
        F.col(f"{RULES[0]}_risk").cast("int"),
    )
    level = level_of(computed)
    if supplied_level:
        level = F.coalesce(F.nullif(F.col(supplied_level), F.lit("")), level)
    risk_sum = (
        F.coalesce(F.col(supplied_sum), computed) if supplied_sum else computed
    )
    return flagged.withColumns({"risk_sum": risk_sum, "warning_level": level})


def add_risk_detail(df: DataFrame) -> DataFrame:
    """A label per rule and one summary text."""
    labels = {
        f"{r}_rule": F.when(F.col(f"{r}_risk"), schema.RULE_LABELS[r][0]).otherwise(
            schema.RULE_LABELS[r][1]
        )
        for r in RULES
    }
    risky, normal = schema.RULE_WORDS
    parts = [
        F.concat(
            F.lit(f"{schema.RULE_TITLES[r]}:"),
            F.when(F.col(f"{r}_risk"), risky).otherwise(normal),
        )
        for r in RULES
    ]
    return df.withColumns({**labels, "rule_summary": F.concat_ws(" / ", *parts)})


def is_level(mark: str, column: str = "warning_level") -> Column:
    """Level text contains the mark; a missing level contains nothing."""
    return F.coalesce(F.contains(F.col(column), F.lit(mark)), F.lit(False))
