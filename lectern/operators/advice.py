"""Advice texts by label. The labels are fixed values, the texts are ours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern import schema
from lectern.functions.text import lookup
from lectern.operators.risk import is_level

_BENCHMARK, _STEADY, _GROWING = schema.COURSE_TYPES
COURSE_ADVICE = {
    _BENCHMARK: "Strong results: write down what works and show it to other courses.",
    _STEADY: "Runs evenly: keep working on feedback to assignments and on discussion.",
    _GROWING: "Room to grow: look first at students with little progress or high risk.",
}
COURSE_DEFAULT = "Watch completion, submissions and the spread of risk levels."
MEASURE_ADVICE = {
    schema.STUDENT_MEASURES["time"]: "Plan fixed study hours each week.",
    schema.STUDENT_MEASURES["completion"]: "Finish the open chapters first.",
    schema.STUDENT_MEASURES["video"]: "Watch the remaining videos week by week.",
    schema.STUDENT_MEASURES["grade"]: "List the missing assignments and hand them in.",
    schema.STUDENT_MEASURES["score"]: "Go back to the topics behind wrong answers.",
    schema.STABLE_MEASURE: "Keep the present rhythm.",
}
URGENT = "High risk, begin with the weakest point. "
NORMAL = "There is a point to improve. "


def course_advice(course_type: Column) -> Column:
    return F.coalesce(lookup(course_type, COURSE_ADVICE), F.lit(COURSE_DEFAULT))


def add_measure_advice(df: DataFrame) -> DataFrame:
    """Advice for ``weakest_measure``, with a prefix by ``warning_level``."""
    prefix = F.when(is_level(schema.HIGH_MARK), URGENT).otherwise(NORMAL)
    text = lookup(F.col("weakest_measure"), MEASURE_ADVICE)
    return df.withColumn("advice", F.concat(prefix, text))
