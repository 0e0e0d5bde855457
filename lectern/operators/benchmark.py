"""A student's five measures against the course benchmark.

Inputs carry ``value_<measure>`` and ``bench_<measure>`` columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern import schema
from lectern.functions.numeric import all_of, half_up
from lectern.operators.risk import is_level

MEASURES = tuple(schema.STUDENT_MEASURES)


def value(measure: str) -> Column:
    return F.col(f"value_{measure}")


def bench(measure: str) -> Column:
    return F.col(f"bench_{measure}")


def at_least(measure: str, factor: float = 1.0) -> Column:
    return value(measure) >= bench(measure) * factor


def add_comparison(df: DataFrame) -> DataFrame:
    """``above_<measure>``: at or above the benchmark."""
    return df.withColumns({f"above_{m}": at_least(m) for m in MEASURES})


def add_weakest_measure(df: DataFrame) -> DataFrame:
    """The measure furthest below the benchmark, by ratio; measures that reach
    92 % of it do not count. The first measure wins a tie."""
    ratios = {
        m: F.when(
            value(m) < bench(m) * schema.WEAK_RATIO, F.try_divide(value(m), bench(m))
        )
        for m in MEASURES
    }
    # least() skips NULLs
    lowest = F.least(*ratios.values())
    name = reduce(
        lambda chain, m: chain.when(ratios[m] == lowest, schema.STUDENT_MEASURES[m]),
        MEASURES[1:],
        F.when(
            ratios[MEASURES[0]] == lowest, schema.STUDENT_MEASURES[MEASURES[0]]
        ),
    ).otherwise(schema.STABLE_MEASURE)
    return df.withColumns({"weakest_measure": name, "weakest_ratio": lowest})


def add_strong_peer(df: DataFrame) -> DataFrame:
    """``peer_<measure>``: what a strong peer reaches, from the benchmark."""
    targets = {}
    for m, (factor, digits, ceiling) in schema.STRONG_PEER.items():
        target = half_up(bench(m) * factor, digits)
        targets[f"peer_{m}"] = (
            target if ceiling is None else F.least(F.lit(ceiling), target)
        )
    return df.withColumns(targets)


def add_persona(df: DataFrame, supplied: str | None = None) -> DataFrame:
    """Supplied label, else the first rule that holds."""
    labels = schema.PERSONA_LABELS
    lead = all_of([at_least(m, f) for m, f in schema.PERSONA_LEAD.items()])
    solid = all_of([at_least(m) for m in ("completion", "video", "grade")])
    label = (
        F.when(lead, labels["leader"])
        .when(solid, labels["advancing"])
        .when(is_level(schema.HIGH_MARK), labels["at_risk"])
        .when(is_level(schema.MID_MARK), labels["wavering"])
        .otherwise(labels["steady"])
    )
    if supplied:
        label = F.coalesce(F.nullif(F.col(supplied), F.lit("")), label)
    return df.withColumn("persona_label", label)
