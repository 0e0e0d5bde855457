"""From raw text to the cleaned enrolment table, and the report on what was
removed on the way."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lectern import schema
from lectern.functions.parsing import DAY_FORMATS
from lectern.operators import cleaning as C
from lectern.staging import stage, stage_in_parts


@dataclass(frozen=True)
class CleaningRules:
    """Which column gets which treatment. Optional columns may be absent."""

    required: Sequence[str] = tuple(schema.RAW_REQUIRED)
    text: Sequence[str] = tuple(schema.RAW_TEXT)
    gender: str = "Gender"
    category: Sequence[str] = tuple(schema.RAW_CATEGORY)
    integer: Sequence[str] = tuple(schema.RAW_INTEGER)
    decimal: Sequence[str] = tuple(schema.RAW_FLOAT)
    percent: Sequence[str] = tuple(schema.RAW_PERCENT)
    flag: Sequence[str] = tuple(schema.RAW_FLAG)
    date: Sequence[str] = tuple(schema.RAW_DATE)
    date_formats: tuple[str, ...] = DAY_FORMATS
    critical: Sequence[str] = tuple(schema.RAW_REQUIRED)
    keys: Sequence[str] = ("Student_ID", "Course_ID")
    ranges: Mapping[str, tuple[float, float]] = field(
        default_factory=lambda: dict(schema.RAW_RANGES)
    )
    target: str = schema.RAW_TARGET
    personal: Sequence[str] = tuple(schema.RAW_PERSONAL)
    submitted: str = "Assignments_Submitted"
    missed: str = "Assignments_Missed"
    rate: str = "Assignment_Submission_Rate"

    @property
    def numeric(self) -> list[str]:
        return [*self.integer, *self.decimal, *self.percent, *self.flag]

    @property
    def columns(self) -> set[str]:
        return {*self.required, *self.text, *self.numeric, *self.date}


def normalise(df: DataFrame, rules: CleaningRules) -> DataFrame:
    """All steps that look at one row: text, categories, numbers, flags, dates.

    Categories are filled before critical columns are checked, so a blank course
    name becomes "Unknown" and does not remove its row.
    """
    return (
        df.transform(C.clean_headers)
        .transform(C.require_columns, rules.required)
        .transform(C.tidy_text, rules.text)
        .transform(C.drop_null_tokens, rules.text)
        .transform(C.map_category, rules.gender)
        .transform(C.fill_text, rules.category)
        .transform(C.parse_numbers, [*rules.integer, *rules.decimal])
        .transform(C.parse_percentages, rules.percent)
        .transform(C.parse_flags, rules.flag)
        .transform(C.parse_dates, rules.date, rules.date_formats)
    )


def select_valid(
    normalised: DataFrame, rules: CleaningRules, order: Sequence[str | Column]
) -> DataFrame:
    """Rows with all critical values, the last one per key, inside all ranges."""
    complete = ~C.is_missing(rules.critical)
    last = C.keep_last(normalised, rules.keys, order, among=complete)
    return C.drop_out_of_range(last, rules.ranges)


def finish(valid: DataFrame, rules: CleaningRules) -> DataFrame:
    """Fill what is missing, derive the submission rate, settle the types."""
    measures = [c for c in rules.numeric if c != rules.target]
    return (
        valid.transform(C.fill_medians, measures)
        .transform(C.fill_text, [c for c, kind in valid.dtypes if kind == "string"])
        .transform(C.add_submission_rate, rules.submitted, rules.missed, rules.rate)
        .drop(*rules.personal)
        .transform(C.round_whole, [*rules.integer, *rules.flag])
        .transform(C.round_decimals, [*rules.decimal, *rules.percent, rules.rate])
    )


def clean_enrollments(
    raw: DataFrame, order: Sequence[str], rules: CleaningRules = CleaningRules()
) -> DataFrame:
    """The whole cleaning. ``order`` names columns that give the file's row order;
    those that are not enrolment columns are left out of the result.

    The rows that survive are stored once, because the medians and the filled
    table both read them.
    """
    valid = stage_in_parts(
        normalise(raw, rules), rules.keys, lambda part: select_valid(part, rules, order), stage
    )
    return finish(valid, rules).drop(*[c for c in order if c not in rules.columns])


def clean_and_report(
    raw: DataFrame, order: Sequence[str], rules: CleaningRules = CleaningRules()
) -> tuple[DataFrame, DataFrame]:
    """The cleaned rows and the report on what was removed, both from one reading of ``raw``.

    The counts are observed by the tasks that store the surviving rows. After a lost
    executor tasks that ran twice may count twice; ``cleaning_report`` counts by queries.
    """
    read, last, kept = [], [], []
    complete = ~C.is_missing(rules.critical)

    def counted(df: DataFrame, counts: list[Observation], *more: Column) -> DataFrame:
        counts.append(Observation())
        return df.observe(counts[-1], F.count("*").alias("rows"), *more)

    def survivors(part: DataFrame) -> DataFrame:
        normalised = counted(part, read, F.count_if(complete).alias("complete"))
        newest = counted(C.keep_last(normalised, rules.keys, order, among=complete), last)
        return counted(C.drop_out_of_range(newest, rules.ranges), kept)

    def total(counts: list[Observation], name: str = "rows") -> int:
        return sum(c.get[name] for c in counts)

    valid = stage_in_parts(normalise(raw, rules), rules.keys, survivors, stage)
    rows, whole, last_rows = total(read), total(read, "complete"), total(last)
    counts = raw.sparkSession.range(1).select(
        F.lit(rows).alias("input_rows"),
        F.lit(rows - whole).alias("critical_removed"),
        F.lit(whole - last_rows).alias("duplicates_removed"),
        F.lit(last_rows - total(kept)).alias("out_of_range_removed"),
    )
    cleaned = finish(valid, rules).drop(*[c for c in order if c not in rules.columns])
    return cleaned, _report(counts, raw, order, rules)


def cleaning_counts(
    raw: DataFrame, order: Sequence[str], rules: CleaningRules = CleaningRules()
) -> DataFrame:
    """One row: input rows and the rows each step removes.

    The parsed rows are reduced to keys, order and two flags and stored while the plan is
    built. Rows are counted per key by hash aggregation; the last row of each key is found
    by ``keep_last``. Both combine inside each task before the shuffle, so a key with very
    many copies costs one row per task.
    """
    normalised = normalise(raw, rules)
    flags = stage(
        normalised.select(
            *rules.keys,
            *[c for c in order if c not in rules.keys],
            (~C.is_missing(rules.critical)).alias("_complete"),
            C.out_of_range(normalised, rules.ranges).alias("_bad"),
        )
    )
    complete = flags.filter("_complete")
    counts = flags.agg(
        F.count("*").alias("input_rows"),
        F.count_if(~F.col("_complete")).alias("critical_removed"),
        F.count_if("_complete").alias("_complete_rows"),
    )
    last = C.keep_last(complete, rules.keys, order).agg(
        F.count("*").alias("kept"), F.count_if("_bad").alias("bad")
    )
    return counts.withColumn("_last", last.select(F.struct("*")).scalar()).select(
        "input_rows",
        "critical_removed",
        (F.col("_complete_rows") - F.col("_last.kept")).alias("duplicates_removed"),
        F.col("_last.bad").alias("out_of_range_removed"),
    )


def cleaning_report(
    raw: DataFrame, order: Sequence[str], rules: CleaningRules = CleaningRules()
) -> DataFrame:
    """Seven (metric, value) rows."""
    counts = cleaning_counts(raw, order, rules)
    return _report(counts, raw, order, rules)


def _report(
    counts: DataFrame, raw: DataFrame, order: Sequence[str], rules: CleaningRules
) -> DataFrame:
    headers = C.clean_headers(raw).columns
    columns_in = len([c for c in headers if c in rules.columns or c not in order])
    personal = len({*rules.personal} & {*headers})
    derived = int({rules.submitted, rules.missed} <= {*headers})
    removed = ("critical_removed", "duplicates_removed", "out_of_range_removed")
    final = F.col("input_rows")
    for name in removed:
        final = final - F.col(name)
    values = [
        F.col("input_rows"),
        F.lit(columns_in),
        *[F.col(name) for name in removed],
        final,
        F.lit(columns_in - personal + derived),
    ]
    rows = F.array(
        *[
            F.struct(F.lit(m).alias("metric"), v.cast("bigint").alias("value"))
            for m, v in zip(schema.CLEANING_METRICS, values)
        ]
    )
    return counts.select(F.inline(rows))
