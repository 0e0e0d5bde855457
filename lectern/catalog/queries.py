"""One callable per operator: ``(spark, data folder) -> DataFrame``.

Every query runs over the whole tables. Dates are handed over as text and
decimals as doubles, so that values compare alike across engines.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern import schema
from lectern.functions.numeric import rate_to_percent
from lectern.functions.text import first_text
from lectern.operators import benchmark, cleaning, gates, selecting
from lectern.operators.advice import add_measure_advice, course_advice
from lectern.operators.aggregate import filter_share, gathered, sum_columns
from lectern.operators.counting import counted_load
from lectern.operators.risk import add_risk_flags, is_level
from lectern.plans import layers, marts, overview, profiles, sync, warnings
from lectern.plans import cleaning as cleaning_plan
from lectern.sinks import files as sinks
from lectern.sinks import swap
from lectern.sources import files as scans
from lectern.sources.views import learning, ods_learning, raw_learning, scan_table
from lectern.staging import scratch_path, stage, stage_in_parts

Query = Callable[[SparkSession, str], DataFrame]

LINE_ORDER = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]
RISK_KEY = ["student_id", "course_id", "warning_level", "risk_sum"]


def comparable(df: DataFrame) -> DataFrame:
    def plain(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        return column.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def _facts(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(build(learning(spark, sf_dir)))


def _scored(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _facts(lambda facts: build(warnings.scored_enrolments(facts)))


def _course_risk(build: Callable[[DataFrame], DataFrame]) -> Query:
    """Consumers of the stored course risk summary."""
    return _scored(lambda scored: build(warnings.stored_course_risk(scored)))


def _raw(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(build(raw_file(spark, sf_dir)))


def _stored(build: Callable[[DataFrame], DataFrame]) -> Query:
    """Consumers that read the facts several times: the view is joined once and stored."""
    return _facts(lambda facts: build(stage(facts)))


def _stored_columns(columns: Sequence[str], build: Callable[[DataFrame], DataFrame]) -> Query:
    """The same with the columns that are read only."""
    return _facts(lambda facts: build(stage(facts.select(*columns))))


def _profiles(build: Callable[[DataFrame], DataFrame]) -> Query:
    def run(facts: DataFrame) -> DataFrame:
        scored = warnings.scored_enrolments(facts)
        students = profiles.student_table(facts)
        course_risk = warnings.stored_course_risk(scored)
        return build(profiles.benchmarked(scored, students, course_risk))

    return _stored(run)


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Sums of fractions depend on the order of addition in their last digits."""
    return df.select(
        *[
            F.round(f.name, digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else f.name
            for f in df.schema.fields
        ]
    )


# --------------------------------------------------------------------------
# Cleaning
# --------------------------------------------------------------------------
def raw_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty enrolments under the 40 headers of the raw file, and its order columns."""
    return raw_learning(spark, sf_dir)


RULES = cleaning_plan.CleaningRules()
TEXT_COLUMNS = ["Student_ID", "Gender", "City"]
FILLED = ["Student_ID", "Course_ID", "Age", "Progress_Percentage"]


def _tidy(raw: DataFrame) -> DataFrame:
    return cleaning.tidy_text(raw, TEXT_COLUMNS)


def _tokens(raw: DataFrame) -> DataFrame:
    return cleaning.drop_null_tokens(_tidy(raw), TEXT_COLUMNS)


def _normalised(raw: DataFrame) -> DataFrame:
    return cleaning_plan.normalise(raw, RULES)


def _valid(raw: DataFrame) -> DataFrame:
    return cleaning_plan.select_valid(_normalised(raw), RULES, LINE_ORDER)


def _messy_headers(facts: DataFrame) -> DataFrame:
    return facts.toDF(*["  " + c.replace("_", "\t ") + " " for c in facts.columns])


CLEANING: dict[str, Query] = {
    "clean_headers": _facts(lambda f: cleaning.clean_headers(_messy_headers(f))),
    "clean_text": _raw(lambda r: _tidy(r).select(*LINE_ORDER, *TEXT_COLUMNS)),
    "clean_null_tokens": _raw(lambda r: _tokens(r).select(*LINE_ORDER, *TEXT_COLUMNS)),
    "clean_category_map": _raw(
        lambda r: cleaning.map_category(_tokens(r), "Gender").select(
            *LINE_ORDER, "Gender"
        )
    ),
    "clean_fill_unknown": _raw(
        lambda r: cleaning.fill_text(_tokens(r), ["City"]).select(*LINE_ORDER, "City")
    ),
    "clean_numeric": _raw(
        lambda r: cleaning.parse_numbers(r, ["Age"]).select(*LINE_ORDER, "Age")
    ),
    "clean_percentage": _raw(
        lambda r: cleaning.parse_percentages(r, ["Progress_Percentage"]).select(
            *LINE_ORDER, "Progress_Percentage"
        )
    ),
    "clean_boolean": _raw(
        lambda r: cleaning.parse_flags(r, ["Completed"]).select(
            *LINE_ORDER, "Completed"
        )
    ),
    "clean_date": _raw(
        lambda r: cleaning.parse_dates(r, ["Enrollment_Date"]).select(
            *LINE_ORDER, "Enrollment_Date"
        )
    ),
    "clean_drop_critical": _raw(
        lambda r: cleaning.drop_missing(_normalised(r), RULES.critical).select(
            *LINE_ORDER, "Student_ID", "Course_ID", "Completed"
        )
    ),
    "clean_dedupe_last": _raw(
        lambda r: cleaning.keep_last(_normalised(r), RULES.keys, LINE_ORDER).select(
            *LINE_ORDER, "Student_ID", "Course_ID", "Age"
        )
    ),
    "clean_range_filter": _raw(
        lambda r: cleaning.drop_out_of_range(_normalised(r)).select(
            *LINE_ORDER, "Age", "Progress_Percentage", "Completed"
        )
    ),
    "clean_median_fill": _raw(
        lambda r: cleaning.fill_medians(
            stage(_valid(r).select(*FILLED)), ["Age", "Progress_Percentage"]
        )
    ),
    "clean_submission_rate": _facts(
        lambda f: cleaning.add_submission_rate(
            f, "assignments_submitted", "assignments_missed", "rate"
        ).select("student_id", "course_id", "payment_amount", "rate")
    ),
    "clean_int_round": _facts(
        lambda f: cleaning.round_whole(f, ["time_spent_hours", "project_grade"]).select(
            "student_id", "course_id", "time_spent_hours", "project_grade"
        )
    ),
    "clean_float_round": _facts(
        lambda f: cleaning.round_decimals(f, ["assignment_submission_rate"]).select(
            "student_id", "course_id", "assignment_submission_rate"
        )
    ),
    "clean_report": _raw(
        lambda r: cleaning_plan.cleaning_report(r, LINE_ORDER, RULES)
    ),
    "clean_load_report": _raw(
        lambda r: cleaning_plan.clean_and_report(r, LINE_ORDER, RULES)[1]
    ),
    "clean_enrollments": _raw(
        lambda r: cleaning_plan.clean_enrollments(r, LINE_ORDER, RULES)
    ),
}


# --------------------------------------------------------------------------
# Layers and gates
# --------------------------------------------------------------------------
OVERFLOW_TARGET = [
    ("payment_amount", "decimal(5,2)"),
    ("time_spent_hours", "decimal(12,2)"),
    ("days_since_last_login", "tinyint"),
]
AUDIT = ("update_date", "create_time", "update_time")


def _typed(build: Callable[[DataFrame], DataFrame]) -> Query:
    """Consumers of the typed layer, built from text with bad values in it."""
    return lambda spark, sf_dir: comparable(
        build(layers.typed(ods_learning(spark, sf_dir)))
    )


def _conformed(facts: DataFrame) -> DataFrame:
    target = [(n, k) for n, k in schema.TARGETS["student_stat"] if n not in AUDIT]
    return gates.conform_types(layers.student_stat(facts), target)


def _conform_columns(facts: DataFrame) -> DataFrame:
    names = [n for n, _ in schema.TARGETS["course_stat"]]
    served = layers.served_tables(gathered(facts, "course_id"))["course_stat"]
    return _rounded(
        gates.conform_columns(served, names, "course_stat").drop(*AUDIT)
    )


def _reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = learning(spark, sf_dir)
    path = scratch_path(spark, "reconcile")
    sinks.write_orc(facts, path)
    return gates.reconcile_counts(facts, scans.scan_orc(spark, path))


def _served(spark: SparkSession, sf_dir: str) -> str:
    """The folder that holds the five served tables as ORC."""
    newest = ["enrollment_date", "payment_amount", "login_frequency"]
    facts = stage_in_parts(
        learning(spark, sf_dir),
        schema.KEY,
        lambda part: cleaning.keep_last(part, schema.KEY, newest),
        stage,
    )
    source = scratch_path(spark, "served")
    for table, rows in layers.served_tables(facts).items():
        sinks.write_orc(rows, f"{source}/{table}")
    return source


def _synced(table: str) -> Query:
    """A served table as it arrived: through ORC and all gates into a folder."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        newest = ["enrollment_date", "payment_amount", "login_frequency"]
        # Not stored: the table reads the facts once, and only its own columns of them.
        facts = cleaning.keep_last(learning(spark, sf_dir), schema.KEY, newest)
        source, folder = scratch_path(spark, "served"), scratch_path(spark, "target")
        sinks.write_orc(layers.served_tables(facts)[table], f"{source}/{table}")
        task = sync.SyncTask(f"{source}/{table}", table)
        sync.sync_tables(spark, [task], sync.folder_target(spark, folder))
        landed = spark.read.parquet(f"{folder}/{table}")
        return comparable(landed.drop(*AUDIT))

    return run


def _summed(df: DataFrame, name: str) -> DataFrame:
    """One row on a table: its rows, the sum of all its numbers, the characters of its texts."""
    df = comparable(df)
    texts = [F.length(c) for c, kind in df.dtypes if kind == "string"]
    numbers = [F.col(c).cast("double") for c, kind in df.dtypes if kind != "string"]

    def total(columns: list[Column]) -> Column:
        cells = [F.coalesce(F.sum(c), F.lit(0)) for c in columns] or [F.lit(0)]
        return sum(cells[1:], cells[0])

    return df.agg(
        F.lit(name).alias("name"),
        F.count("*").alias("row_count"),
        F.round(total(numbers).cast("double"), 2).alias("number_sum"),
        total(texts).cast("bigint").alias("text_chars"),
    )


def _all_summed(tables: dict[str, DataFrame]) -> DataFrame:
    first, *others = [_summed(df, name) for name, df in tables.items()]
    for other in others:
        first = first.unionByName(other)
    return first


def _sync_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five tasks in one call, and what arrived of each."""
    source, folder = _served(spark, sf_dir), scratch_path(spark, "target")
    tasks = [sync.SyncTask(f"{source}/{table}", table) for table in schema.TARGETS]
    results = sync.sync_tables(spark, tasks, sync.folder_target(spark, folder))
    return _all_summed(
        {r.table: spark.read.parquet(f"{folder}/{r.table}").drop(*AUDIT) for r in results}
    )


def _altered(facts: DataFrame) -> DataFrame:
    return facts.withColumn("payment_amount", F.lit(-1.0))


def _managed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A namespace, a table created from a query twice, at first with an altered column, and its
    scan. Names are unique, and the table is dropped once its rows are stored."""
    before = spark.catalog.currentDatabase()
    name = f"lectern_{uuid.uuid4().hex}"
    facts = learning(spark, sf_dir)
    scans.use_database(spark, name)
    try:
        sinks.create_table(_altered(facts), "facts")
        sinks.create_table(facts, "facts")
        return stage(comparable(spark.table(f"{name}.facts")))
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql(f"DROP DATABASE {name} CASCADE")


def _write_packed_csv(df: DataFrame, path: str) -> None:
    sinks.write_clean_csv(df, path, "snappy")


def _replace_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two loads of all rows into one path, the first with an altered column, the second
    stays; it takes its place once its rows are counted."""
    facts = stage(learning(spark, sf_dir))
    path = f"{scratch_path(spark, 'replaced')}/facts"
    rows = facts.count()

    def whole(fresh: str) -> bool:
        return scans.scan_clean_csv(spark, fresh).count() == rows

    swap.replace_checked(_altered(facts), path, _write_packed_csv, whole)
    swap.replace_checked(facts, path, _write_packed_csv, whole)
    return comparable(scans.scan_clean_csv(spark, path))


RELOADED = 1995


def _reload_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All years with an altered column, then one year again as it is."""
    facts = stage(learning(spark, sf_dir))
    path = scratch_path(spark, "years")
    layers.load_years(_altered(facts), path)
    layers.load_years(facts.filter(F.year("enrollment_date") == RELOADED), path)
    return comparable(layers.scan_years(spark, path))


def _trend_of_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "years")
    layers.load_years(learning(spark, sf_dir), path)
    return comparable(marts.trend_daily(layers.scan_years(spark, path, RELOADED, RELOADED + 2)))


def _trend_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read, kept and rejected by the pass that loads the rows of the trends, and the rows
    that arrived."""
    typed = layers.typed(ods_learning(spark, sf_dir)).select(*TREND_COLUMNS)
    path = scratch_path(spark, "trend")
    counts = counted_load(typed, marts.trend_valid(), lambda rows: sinks.write_orc(rows, path))
    return scans.scan_orc(spark, path).agg(
        F.lit(counts.input_rows).cast("bigint").alias("input_rows"),
        F.lit(counts.valid_rows).cast("bigint").alias("valid_rows"),
        F.lit(counts.rejected_rows).cast("bigint").alias("rejected_rows"),
        F.count("*").alias("arrived_rows"),
    )


TREND_COLUMNS = [
    *marts.TREND_REQUIRED, "average_session_duration_min", "progress_percentage", "quiz_score_avg"
]


LAYERS: dict[str, Query] = {
    "dwd_typed": _typed(lambda typed: typed),
    "dws_student_stat": _facts(layers.student_stat),
    "dws_course_stat": _facts(lambda f: _rounded(layers.course_stat(gathered(f, "course_id")))),
    "dws_student_feature": _facts(lambda f: _rounded(layers.student_feature(f))),
    "dim_student": _facts(layers.student_dimension),
    "dim_course": _facts(layers.course_dimension),
    "conform_columns": _facts(_conform_columns),
    "conform_decimals": _typed(_conformed),
    "conform_overflow": _facts(lambda f: gates.overflow_counts(f, OVERFLOW_TARGET)),
    "key_violations": _facts(
        lambda f: gates.key_violations(layers.student_dimension(f), ["student_id"])
    ),
    "row_quality_counts": _typed(
        lambda typed: gates.quality_counts(typed, marts.trend_valid())
    ),
    "reconcile_counts": _reconciled,
    **{f"sync_{table}": _synced(table) for table in schema.TARGETS},
    "sync_tables": _sync_tables,
    "typed_reload_year": _reload_year,
    "trend_daily_years": _trend_of_years,
    "trend_load_counts": _trend_load_counts,
    "managed_table": _managed_table,
    "replace_path": _replace_path,
}


# --------------------------------------------------------------------------
# Files
# --------------------------------------------------------------------------
def _scan_raw_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_file(spark, sf_dir)
    path = scratch_path(spark, "raw-csv")
    sinks.write_clean_csv(raw, path, "gzip")
    return scans.scan_raw_csv(spark, path, raw.columns)


def _scan_clean_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "clean-csv")
    sinks.write_clean_csv(learning(spark, sf_dir), path, "gzip")
    return comparable(scans.scan_clean_csv(spark, path))


def _ods_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text bound by position, with bad values, quotes, commas and outer blanks in it, then
    typed: the load of the first two layers."""
    text = ods_learning(spark, sf_dir)
    path = scratch_path(spark, "ods")
    _write_packed_csv(text.toDF(*[f"c{i}" for i in range(len(text.columns))]), path)
    return comparable(layers.typed(scans.scan_positional(spark, path)))


def _scan_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orc")
    sinks.write_orc(learning(spark, sf_dir), path)
    return comparable(scans.scan_orc(spark, path))


def _read_back(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    return (
        spark.read.schema(df.schema)
        .options(
            header=True,
            escape='"',
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
        .csv(path)
    )


def _export_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warning details with quotes, commas and outer blanks in the course names."""
    details = warnings.warning_details(
        warnings.scored_enrolments(learning(spark, sf_dir))
    ).withColumn("course_name", F.concat(F.lit('  "'), "course_name", F.lit('", x ')))
    path = scratch_path(spark, "export")
    sinks.export_csv(details, path)
    return _read_back(spark, details, path)


def _exported(dataset: str) -> Query:
    """A dataset of the report, as read back from the export."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        facts = stage(learning(spark, sf_dir).select(*overview.REPORT_COLUMNS))
        df = overview.report_datasets(facts)[dataset]
        paths = sinks.export_bundle({dataset: df}, scratch_path(spark, "bundle"))
        return _read_back(spark, df, paths[dataset])

    return run


def _export_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seven datasets in one call, and what is read back of each."""
    facts = stage(learning(spark, sf_dir).select(*overview.REPORT_COLUMNS))
    datasets = overview.report_datasets(facts)
    paths = sinks.export_bundle(datasets, scratch_path(spark, "bundle"))
    return _all_summed({n: _read_back(spark, datasets[n], path) for n, path in paths.items()})


FILES: dict[str, Query] = {
    "export_bundle": _export_bundle,
    "scan_raw_csv": _scan_raw_csv,
    "scan_clean_csv": _scan_clean_csv,
    "ods_load": _ods_load,
    "scan_orc": _scan_orc,
    "export_csv": _export_csv,
    "export_overview_metrics": _exported("overview_metrics"),
    "export_weekly": _exported("weekly_learning_statistics"),
    "export_ranking": _exported("course_enrollment_ranking"),
    "export_warning_levels": _exported("warning_level_summary"),
    "export_course_risk": _exported("course_risk_summary"),
    "export_education_risk": _exported("education_risk_summary"),
    "export_warning_detail": _exported("student_warning_detail"),
}


# --------------------------------------------------------------------------
# Marts
# --------------------------------------------------------------------------
MARTS: dict[str, Query] = {
    "course_score": _facts(marts.course_score),
    "course_core": _facts(marts.course_core),
    "student_core": _facts(marts.student_core),
    "resource_core": _facts(marts.resource_core),
    "rank_enrollment": _facts(marts.rank_enrollment),
    "rank_enrollment_load": _facts(
        lambda f: gates.require_rows(stage(marts.rank_enrollment(f)), "enrollment ranking")
    ),
    "rank_enrollment_scaled": _facts(marts.rank_enrollment_scaled),
    "trend_daily": _facts(marts.trend_daily),
    "trend_weekly": _facts(marts.trend_weekly),
    "trend_weekly_iso": _facts(marts.trend_weekly_iso),
    "trend_latest": _facts(
        lambda f: selecting.latest(marts.trend_weekly(f), 24, "stat_year", "stat_week")
    ),
    "trend_week_spread": _facts(
        lambda f: overview.week_spread(marts.trend_weekly(f))
    ),
    "trend_latest_days": _facts(lambda f: overview.latest_days(marts.trend_weekly(f))),
    "top_resources": _facts(
        lambda f: selecting.top(
            marts.resource_summary(f), 20, "access_volume", "resource_id"
        )
    ),
}


# --------------------------------------------------------------------------
# Risk, benchmark, profiles
# --------------------------------------------------------------------------
def _profile_leaves(facts: DataFrame) -> DataFrame:
    scored = warnings.scored_enrolments(facts)
    nested = profiles.student_profile(scored, profiles.student_table(facts))
    return nested.select(
        "student_id",
        F.col("basic.education_level").alias("education_level"),
        F.col("basic.device_type").alias("device_type"),
        F.col("feature.course_count").alias("course_count"),
        F.col("feature.completion_rate").alias("completion_rate"),
        F.round("feature.avg_quiz_score", 6).alias("avg_quiz_score"),
        F.col("course.course_id").alias("course_id"),
        F.col("course.total_study_time_hours").alias("total_study_time_hours"),
        F.col("warning.warning_level").alias("warning_level"),
        F.col("warning.risk_sum").alias("risk_sum"),
    )


def _nested_profile(facts: DataFrame) -> DataFrame:
    """The nested profile of every student, its courses written out as one text."""
    nested = profiles.nested_profile(warnings.scored_enrolments(facts), profiles.student_table(facts))
    course = F.transform(
        "courses",
        lambda c: F.concat_ws(
            "|",
            c["enrollment_date"].cast("string"),
            c["course_id"],
            c["course_name"],
            c["warning"]["warning_level"],
            c["warning"]["risk_sum"].cast("string"),
            c["feature"]["progress_percentage"].cast("int").cast("string"),
        ),
    )
    return nested.select(
        "student_id",
        F.col("basic.education_level").alias("education_level"),
        F.col("feature.course_count").alias("course_count"),
        F.col("feature.completion_rate").alias("completion_rate"),
        "warning.*",
        F.size("courses").alias("courses_listed"),
        F.array_join(F.array_sort(course), ";").alias("courses_sorted"),
        F.array_join(
            F.transform("courses", lambda c: F.concat(c["enrollment_date"].cast("string"), F.lit(" "), c["course_id"])), ";"
        ).alias("courses_in_order"),
    )


NESTED_COLUMNS = [
    *schema.KEY,
    *schema.STUDENT_ATTRIBUTES,
    "course_name",
    "category",
    "course_level",
    "enrollment_date",
    "assignments_missed",
    "completed",
    "time_spent_hours",
    "average_session_duration_min",
    "login_frequency",
    "video_completion_rate",
    "progress_percentage",
    "assignment_submission_rate",
    "quiz_score_avg",
    "project_grade",
    "discussion_participation",
    "peer_interaction_score",
    "app_usage_percentage",
    "satisfaction_rating",
    "days_since_last_login",
]


def _teacher_profile(facts: DataFrame) -> DataFrame:
    course_risk = warnings.course_risk_summary(warnings.scored_enrolments(facts))
    return profiles.teacher_profile(profiles.teacher_detail(facts), course_risk)


def _course_merged(facts: DataFrame) -> DataFrame:
    course_risk = warnings.course_risk_summary(warnings.scored_enrolments(facts))
    return warnings.course_merged(marts.rank_enrollment(facts), course_risk)


def _share(scored: DataFrame) -> DataFrame:
    return filter_share(scored, is_level(schema.HIGH_MARK))


def course_type() -> Column:
    """A type for each course by its size, and none for some: the types come from outside."""
    types = F.array(*[F.lit(t) for t in schema.COURSE_TYPES])
    return F.try_element_at(types, (F.col("student_count") % 5 + 1).cast("int"))


PEER_COLUMNS = [f"peer_{m}" for m in benchmark.MEASURES]

RISK: dict[str, Query] = {
    "risk_flags": _facts(
        lambda f: add_risk_flags(f).select(
            *schema.KEY,
            "payment_amount",
            "login_risk",
            "assignment_risk",
            "progress_risk",
            "score_risk",
        )
    ),
    "risk_level": _scored(lambda s: s.select(*RISK_KEY, "payment_amount")),
    "risk_detail": _scored(warnings.warning_details),
    "warning_distribution": _scored(warnings.warning_distribution),
    "course_risk_summary": _scored(lambda s: warnings.course_risk_summary(gathered(s, "course_id"))),
    "education_risk_summary": _scored(warnings.education_risk_summary),
    "overview_metrics": _facts(overview.overview_metrics),
    "summary_totals": _facts(
        lambda f: _rounded(
            sum_columns(
                marts.trend_weekly(f),
                {
                    "learning_times": "learning_times",
                    "total_study_time_hours": "total_study_time_hours",
                },
            )
        )
    ),
    "platform_average": _course_risk(lambda c: _rounded(warnings.platform_average(c))),
    "filter_share": _scored(_share),
    "course_weak_items": _course_risk(warnings.course_weak_items),
    "course_merged": _stored(_course_merged),
    "teacher_profile": _stored(_teacher_profile),
    "teacher_rank": _course_risk(warnings.course_positions),
    "student_profile": _stored(_profile_leaves),
    "student_profile_nested": _stored_columns(NESTED_COLUMNS, _nested_profile),
    "student_benchmark": _profiles(profiles.student_benchmark),
    "weakest_measure": _profiles(
        lambda p: benchmark.add_weakest_measure(p).select(
            *schema.KEY, "value_time", "weakest_measure"
        )
    ),
    "advice_lookup": _profiles(
        lambda p: add_measure_advice(benchmark.add_weakest_measure(p)).select(
            *schema.KEY, "warning_level", "weakest_measure", "advice"
        )
    ),
    "course_advice": _course_risk(
        lambda c: c.select(
            "course_id", course_type().alias("course_type"), course_advice(course_type()).alias("advice")
        )
    ),
    "strong_peer": _course_risk(
        lambda c: benchmark.add_strong_peer(
            c.select(
                "course_id",
                *[F.col(m).alias(b) for b, m in profiles.BENCHMARKS.items()],
            )
        ).select("course_id", *PEER_COLUMNS)
    ),
    "persona_label": _profiles(
        lambda p: benchmark.add_persona(p).select(
            *schema.KEY, "warning_level", "value_time", "persona_label"
        )
    ),
    "persona_share": _profiles(warnings.persona_share),
    "student_report": _profiles(profiles.student_report),
}


# --------------------------------------------------------------------------
# Filters, sorts, pages
# --------------------------------------------------------------------------
def _filter_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrolments of the chosen students: those whose account is overdrawn."""
    chosen = (
        scan_table(spark, sf_dir, "customer")
        .filter("c_acctbal < 0")
        .select(F.concat(F.lit("S"), F.col("c_custkey").cast("string")).alias("student_id"))
    )
    scored = warnings.scored_enrolments(learning(spark, sf_dir))
    return selecting.filter_selected(scored, chosen, "student_id").select(*RISK_KEY)


PAGE_ORDER = ["student_id", "course_id", "enrollment_date", "payment_amount"]
# Clamped to the last page, however long the list.
LAST_PAGE = sys.maxsize


def _stored_pages(scored: DataFrame) -> DataFrame:
    """Two pages of one sorted list."""
    pages = selecting.StoredPages(scored.select(*PAGE_ORDER), PAGE_ORDER)
    return pages.page(3, 20).unionByName(pages.page(LAST_PAGE, 20))


def _student_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One student's enrolments out of a table sorted for lookups."""
    path = scratch_path(spark, "lookup")
    scored = warnings.scored_enrolments(learning(spark, sf_dir))
    sinks.write_lookup(scored.select(*RISK_KEY), path, "student_id", "course_id")
    return scans.scan_orc(spark, path).filter("student_id = 'S7'")


SELECTING: dict[str, Query] = {
    "filter_equals": _scored(
        lambda s: selecting.filter_equals(
            s, education_level="BUILDING", warning_level=schema.HIGH, course_id=None
        ).select(*RISK_KEY, "education_level")
    ),
    "filter_search": _scored(
        lambda s: selecting.filter_search(
            s, student=" 1 ", course="7", level=schema.MID
        ).select(*RISK_KEY, "course_name")
    ),
    "filter_selected": _filter_selected,
    "export_high_risk": _scored(
        lambda s: s.filter(is_level(schema.HIGH_MARK)).select(*RISK_KEY)
    ),
    "export_student": _scored(
        lambda s: selecting.filter_equals(s, student_id="S7").select(*RISK_KEY)
    ),
    "rank_by_measure": _course_risk(
        lambda c: selecting.rank_by_measure(c, "high_risk_count", "course_id").select(
            "course_id", "high_risk_count", "position"
        )
    ),
    "pinned_sort": _course_risk(
        lambda c: selecting.pinned_first(
            c, "course_id", "C7", "avg_quiz_score"
        ).select("course_id", "avg_quiz_score", "position")
    ),
    "page_rows": _scored(
        lambda s: selecting.page_rows(
            s.filter(is_level(schema.HIGH_MARK)).select(*PAGE_ORDER), 3, 20, PAGE_ORDER
        )
    ),
    "page_rows_deep": _scored(
        lambda s: selecting.page_rows(s.select(*PAGE_ORDER), LAST_PAGE, 20, PAGE_ORDER)
    ),
    "page_rows_stored": _scored(_stored_pages),
    "student_lookup": _student_lookup,
    "rate_to_percent": _facts(
        lambda f: f.select(
            *schema.KEY,
            rate_to_percent(F.col("assignment_submission_rate") / 50).alias("percent"),
        )
    ),
    "first_text": _raw(
        lambda r: _tokens(r).select(
            *LINE_ORDER,
            first_text(
                F.col("City"), F.col("Gender"), default=schema.UNCATEGORISED
            ).alias("label"),
        )
    ),
}


def all_queries() -> dict[str, Query]:
    return {**MARTS, **LAYERS, **CLEANING, **RISK, **SELECTING, **FILES}
