"""What the plans must look like at any size."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from lectern.operators import cleaning
from lectern.plans import layers, marts, profiles, warnings
from lectern.sinks.files import write_orc
from lectern.sources.files import scan_orc
from lectern.sources.views import learning

PACKAGE = Path(layers.__file__).resolve().parents[1]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "facts")
    write_orc(learning(spark, sf_dir), path)
    return scan_orc(spark, path)


def test_scan_reads_only_the_columns_and_filters_it_needs(stored):
    text = plan(marts.course_score(stored))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "course_id", "course_name", "quiz_score_avg", "project_grade"
    }
    assert "IsNotNull(quiz_score_avg)" in text
    text = plan(warnings.scored_enrolments(stored).filter("student_id = 'S7'"))
    assert "EqualTo(student_id,S7)" in text


def test_first_pass_of_labelled_summaries_is_a_hash_aggregate(stored):
    text = plan(layers.course_stat(stored))
    assert "HashAggregate" in text[text.rindex("Exchange") :]
    assert "SortAggregate" not in text[text.rindex("Exchange") :]


def test_marts_aggregate_before_they_shuffle(stored):
    for mart in (marts.course_core, marts.student_core, marts.trend_daily, layers.student_feature):
        text = plan(mart(stored))
        below = text[text.rindex("Exchange") :]
        assert "HashAggregate" in below and "SinglePartition" not in text


@pytest.mark.parametrize("name", ["course_weak_items", "student_report", "persona_share", "teacher_profile", "clean_enrollments"])
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    text = plan(driver.queries()[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert operator not in text


def test_no_local_checkpoint_no_udf_no_collect_list_in_the_package():
    banned = ("localCheckpoint", "udf(", "collect_list", "collect_set", "crossJoin", ".rdd.map", "toPandas")
    for path in PACKAGE.rglob("*.py"):
        # The operators for training data have rules and tests of their own.
        if "llm" in path.parts:
            continue
        text = path.read_text(encoding="utf-8")
        found = [word for word in banned if word in text]
        # Runs of a bounded number of rows, see test_nesting.
        assert found == (["collect_list"] if path.name == "nesting.py" else []), path


def test_hot_course_lookup_survives_a_third_of_all_rows(spark, monkeypatch):
    """One course with a third of all rows: same result with and without the split."""
    from lectern.operators import joining

    rows = spark.range(3000).select(
        F.concat(F.lit("S"), (F.col("id") % 500).cast("string")).alias("student_id"),
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("C"), (F.col("id") % 97).cast("string"))).alias("course_id"),
        F.lit("name").alias("course_name"),
        (F.col("id") % 10).cast("int").alias("login_frequency"),
        (F.col("id") % 100).cast("double").alias("quiz_score_avg"),
        (F.col("id") % 2).cast("int").alias("completed"),
    )
    from lectern import schema

    facts = rows.select(
        *[F.col(n) if n in rows.columns else F.lit(None).cast(k).alias(n) for n, k in schema.ENROLMENT_COLUMNS]
    )
    scored = warnings.scored_enrolments(facts)
    students, course_risk = profiles.student_table(facts), warnings.stored_course_risk(scored)

    def run(parts):
        monkeypatch.setattr(joining, "HEAVY_PARTS", parts)
        out = profiles.student_benchmark(profiles.benchmarked(scored, students, course_risk))
        return sorted(map(str, out.collect()))

    # At 1/1 no key is heavy; at 1/10 the hot one is; at 1/1000 most are.
    assert run(1) == run(10) == run(1000)


@pytest.mark.parametrize("name", ["student_report", "persona_share", "student_profile", "course_merged", "teacher_profile", "export_weekly", "sync_course_stat"])
def test_the_view_is_joined_once(spark, sf_dir, name, monkeypatch):
    """What is staged first is the only thing that reads the line items."""
    from lectern.catalog import queries

    reads = []
    monkeypatch.setattr(queries, "stage", lambda df, stage=queries.stage: reads.append(plan(df).count("l_orderkey")) or stage(df))
    text = plan(driver.queries()[name](spark, sf_dir))
    assert len([n for n in reads if n]) == 1 and "l_orderkey" not in text


@pytest.mark.parametrize("name", ["student_core", "trend_daily", "trend_weekly", "trend_weekly_iso", "overview_metrics"])
def test_distinct_counts_do_not_repeat_the_rows(spark, sf_dir, name):
    text = plan(driver.queries()[name](spark, sf_dir))
    assert "Expand" not in text and "SortAggregate" not in text


def test_trend_opens_only_the_years_it_needs(spark, stored, tmp_path):
    path = str(tmp_path / "years")
    layers.load_years(stored, path)
    text = plan(layers.scan_years(spark, path, 1995).groupBy("course_id").count())
    assert "PartitionFilters: [isnotnull(enrollment_year" in text and "enrollment_year#" in text.split("PartitionFilters")[1][:80]
    read = layers.scan_years(spark, path, 1995)
    assert {f.split("enrollment_year=")[1][:4] for f in read.inputFiles()} >= {"1995"}
    days = marts.trend_daily(layers.scan_years(spark, path, 1995)).collect()
    assert days == [r for r in marts.trend_daily(stored).collect() if r["stat_date"].year == 1995]


def scanned_rows(df):
    """Rows that the file scans of a finished plan put out."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    found, todo = 0, [node]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan"):
            found += node.metrics().get("numOutputRows").get().value()
        inner = [node.executedPlan()] if node.nodeName() == "AdaptiveSparkPlan" else []
        children = node.children()
        todo += inner + [children.apply(i) for i in range(children.size())]
    return found


def test_lookup_of_one_key_reads_few_rows(spark, tmp_path):
    from lectern.sinks.files import write_lookup

    path = str(tmp_path / "lookup")
    df = spark.range(400_000).select(
        F.concat(F.lit("S"), (F.col("id") * 7919 % 50_000).cast("string")).alias("student_id"), (F.col("id") % 97).alias("course_id")
    )
    write_lookup(df, path, "student_id", "course_id")
    one = spark.read.orc(path).filter("student_id = 'S4711'")
    assert one.count() == 8
    assert 8 <= scanned_rows(one) <= 40_000
    assert scanned_rows(spark.read.orc(path).filter("student_id = 'none'")) <= 40_000


def test_pages_of_a_stored_list_are_sorted_once(spark, monkeypatch):
    from lectern.operators import numbering, selecting

    sorts = []
    monkeypatch.setattr(numbering, "pin_order", lambda df, pin=numbering.pin_order: sorts.append(1) or pin(df))
    df = spark.range(100_000).select((F.col("id") * 7919 % 100_003).alias("v"))
    pages = selecting.StoredPages(df, ["v"])
    ordered = sorted(r["v"] for r in df.collect())
    for page in (1, 3, 777, 10**9):
        first = (min(page, 5000) - 1) * 20
        found = pages.page(page, 20)
        assert [r["v"] for r in found.collect()] == ordered[first : first + 20]
        assert "PushedFilters: [IsNotNull(_position), GreaterThanOrEqual(_position" in plan(found)
        assert scanned_rows(pages.page(page, 20)) < 30_000
    assert len(sorts) == 1
    empty = selecting.StoredPages(df.limit(0), ["v"])
    assert empty.page(9, 20).collect() == []


def test_report_does_not_sort_all_rows(spark, sf_dir):
    assert "SortAggregate" not in plan(driver.queries()["clean_report"](spark, sf_dir))


def test_duplicates_of_one_key_collapse_to_one_row(spark):
    df = spark.range(5000).select(F.lit("S1").alias("s"), (F.col("id") % 2).cast("string").alias("c"), "id")
    out = cleaning.keep_last(df, ["s", "c"], ["id"]).collect()
    assert sorted(r["id"] for r in out) == [4998, 4999]


def test_ranking_reads_the_facts_once(stored):
    ranked = marts.rank_enrollment(stored)
    ranked.collect()
    final = plan(ranked).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_loads_of_one_table_store_and_shuffle_only_its_columns(spark, sf_dir, monkeypatch):
    from lectern.catalog import queries

    widths = []

    def stage(df):
        widths.append(len(df.columns))
        return df

    monkeypatch.setattr(queries, "stage", stage)
    found = queries.all_queries()
    found["sync_course_stat"](spark, sf_dir)
    assert widths == []
    found["student_profile_nested"](spark, sf_dir)
    found["export_bundle"](spark, sf_dir)
    found["clean_median_fill"](spark, sf_dir)
    assert len(widths) == 3 and widths[2] == 4 and max(widths) < 40


def test_numbered_rows_are_stored_in_columns_not_as_a_checkpoint(spark):
    from pyspark.sql import functions as F

    from lectern.operators.numbering import number_rows

    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("v"), F.lit("x" * 50).alias("t"))
    numbered = number_rows(df, F.col("v"))
    assert [tuple(r)[::2] for r in numbered.orderBy("v").collect()] == [(v, v + 1) for v in range(5000)]
    assert numbered.inputFiles() and all(f.endswith(".parquet") for f in numbered.inputFiles())


def test_loads_of_whole_tables_as_text_are_compressed(spark, sf_dir, monkeypatch):
    from lectern.catalog import queries

    found, paths = queries.all_queries(), []
    for query in ("replace_path", "ods_load"):
        paths.append(found[query](spark, sf_dir).inputFiles())
    assert all(files and all(f.endswith(".csv.snappy") for f in files) for files in paths)


@pytest.mark.parametrize("name", ["dws_course_stat", "conform_columns", "course_risk_summary"])
def test_a_task_of_the_course_summary_holds_its_share_of_the_courses(spark, sf_dir, name):
    text = plan(driver.queries()[name](spark, sf_dir))
    first = text.index("REBALANCE_PARTITIONS_BY_COL")
    assert text.rindex("Aggregate") < first and text[:first].count("Exchange hashpartitioning(course_id") == 2


def test_gathered_rows_of_a_key_are_combined_to_one(spark):
    from lectern.operators.aggregate import gathered, summarise_labelled

    key = F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 50 != 1, F.concat(F.lit("C"), F.col("id") % 97))
    rows = spark.range(6000).select(key.alias("k"), F.lit("name").alias("label"), F.col("id").alias("v")).repartition(9)
    summaries = [
        summarise_labelled(df, "k", ["label"], "n", sums={"s": "v"}, means={"m": "v"}) for df in (gathered(rows, "k"), rows)
    ]
    assert gathered(rows, "k").columns == rows.columns
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found, expected = (sorted(map(str, df.collect())) for df in summaries)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert found == expected and len(found) == 99
    node, combined = summaries[0]._jdf.queryExecution().executedPlan(), []
    while node.children().size():
        if node.nodeName() == "HashAggregate":
            combined.append(node.metrics().get("numOutputRows").get().value())
        node = node.children().head()
    assert combined[-1] == 99
