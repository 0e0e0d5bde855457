"""What stays on disk while a query is built: shuffles end with their step, whole rows are
shuffled in parts, whole tables as text are compressed."""

import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from lectern import staging
from lectern.catalog import queries
from lectern.operators import nesting
from lectern.plans import cleaning as plans
from lectern.sources.views import learning


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffled_bytes(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = blocks.getAllFiles().toList()
    return sum(f.length() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_"))


def bytes_left(spark, build):
    """Shuffle bytes that ``build`` leaves on disk, with all joins by shuffles."""
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        held = shuffled_bytes(spark)
        result = build()
        for _ in range(50):
            left = shuffled_bytes(spark) - held
            if left < 50_000:
                break
            time.sleep(0.1)
    finally:
        spark.conf.set(threshold, before)
    assert result is not None
    return left


@pytest.fixture
def keyed(spark):
    key = F.when(F.col("id") % 11 != 0, F.concat(F.lit("S"), (F.col("id") % 300).cast("string")))
    return spark.range(0, 4000, 1, 5).select(key.alias("s"), (F.col("id") % 7).alias("c"), "id", F.lit("x").alias("t"))


def test_an_order_meets_its_customer_before_its_lines(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(learning(spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    below = text[text.index("hashpartitioning(o_custkey") :]
    assert "l_orderkey" not in below.split("FileScan")[1]


def test_rows_stored_in_parts_give_what_one_step_gives(spark, keyed, monkeypatch):
    monkeypatch.setattr(staging, "PART_BYTES", 1)

    def last(df):
        return queries.cleaning.keep_last(df, ["s", "c"], ["id"])

    parts = []
    found = staging.stage_in_parts(keyed, ["s", "c"], lambda part: parts.append(part.count()) or last(part))
    assert sorted(map(str, found.collect())) == sorted(map(str, last(keyed).collect()))
    assert len(parts) == staging.PARTS and sum(parts) == 4000 and max(parts) < 2000
    monkeypatch.setattr(staging, "PART_BYTES", 1 << 40)
    assert staging.stage_in_parts(keyed, ["s", "c"], last).exceptAll(found).isEmpty()
    one = staging.stage_in_parts(keyed.limit(1), ["s", "c"], last)
    assert one.schema == staging.stage(keyed).schema and one.count() == 1
    assert staging.stage_in_parts(keyed.limit(0), ["s", "c"], last).count() == 0


def test_the_cleaning_shuffles_whole_rows_in_parts(spark, sf_dir, monkeypatch):
    calls = []
    monkeypatch.setattr(staging, "PART_BYTES", 1000)
    monkeypatch.setattr(plans, "stage", lambda df, stage=plans.stage: calls.append(plan(df)) or stage(df))
    assert bytes_left(spark, lambda: driver.queries()["clean_enrollments"](spark, sf_dir)) < 50_000
    assert len(calls) == staging.PARTS and all("_folder" in c for c in calls)


def test_the_load_report_shuffles_whole_rows_in_parts(spark, sf_dir, monkeypatch):
    """Also when some of the parts have no rows."""
    calls = []
    monkeypatch.setattr(staging, "PART_BYTES", 1)
    monkeypatch.setattr(plans, "stage", lambda df, stage=plans.stage: calls.append(plan(df)) or stage(df))
    raw = queries.raw_file(spark, sf_dir).filter("l_orderkey in (1, 2)").limit(3)
    raw = staging.stage(raw.unionByName(raw))
    _, report = plans.clean_and_report(raw, queries.LINE_ORDER)
    assert len(calls) == staging.PARTS and all("_folder" in c and c.count("CollectMetrics") == 3 for c in calls)
    assert sorted(report.collect()) == sorted(plans.cleaning_report(raw, queries.LINE_ORDER).collect())
    _, empty = plans.clean_and_report(raw.limit(0), queries.LINE_ORDER)
    assert sorted(empty.collect()) == sorted(plans.cleaning_report(raw.limit(0), queries.LINE_ORDER).collect())


def test_replaced_loads_leave_no_shuffle(spark, sf_dir):
    assert bytes_left(spark, lambda: driver.queries()["replace_path"](spark, sf_dir)) < 50_000


def test_the_sync_shuffles_whole_rows_in_parts(spark, sf_dir, monkeypatch):
    calls = []
    monkeypatch.setattr(staging, "PART_BYTES", 1000)
    monkeypatch.setattr(queries, "stage", lambda df, stage=queries.stage: calls.append(plan(df)) or stage(df))
    assert bytes_left(spark, lambda: driver.queries()["sync_tables"](spark, sf_dir)) < 50_000
    assert len(calls) == staging.PARTS and all("_folder" in c for c in calls)


def test_a_round_of_runs_holds_no_other_round(spark, keyed):
    nested = nesting.nest(keyed, ["s"], ["id"], F.struct("c", "id"), "items")
    text = plan(nested)
    assert text.count("Exchange hashpartitioning") == 1 and "rangepartitioning" not in text
    assert sum(len(r["items"]) for r in nested.collect()) == 4000


@pytest.mark.parametrize("name", ["scan_raw_csv", "scan_clean_csv"])
def test_text_of_whole_tables_is_compressed(spark, sf_dir, name):
    files = driver.queries()[name](spark, sf_dir).inputFiles()
    assert files and all(f.endswith(".csv.gz") for f in files)


def test_an_export_stores_the_columns_of_the_report_only(spark, sf_dir, monkeypatch):
    widths = []
    monkeypatch.setattr(queries, "stage", lambda df, stage=queries.stage: widths.append(len(df.columns)) or stage(df))
    assert bytes_left(spark, lambda: driver.queries()["export_warning_detail"](spark, sf_dir)) < 50_000
    assert widths == [len(queries.overview.REPORT_COLUMNS)]


def test_years_loaded_leave_no_shuffle(spark, sf_dir):
    assert bytes_left(spark, lambda: driver.queries()["typed_reload_year"](spark, sf_dir)) < 50_000
