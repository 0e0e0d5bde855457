"""Loads that count what they read, and replacements that can fail."""

import pytest
from pyspark.sql import functions as F

from lectern import schema
from lectern.catalog.queries import LINE_ORDER, RULES, raw_file
from lectern.operators.counting import counted_load
from lectern.plans import cleaning, layers, sync
from lectern.sinks import files as sinks
from lectern.sinks import swap
from lectern.sources.views import learning


def test_counts_come_from_the_pass_that_writes(spark, tmp_path):
    """An accumulator behind the source sees each row once."""
    path, source = str(tmp_path / "out"), str(tmp_path / "in")
    spark.range(1000).select(F.when(F.col("id") % 10 != 0, F.col("id")).alias("v")).write.parquet(source)
    written = []
    counts = counted_load(
        spark.read.parquet(source), F.col("v") > 500, lambda rows: written.append(rows) or rows.write.parquet(path)
    )
    assert (counts.input_rows, counts.valid_rows, counts.rejected_rows) == (1000, 450, 550)
    assert spark.read.parquet(path).count() == 450
    text = written[0]._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "CollectMetrics" in text


def test_counts_of_no_rows(spark, tmp_path):
    counts = counted_load(spark.range(0), F.col("id") > 0, lambda rows: rows.write.parquet(str(tmp_path / "x")))
    assert (counts.input_rows, counts.valid_rows, counts.rejected_rows) == (0, 0, 0)


def test_cleaning_reports_what_its_own_load_removed(spark, sf_dir, monkeypatch):
    raw = raw_file(spark, sf_dir)
    plans = []
    monkeypatch.setattr(cleaning, "stage", lambda df, stage=cleaning.stage: plans.append(df._jdf.queryExecution().executedPlan().toString()) or stage(df))
    cleaned, report = cleaning.clean_and_report(raw, LINE_ORDER, RULES)
    assert len(plans) == 1 and plans[0].count("l_extendedprice") and plans[0].count("CollectMetrics") == 3
    assert sorted(report.collect()) == sorted(cleaning.cleaning_report(raw, LINE_ORDER, RULES).collect())
    other = cleaning.clean_enrollments(raw, LINE_ORDER, RULES)
    assert cleaned.exceptAll(other).isEmpty() and other.exceptAll(cleaned).isEmpty()


def rows_of(spark, path):
    return sorted(r["id"] for r in spark.read.parquet(path).collect())


def write(df, path):
    df.write.parquet(path)


def test_replace_keeps_the_old_rows_if_the_check_fails(spark, tmp_path):
    path = f"{tmp_path}/folder/table"
    swap.replace_checked(spark.range(3), path, write, lambda fresh: True)
    with pytest.raises(ValueError, match="the old ones stay"):
        swap.replace_checked(spark.range(5), path, write, lambda fresh: spark.read.parquet(fresh).count() == 4)
    assert rows_of(spark, path) == [0, 1, 2]

    def broken(df, place):
        write(df, place)
        raise RuntimeError("half way")

    with pytest.raises(RuntimeError):
        swap.replace_checked(spark.range(5), path, broken, lambda fresh: True)
    assert rows_of(spark, path) == [0, 1, 2]
    swap.replace_checked(spark.range(5), path, write, lambda fresh: spark.read.parquet(fresh).count() == 5)
    assert rows_of(spark, path) == [0, 1, 2, 3, 4]
    assert [p.name for p in (tmp_path / "folder").iterdir() if not p.name.endswith(".crc")] == ["table"]


def test_a_swap_that_ended_between_its_renames_is_put_right(spark, tmp_path):
    path = f"{tmp_path}/table"
    write(spark.range(2), f"{tmp_path}/_table.replaced")
    swap.recover(spark, path)
    assert rows_of(spark, path) == [0, 1]
    swap.recover(spark, path)
    swap.replace_checked(spark.range(1), path, write, lambda fresh: True)
    assert rows_of(spark, path) == [0]


def test_sync_keeps_the_old_rows_if_the_count_differs(spark, sf_dir, tmp_path):
    path, folder = str(tmp_path / "course_stat"), str(tmp_path / "target")
    served = layers.served_tables(learning(spark, sf_dir))["course_stat"]
    sinks.write_orc(served, path)
    task, target = sync.SyncTask(path, "course_stat"), sync.folder_target(spark, folder)
    sync.sync_table(spark, task, target)
    before = sorted(map(str, spark.read.parquet(f"{folder}/course_stat").collect()))
    short = sync.SyncTarget(target.write, lambda table: target.count(table) - 1, target.settle)
    with pytest.raises(ValueError, match="200 rows read, 199 rows in the target"):
        sync.sync_table(spark, task, short)
    assert sorted(map(str, spark.read.parquet(f"{folder}/course_stat").collect())) == before
    assert sync.sync_table(spark, task, target).target_rows == 200


def test_one_year_is_loaded_again_alone(spark, facts, tmp_path):
    import datetime

    path = str(tmp_path / "years")
    days = [datetime.date(2023, 5, 1), datetime.date(2024, 5, 1), None]
    layers.load_years(facts(["student_id", "enrollment_date"], [("S1", d) for d in days]), path)
    layers.load_years(facts(["student_id", "enrollment_date"], [("S2", days[1]), ("S3", days[1])]), path)
    found = sorted((str(r["enrollment_year"]), r["student_id"]) for r in layers.scan_years(spark, path).collect())
    assert found == [("2023", "S1"), ("2024", "S2"), ("2024", "S3"), ("None", "S1")]
    assert layers.scan_years(spark, path, 2024).schema.names == [*schema.ENROLMENT_NAMES, "enrollment_year"]


def test_distinct_counts_with_null_keys_and_values(spark):
    from lectern.operators.aggregate import summarise_distinct

    rows = [("a", 1, "x"), ("a", 1, "y"), ("a", None, "x"), (None, 2, None), ("b", None, None)]
    df = spark.createDataFrame(rows, "k string, u int, v string")
    out = summarise_distinct(df, ["k"], {"us": "u", "vs": "v"}, {"n": F.count("*")})
    assert sorted(map(tuple, out.collect()), key=str) == [("a", 3, 1, 2), ("b", 1, 0, 0), (None, 1, 1, 0)]
    assert tuple(summarise_distinct(df, [], {"us": "u"}, {"n": F.count("*")}).first()) == (5, 2)
    assert tuple(summarise_distinct(df.limit(0), [], {"us": "u"}, {"n": F.count("*")}).first()) == (0, 0)
