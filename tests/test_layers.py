import datetime

import pytest
from pyspark.sql import functions as F

from lectern import schema
from lectern.operators import gates
from lectern.plans import layers, sync
from lectern.sinks import files as sinks
from lectern.sources.views import learning


def test_bad_text_becomes_null(spark):
    row = {n: "x" for n in schema.ENROLMENT_NAMES}
    good = {**row, "age": "20.0", "quiz_score_avg": "1e1", "enrollment_date": "2024-01-31", "completed": "1"}
    df = spark.createDataFrame([tuple(row.values()), tuple(good.values())], schema.ODS_SCHEMA)
    bad, fine = layers.typed(df).collect()
    assert (bad["age"], bad["quiz_score_avg"], bad["enrollment_date"]) == (None, None, None)
    assert (fine["age"], fine["quiz_score_avg"], fine["completed"]) == (20, 10.0, 1)
    assert fine["enrollment_date"] == datetime.date(2024, 1, 31)
    assert layers.typed(df).schema == schema.ENROLMENT_SCHEMA


@pytest.mark.parametrize("table", schema.TARGETS)
def test_served_tables_have_every_target_column(facts, table):
    df = facts(["student_id", "course_id"], [("S1", "C1")])
    served = layers.served_tables(df)[table]
    names = [n for n, _ in schema.TARGETS[table]]
    assert gates.conform_columns(served, names, table).columns == names


def test_conform_columns_names_what_is_missing(spark):
    df = spark.createDataFrame([(1, 2)], "b int, a int")
    assert gates.conform_columns(df, ["a", "b"], "t").columns == ["a", "b"]
    with pytest.raises(ValueError, match=r"t: columns \['c'\] are missing"):
        gates.conform_columns(df, ["a", "c"], "t")


def test_conform_types_rounds_and_defaults(spark):
    target = [("x", "decimal(5,2)"), ("n", "int"), ("s", "string")]
    df = spark.createDataFrame([(12.345, 1, "a"), (None, None, None), (123456.789, 2, "b")], "x double, n int, s string")
    out = gates.conform_types(df, target)
    assert [(float(r["x"]), r["n"], r["s"]) for r in out.collect()] == [(12.35, 1, "a"), (0.0, 0, None), (0.0, 2, "b")]
    assert dict(out.dtypes) == dict(target)
    assert gates.conform_types(df, target, nullable=["x"]).filter("x is null").count() == 2
    assert tuple(gates.overflow_counts(df, target).first()) == (1, 0)
    assert tuple(gates.load_counts(df, target, ["s"]).first()) == (3, 1, 1)


def test_key_violations(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, v int")
    assert [tuple(r) for r in gates.key_violations(df, ["k"]).collect()] == [("a", 2)]


def test_require_rows(spark):
    df = spark.range(1)
    assert gates.require_rows(df, "t") is df
    with pytest.raises(ValueError, match="t: no rows"):
        gates.require_rows(df.filter("id < 0"), "t")


def test_reconcile(spark):
    assert tuple(gates.reconcile_counts(spark.range(3), spark.range(3)).first()) == (3, 3, True)
    assert tuple(gates.reconcile_counts(spark.range(3), spark.range(2)).first()) == (3, 2, False)


def test_dimension_keeps_both_values_and_reports_the_key(facts):
    df = facts(["student_id", "age"], [("S1", 20), ("S1", 21), ("S1", 20), ("S2", 30)])
    dim = layers.student_dimension(df)
    assert dim.count() == 3
    assert [r["student_id"] for r in gates.key_violations(dim, ["student_id"]).collect()] == ["S1"]


@pytest.fixture
def served(spark, sf_dir, tmp_path):
    path = str(tmp_path / "course_stat")
    sinks.write_orc(layers.served_tables(learning(spark, sf_dir))["course_stat"], path)
    return path


def test_sync(spark, served, tmp_path):
    target = sync.folder_target(spark, str(tmp_path / "target"))
    task = sync.SyncTask(served, "course_stat")
    first, again = sync.sync_tables(spark, [task, task], target)
    assert first == again == sync.SyncResult("course_stat", 200, 200)
    landed = spark.read.parquet(str(tmp_path / "target" / "course_stat"))
    assert dict(landed.dtypes)["completion_rate"] == "decimal(5,2)"


def test_sync_stops_at_the_first_failure(spark, served, tmp_path):
    wrong = str(tmp_path / "wrong")
    sinks.write_orc(spark.range(3), wrong)
    written = []
    target = sync.SyncTarget(lambda df, table: written.append(table), lambda table: 200)
    tasks = [sync.SyncTask(served, "course_stat"), sync.SyncTask(wrong, "course_info"), sync.SyncTask(served, "course_stat")]
    with pytest.raises(ValueError, match="course_info: columns"):
        sync.sync_tables(spark, tasks, target)
    assert written == ["course_stat"]


def test_sync_gates(spark, served, tmp_path):
    df = spark.read.orc(served)
    cases = {
        "no rows": df.filter("course_id is null"),
        "do not fit": df.withColumn("completion_rate", F.lit(1e6)),
        "lack a required": df.withColumn("course_id", F.lit(None).cast("string")),
        "occur more than once": df.unionByName(df.limit(1)),
    }
    target = sync.folder_target(spark, str(tmp_path / "target"))
    for i, (message, broken) in enumerate(cases.items()):
        path = str(tmp_path / f"broken{i}")
        sinks.write_orc(broken, path)
        with pytest.raises(ValueError, match=message):
            sync.sync_table(spark, sync.SyncTask(path, "course_stat"), target)
    short = sync.SyncTarget(lambda d, t: None, lambda t: 1)
    with pytest.raises(ValueError, match="200 rows read, 1 rows in the target"):
        sync.sync_table(spark, sync.SyncTask(served, "course_stat"), short)
