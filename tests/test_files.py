import glob

import pytest
from pyspark.errors import AnalysisException

from lectern import schema
from lectern.sinks import files as sinks
from lectern.sinks import jdbc as jdbc_sink
from lectern.sources import files as scans
from lectern.sources.jdbc import JdbcTarget, count_options
from lectern.staging import scratch_path, shared_dir, stage


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_raw_scan_reads_missing_tokens_as_null(spark, tmp_path):
    path = write(tmp_path / "raw.csv", 'Student ID,City\n S1 ,"a, b"\nn/a,\nNA,-\n,NULL\n')
    df = scans.scan_raw_csv(spark, path, ["Student ID", "City"])
    assert [tuple(r) for r in df.collect()] == [(" S1 ", "a, b"), (None, None), (None, "-"), (None, None)]


def test_doubled_quotes_and_line_breaks(spark, tmp_path):
    path = write(tmp_path / "quoted.csv", 'a,b\n"say ""hi"", ok","x\ny"\n')
    df = scans.scan_raw_csv(spark, path, ["a", "b"], line_breaks=True)
    assert [tuple(r) for r in df.collect()] == [('say "hi", ok', "x\ny")]


def test_byte_order_mark_is_not_part_of_the_first_value(spark, tmp_path):
    path = write(tmp_path / "bom.csv", "\ufeffstudent_id,age\nS1,20\n")
    df = scans.scan_raw_csv(spark, path, ["student_id", "age"])
    assert [tuple(r) for r in df.collect()] == [("S1", "20")]


def test_positional_scan_ignores_header_names(spark, tmp_path):
    values = ",".join(str(i) for i in range(40))
    path = write(tmp_path / "ods.csv", ",".join(f"h{i}" for i in range(40)) + f"\n{values}\n")
    row = scans.scan_positional(spark, path).first()
    assert row["student_id"] == "0" and row["assignment_submission_rate"] == "39"


def test_positional_scan_reads_what_the_writer_writes(spark, tmp_path):
    text = spark.createDataFrame([(' say "hi", ok ',) + ("x",) * 39], schema.ODS_SCHEMA)
    sinks.write_clean_csv(text, str(tmp_path / "ods"))
    assert scans.scan_positional(spark, str(tmp_path / "ods")).collect() == text.collect()


def test_missing_path_fails_when_the_scan_is_built(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        scans.scan_orc(spark, str(tmp_path / "nothing"))


def test_clean_csv_round_trip(spark, facts, tmp_path):
    import datetime

    df = facts(["student_id", "age", "quiz_score_avg", "enrollment_date", "city"],
               [("S1", 20, 1.25, datetime.date(2024, 2, 3), 'a "b", c'), ("S2", None, None, None, None)])
    path = str(tmp_path / "clean")
    df = df.unionByName(facts(["student_id", "course_name"], [("  S3 ", ' "x", y\t ')]))
    sinks.write_clean_csv(df, path)
    sinks.write_clean_csv(df, path)
    assert sorted(map(str, scans.scan_clean_csv(spark, path).collect())) == sorted(map(str, df.collect()))


def test_export_quotes_everything(spark, tmp_path):
    df = spark.createDataFrame([("a\"b", None, 1.5, True)], "x string, y string, z double, b boolean").coalesce(1)
    sinks.export_csv(df, str(tmp_path / "out"))
    (part,) = glob.glob(str(tmp_path / "out" / "part-*.csv"))
    assert open(part, encoding="utf-8").read() == '"x","y","z","b"\n"a""b","","1.5","true"\n'


def test_bundle_has_one_directory_per_dataset(spark, tmp_path):
    paths = sinks.export_bundle({"one": spark.range(2), "two": spark.range(3)}, str(tmp_path))
    counts = {n: spark.read.option("header", True).csv(p).count() for n, p in paths.items()}
    assert counts == {"one": 2, "two": 3}


def test_database_and_table(spark):
    scans.use_database(spark, "lectern_test")
    scans.use_database(spark, "lectern_test")
    try:
        sinks.create_table(spark.range(2), "numbers")
        sinks.create_table(spark.range(5), "numbers")
        assert spark.table("lectern_test.numbers").count() == 5
        provider = {r[0]: r[1] for r in spark.sql("DESCRIBE EXTENDED numbers").collect()}["Provider"]
        assert provider.lower() == "orc"
    finally:
        spark.sql("USE default")
        spark.sql("DROP DATABASE lectern_test CASCADE")


TARGET = JdbcTarget("jdbc:x://host/db", "org.example.Driver", "reader", "secret")


def test_jdbc_options():
    count = count_options(TARGET, "course_stat")
    assert count["query"] == "SELECT COUNT(*) AS row_count FROM course_stat" and "dbtable" not in count
    overwrite = jdbc_sink.overwrite_options(TARGET, "t", connections=2)
    assert (overwrite["batchsize"], overwrite["numPartitions"], overwrite["dbtable"]) == ("1000", "2", "t")
    assert "truncate" not in overwrite
    replace = jdbc_sink.replace_options(TARGET, "t", connections=4)
    assert (replace["truncate"], replace["isolationLevel"]) == ("true", "READ_COMMITTED")


def test_credentials_come_from_the_session_and_are_not_shown(spark):
    for name in ("url", "driver", "user", "password"):
        spark.conf.set(f"spark.lectern.jdbc.{name}", f"my-{name}")
    assert JdbcTarget.from_conf(spark).options()["password"] == "my-password"
    assert "secret" not in repr(TARGET)


def test_staging_uses_the_checkpoint_folder(spark):
    staged = stage(spark.range(4))
    assert staged.count() == 4
    assert shared_dir(spark).rsplit("/", 1)[1] in staged.inputFiles()[0]
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_a_cluster_without_a_shared_folder_is_refused():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_schema_has_forty_columns():
    assert len(schema.ENROLMENT_COLUMNS) == 40


def test_staged_files_can_be_dropped(spark):
    from lectern.staging import drop_staged

    path = scratch_path(spark, "dropped")
    spark.range(3).write.parquet(path)
    assert stage(spark.range(3)).count() == 3
    drop_staged(spark)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
