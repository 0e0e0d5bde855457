import pytest
from pyspark.sql import functions as F

from lectern import schema
from lectern.operators import cleaning as C
from lectern.plans import cleaning as plan

RULES = plan.CleaningRules()


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_headers(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int").toDF("  Student  ID ", "x\ty")
    assert C.clean_headers(df).columns == ["Student_ID", "x_y"]


def test_required_columns_are_named_sorted(spark):
    df = spark.createDataFrame([("a",)], "Course_ID string")
    with pytest.raises(ValueError, match=r"\['Completed', 'Course_Name', 'Student_ID'\]"):
        C.require_columns(df, schema.RAW_REQUIRED)


def test_keep_last_takes_the_greatest_order_value(spark):
    data = [("a", "x", 1, "old"), ("a", "x", 3, "new"), ("a", "x", 2, "mid"), (None, "x", 1, "n")]
    df = spark.createDataFrame(data, "s string, c string, o int, v string")
    kept = C.keep_last(df, ["s", "c"], ["o"]).select("s", "v")
    assert sorted(rows(kept), key=str) == [("a", "new"), (None, "n")]


def test_keep_last_among_rows_that_qualify(spark):
    data = [("a", 1, True), ("a", 2, False), ("b", 1, False), ("c", 1, None), (None, 1, True)]
    df = spark.createDataFrame(data, "k string, o int, ok boolean")
    kept = C.keep_last(df, ["k"], ["o"], among=F.col("ok"))
    assert sorted(rows(kept), key=str) == [("a", 1, True), (None, 1, True)]


def test_keep_last_reduces_a_hot_key_before_the_shuffle(spark):
    df = spark.createDataFrame([("k", i) for i in range(100)], "k string, id int")
    plan_text = C.keep_last(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan_text.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_range_bounds_are_inclusive_and_null_passes(spark):
    data = [(10.0, 0.0), (100.0, 1.0), (9.0, 0.0), (50.0, 2.0), (None, None)]
    df = spark.createDataFrame(data, "Age double, Completed double")
    assert rows(C.drop_out_of_range(df)) == [(10.0, 0.0), (100.0, 1.0), (None, None)]


@pytest.mark.parametrize(
    "values, filled",
    [
        ([1.0, 2.0, 4.0, None], 2.0),
        ([1.0, 2.0, None], 1.5),
        ([None, None], 0.0),
        ([5.0, 5.0, 5.0, 9.0, None], 5.0),
    ],
)
def test_median_fill(spark, values, filled):
    df = spark.createDataFrame([(v,) for v in values], "Age double")
    out = [r[0] for r in C.fill_medians(df, ["Age"]).collect()]
    assert sorted(out) == sorted([filled if v is None else v for v in values])


def test_blank_course_name_does_not_remove_its_row(spark):
    df = spark.createDataFrame(
        [("S1", "C1", " ", "yes"), ("S2", None, "n", "yes"), ("S3", "C1", "n", "maybe")],
        "Student_ID string, Course_ID string, Course_Name string, Completed string",
    )
    kept = C.drop_missing(plan.normalise(df, RULES), RULES.critical)
    assert rows(kept.select("Student_ID", "Course_Name", "Completed")) == [("S1", "Unknown", 1.0)]


RAW = (
    "n int, `Student ID` string, Name string, Course_ID string, Course_Name string, Gender string,"
    " Age string, Assignments_Submitted string, Assignments_Missed string, Quiz_Score_Avg string,"
    " Video_Completion_Rate string, Fee_Paid string, Completed string, Enrollment_Date string"
)
DIRTY = [
    (1, "S1", "Ann", "C1", "Intro", "m", "20", "1", "2", "70.126", "0.8", "yes", "1", "2024-01-02"),
    (2, " S1 ", "Ann", "C1", "Intro", "F", "30", "0", "0", "71", "80%", "no", "no", "bad"),
    (3, "S2", "Bob", "C1", "Intro", None, "x", None, "1", "80", "90", None, "yes", None),
    (4, "S3", "Cy", "C1", "Intro", "?", "200", "1", "1", "80", "90", "1", "yes", None),
    (5, "nan", "Di", "C1", "Intro", "f", "20", "1", "1", "80", "90", "1", "yes", None),
    (6, "S4", None, "C2", "None", "其他", "41", "3", "1", "", "1", "0", "2", None),
    (7, "S5", None, "C2", "None", "other", "41", "3", "1", "", "1", "0", "0", "2024-05-06"),
]


def test_whole_cleaning(spark):
    raw = spark.createDataFrame(DIRTY, RAW)
    out = plan.clean_enrollments(raw, ["n"], RULES)
    assert "Name" not in out.columns and "n" not in out.columns
    by_id = {r["Student_ID"]: r.asDict() for r in out.collect()}
    assert set(by_id) == {"S1", "S2", "S5"}
    assert by_id["S1"]["Gender"] == "Female" and by_id["S1"]["Age"] == 30
    assert by_id["S1"]["Assignment_Submission_Rate"] == 0.0
    assert by_id["S1"]["Enrollment_Date"] is None
    # medians over S1, S2, S5: age of (30, 41), submitted of (0, 3), paid of (0, 0)
    assert by_id["S2"]["Age"] == 36 and by_id["S2"]["Gender"] == "Unknown"
    assert by_id["S2"]["Assignments_Submitted"] == 2
    assert by_id["S2"]["Assignment_Submission_Rate"] == 60.0
    assert by_id["S2"]["Fee_Paid"] == 0
    assert by_id["S5"]["Quiz_Score_Avg"] == 75.5
    assert by_id["S5"]["Video_Completion_Rate"] == 100.0
    assert by_id["S5"]["Course_Name"] == "Unknown"


def test_report_counts(spark):
    raw = spark.createDataFrame(DIRTY, RAW)
    report = rows(plan.cleaning_report(raw, ["n"], RULES))
    assert [m for m, _ in report] == schema.CLEANING_METRICS
    assert [v for _, v in report] == [7, 13, 1, 1, 2, 3, 13]


def test_report_of_no_rows(spark):
    raw = spark.createDataFrame([], RAW)
    assert [v for _, v in rows(plan.cleaning_report(raw, ["n"], RULES))] == [0, 13, 0, 0, 0, 0, 13]


def test_cleaning_twice_equals_once(spark):
    """But for percentages: a value of 0 to 1 is scaled each time."""
    raw = spark.createDataFrame(DIRTY, RAW).drop("Video_Completion_Rate")
    columns = ["Student_ID", "Course_ID", "Gender", "Age", "Completed", "Quiz_Score_Avg"]
    once = plan.clean_enrollments(raw, ["n"], RULES)
    text = once.select(*[F.col(c).cast("string").alias(c) for c in once.columns])
    twice = plan.clean_enrollments(text.withColumn("n", F.lit(1)), ["n"], RULES)
    assert sorted(rows(once.select(*columns))) == sorted(rows(twice.select(*columns)))


def test_optional_columns_may_be_absent(spark):
    df = spark.createDataFrame([("S1", "C1", "n", "1", 1)], "Student_ID string, Course_ID string, Course_Name string, Completed string, n int")
    assert rows(plan.clean_enrollments(df, ["n"], RULES)) == [("S1", "C1", "n", 1)]
