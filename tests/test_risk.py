import pytest
from pyspark.sql import functions as F

from lectern import schema
from lectern.operators import advice, benchmark, selecting
from lectern.operators.aggregate import filter_share, share_by_label, sum_columns
from lectern.operators.risk import add_risk_detail, add_risk_level, is_level
from lectern.plans import profiles, warnings
from lectern.staging import stage

INPUTS = [
    "login_frequency", "days_since_last_login", "assignment_submission_rate", "assignments_missed",
    "progress_percentage", "video_completion_rate", "quiz_score_avg",
]
FINE = (4, 10, 50.0, 4, 30.0, 40.0, 55.0)


def scored(facts, *rows):
    return add_risk_level(facts(INPUTS, list(rows)))


@pytest.mark.parametrize(
    "change, flags",
    [
        ({}, (False, False, False, False)),
        ({0: 3}, (True, False, False, False)),
        ({1: 11}, (True, False, False, False)),
        ({2: 49.9}, (False, True, False, False)),
        ({3: 5}, (False, True, False, False)),
        ({4: 29.0}, (False, False, False, False)),
        ({4: 29.0, 5: 39.0}, (False, False, True, False)),
        ({6: 54.9}, (False, False, False, True)),
    ],
)
def test_flags_at_their_bounds(facts, change, flags):
    row = tuple(change.get(i, v) for i, v in enumerate(FINE))
    out = scored(facts, row).first()
    assert tuple(out[f"{r}_risk"] for r in schema.RULE_LABELS) == flags
    assert out["risk_sum"] == sum(flags)
    assert out["warning_level"] == (schema.LOW if sum(flags) else schema.SAFE)


def test_missing_measures_are_risks(facts):
    out = add_risk_detail(scored(facts, (None,) * 7)).first()
    assert (out["risk_sum"], out["warning_level"]) == (4, schema.HIGH)
    assert out["login_rule"] == "登录风险"
    assert out["rule_summary"] == "登录:风险 / 作业:风险 / 进度:风险 / 成绩:风险"


def test_two_flags_are_mid(facts):
    assert scored(facts, (3, 0, 10.0, 0, 90.0, 90.0, 90.0)).first()["warning_level"] == schema.MID


def test_supplied_level_wins(facts):
    df = facts(INPUTS, [FINE]).withColumns({"lv": F.lit(schema.HIGH), "n": F.lit(None).cast("int")})
    out = add_risk_level(df, "lv", "n").first()
    assert (out["warning_level"], out["risk_sum"]) == (schema.HIGH, 0)


def profile_row(spark, values, benches, level=schema.SAFE, label=None):
    names = [f"value_{m}" for m in benchmark.MEASURES] + [f"bench_{m}" for m in benchmark.MEASURES]
    ddl = ", ".join(f"{n} double" for n in names) + ", warning_level string, label string"
    return spark.createDataFrame([(*values, *benches, level, label)], ddl)


@pytest.mark.parametrize(
    "values, benches, weakest",
    [
        ((10, 10, 10, 10, 10), (10, 10, 10, 10, 10), schema.STABLE_MEASURE),
        ((9.3, 10, 10, 10, 10), (10, 10, 10, 10, 10), schema.STABLE_MEASURE),
        ((9.1, 5, 10, 10, 10), (10, 10, 10, 10, 10), schema.STUDENT_MEASURES["completion"]),
        ((5, 5, 10, 10, 10), (10, 10, 10, 10, 10), schema.STUDENT_MEASURES["time"]),
        ((0, 0, 0, 0, 0), (0, 0, 0, 0, 0), schema.STABLE_MEASURE),
        ((10, 10, 10, 10, 0), (10, 10, 10, 10, 1), schema.STUDENT_MEASURES["score"]),
    ],
)
def test_weakest_measure(spark, values, benches, weakest):
    df = profile_row(spark, map(float, values), map(float, benches))
    out = advice.add_measure_advice(benchmark.add_weakest_measure(df)).first()
    assert out["weakest_measure"] == weakest
    assert out["advice"].endswith(advice.MEASURE_ADVICE[weakest])


def test_strong_peer_is_capped(spark):
    out = benchmark.add_strong_peer(profile_row(spark, [0.0] * 5, [200.0, 90.0, 50.0, 89.5, 60.0])).first()
    assert [out[f"peer_{m}"] for m in benchmark.MEASURES] == [256.0, 100.0, 58.0, 100.0, 66.0]


@pytest.mark.parametrize(
    "values, level, label, persona",
    [
        ((11, 11, 0, 0, 11), schema.HIGH, None, "leader"),
        ((0, 10, 10, 10, 0), schema.HIGH, None, "advancing"),
        ((0, 0, 0, 0, 0), schema.HIGH, None, "at_risk"),
        ((0, 0, 0, 0, 0), schema.MID, "", "wavering"),
        ((0, 0, 0, 0, 0), schema.LOW, None, "steady"),
        ((0, 0, 0, 0, 0), None, None, "steady"),
    ],
)
def test_persona_cascade(spark, values, level, label, persona):
    df = profile_row(spark, map(float, values), [10.0] * 5, level, label)
    assert benchmark.add_persona(df, "label").first()["persona_label"] == schema.PERSONA_LABELS[persona]


def test_supplied_persona_wins(spark):
    df = profile_row(spark, [0.0] * 5, [1.0] * 5, label="own")
    assert benchmark.add_persona(df, "label").first()["persona_label"] == "own"


def test_course_advice(spark):
    df = spark.createDataFrame([(schema.COURSE_TYPES[0],), ("?",), (None,)], "t string")
    out = [r[0] for r in df.select(advice.course_advice(F.col("t"))).collect()]
    assert out == [advice.COURSE_ADVICE[schema.COURSE_TYPES[0]]] + [advice.COURSE_DEFAULT] * 2


COURSE = "course_id string, course_name string, avg_quiz_score double, avg_submit_rate double, avg_progress double, avg_video_completion_rate double, high_risk_pct double"


def test_platform_average_is_unweighted_with_null_as_zero(spark):
    df = spark.createDataFrame([("a", "a", 90.0, 1.0, 1.0, 1.0, 10.0), ("b", "b", None, 3.0, 3.0, 3.0, 0.0)], COURSE)
    assert tuple(warnings.platform_average(df).first()) == (45.0, 2.0, 2.0, 2.0, 5.0)
    assert tuple(warnings.platform_average(df.filter("false")).first()) == (0.0,) * 5
    weak = {r["course_id"]: (r["weak_items"], r["risk_above_platform"]) for r in warnings.course_weak_items(df).collect()}
    assert weak == {"a": ("作业提交、课程进度、视频完课", True), "b": ("平均得分", False)}


def test_positions(spark):
    df = spark.createDataFrame([("a", "a", 5.0, 0.0, 0.0, 0.0, 9.0), ("b", "b", 7.0, 0.0, 0.0, 0.0, None), ("c", "c", 5.0, 0.0, 0.0, 0.0, 1.0)], COURSE)
    out = {r["course_id"]: (r["score_position"], r["risk_position"], r["peer_count"]) for r in warnings.course_positions(df).collect()}
    assert out == {"a": (2, 3, 3), "b": (1, 1, 3), "c": (3, 2, 3)}


def test_shares(spark):
    df = spark.createDataFrame([("x",), ("x",), ("y",)], "warning_level string")
    shares = {r[0]: (r[1], r[2]) for r in share_by_label(df, "warning_level", "n", "pct").collect()}
    assert shares == {"x": (2, 66.67), "y": (1, 33.33)}
    assert tuple(filter_share(df, is_level("x")).first()) == (2, 3, 66.67)
    assert tuple(filter_share(df.filter("false"), is_level("x")).first()) == (0, 0, 0.0)


def test_totals_read_null_as_zero(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "a int, b int")
    assert tuple(sum_columns(df, {"a": "a", "b": "b"}).first()) == (3, 5)


def test_filters(spark):
    df = spark.createDataFrame(
        [("S1", "C1", "Intro", schema.HIGH), ("S12", "C2", None, schema.LOW)],
        "student_id string, course_id string, course_name string, warning_level string",
    )
    ids = lambda d: sorted(r[0] for r in d.collect())
    assert ids(selecting.filter_equals(df, course_id="", warning_level=None)) == ["S1", "S12"]
    assert ids(selecting.filter_equals(df, course_id="C2")) == ["S12"]
    assert ids(selecting.filter_search(df, student=" 1 ", course="1I")) == ["S1"]
    assert ids(selecting.filter_search(df, course="C2")) == ["S12"]
    assert ids(selecting.filter_search(df, level=schema.LOW, course_id="C1")) == []
    chosen = spark.createDataFrame([("S1",), ("S1",)], "student_id string")
    assert ids(selecting.filter_selected(df, chosen, "student_id")) == ["S1"]


def test_profile_of_one_student(facts):
    df = facts(
        ["student_id", "course_id", "course_name", "gender", "quiz_score_avg", "time_spent_hours", "completed"],
        [("S1", "C1", "a", "Male", 50.0, 2.0, 1), ("S1", "C2", "b", "Female", 70.0, 4.0, 0), ("S2", "C1", "a", "Male", 90.0, 6.0, 1)],
    )
    marked = warnings.scored_enrolments(df)
    students = profiles.student_table(df)
    nested = profiles.student_profile(marked, students, "S1").collect()
    assert {r["course"]["course_id"] for r in nested} == {"C1", "C2"}
    assert {r["basic"]["gender"] for r in nested} == {"Male"}
    assert {r["feature"]["avg_quiz_score"] for r in nested} == {60.0}
    course_risk = warnings.stored_course_risk(marked)
    report = {
        (r["student_id"], r["course_id"]): r
        for r in profiles.student_report(profiles.benchmarked(marked, students, course_risk)).collect()
    }
    first = report["S1", "C1"]
    assert first["student_name"] == "--" and first["education_level"] == "--"
    assert (first["total_study_time_hours"], first["class_avg_study_time_hours"]) == (2.0, 4.0)
    assert (first["completion_rate"], first["avg_quiz_score"]) == (50.0, 60.0)


def test_profile_without_stored_features_falls_back(facts):
    df = facts(["student_id", "course_id", "course_name", "quiz_score_avg", "progress_percentage"], [("S1", "C1", "a", 50.0, 30.0)])
    students = stage(profiles.student_table(df).filter("false"))
    valued = profiles.attach_features(warnings.scored_enrolments(df), students).first()
    assert (valued["value_score"], valued["value_completion"], valued["value_grade"]) == (50.0, 30.0, 0.0)


def test_teacher_falls_back_to_the_risk_row(facts):
    df = facts(["student_id", "course_id", "course_name", "quiz_score_avg", "completed"], [("S1", "C1", "a", 50.0, 1), ("S2", "C1", "a", 70.0, 0)])
    course_risk = warnings.course_risk_summary(warnings.scored_enrolments(df))
    detail = profiles.teacher_detail(df).withColumns({"avg_quiz_score": F.lit(None).cast("double"), "total_student_count": F.lit(0)})
    out = profiles.teacher_profile(detail, course_risk).first()
    assert (out["avg_quiz_score"], out["student_count"], out["finish_rate"], out["high_risk_count"]) == (60.0, 2, 50.0, 2)
