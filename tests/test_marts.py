import datetime

from pyspark.sql import functions as F

from lectern import schema
from lectern.operators import gates
from lectern.plans import layers, marts, overview, warnings
from lectern.sources.views import learning

DAY = datetime.date


def test_unknown_completion_counts_by_the_rule_of_each_mart(facts):
    df = facts(["student_id", "course_id", "course_name", "completed"],
               [("S1", "C1", "x", 1), ("S2", "C1", "x", None)])
    core, stat = marts.course_core(df).first(), layers.course_stat(df).first()
    assert (core["learner_count"], core["completion_count"], core["completion_rate"]) == (2, 1, 50.0)
    assert (stat["learner_count"], stat["completion_count"], stat["completion_rate"]) == (2, 1, 100.0)
    assert layers.student_feature(df).filter("student_id = 'S2'").first()["completion_rate"] is None


def test_averages_skip_null_and_measures_may_be_missing(facts):
    df = facts(["course_id", "course_name", "quiz_score_avg"],
               [("C1", "x", 10.0), ("C1", "x", None), ("C2", "y", None)])
    assert [tuple(r) for r in marts.course_score(df).collect()] == [("C1", "x", 1, 10.0, None)]
    stat = {r["course_id"]: r["avg_quiz_score"] for r in layers.course_stat(df).collect()}
    assert stat == {"C1": 10.0, "C2": None}


def test_course_with_two_spellings_is_one_row(facts):
    df = facts(["course_id", "course_name", "time_spent_hours"],
               [("C1", "Intro", 1.0), ("C1", "intro", 2.0), ("C1", None, 6.0)])
    stat = layers.course_stat(df).collect()
    assert [(r["course_name"], r["learner_count"], r["avg_study_time_hours"]) for r in stat] == [("intro", 3, 3.0)]
    assert marts.course_core(df).count() == 2


def test_missing_student_id_is_a_group(facts):
    df = facts(["student_id", "course_id", "enrollment_date"],
               [(None, "C1", DAY(2024, 1, 1)), (None, "C1", DAY(2024, 1, 2)), ("S1", "C1", None)])
    out = {r["student_id"]: (r["course_count"], r["study_days"]) for r in marts.student_core(df).collect()}
    assert out == {None: (1, 2), "S1": (1, 0)}


def test_week_labels_at_the_turn_of_the_year(facts):
    days = [DAY(2024, 12, 30), DAY(2021, 1, 1), DAY(2024, 2, 14)]
    df = facts(["enrollment_date", "student_id", "course_id", "time_spent_hours"],
               [(d, "S1", "C1", 1.0) for d in days])
    assert [r["week_label"] for r in marts.trend_weekly(df).collect()] == ["2021-W53", "2024-W01", "2024-W07"]
    assert [r["week_label"] for r in marts.trend_weekly_iso(df).collect()] == ["2020-W53", "2024-W07", "2025-W01"]


def test_trend_drops_rows_without_a_required_value(facts):
    columns = ["enrollment_date", "student_id", "course_id", "time_spent_hours"]
    good = (DAY(2024, 1, 1), "S1", "C1", 2.0)
    bad = [tuple(None if i == j else v for j, v in enumerate(good)) for i in range(4)]
    df = facts(columns, [good, *bad])
    assert marts.trend_daily(df).first()["learning_times"] == 1
    assert tuple(gates.quality_counts(df, marts.trend_valid()).first()) == (5, 1, 4)


def test_resource_rank_is_dense(facts):
    data = [("C1", "a", 5), ("C2", "b", 3), ("C3", "c", 3), ("C4", "d", None)]
    df = facts(["course_id", "course_name", "login_frequency"], data)
    ranks = [(r["resource_id"], r["usage_rank"]) for r in marts.resource_core(df).collect()]
    assert ranks == [("C1", 1), ("C2", 2), ("C3", 2), ("C4", 3)]


def test_daily_rows_sum_to_weekly_rows(spark, sf_dir):
    facts = learning(spark, sf_dir)
    daily = marts.trend_daily(facts).agg(F.sum("learning_times")).first()[0]
    weekly = marts.trend_weekly(facts).agg(F.sum("learning_times")).first()[0]
    assert daily == weekly == facts.count()


def test_both_rankings_agree(spark, sf_dir):
    facts = learning(spark, sf_dir)
    one, other = marts.rank_enrollment(facts), marts.rank_enrollment_scaled(facts)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect()))


def test_level_counts_sum_to_rows(spark, sf_dir):
    facts = learning(spark, sf_dir)
    risk = warnings.course_risk_summary(warnings.scored_enrolments(facts))
    wrong = F.col("student_count") != sum((F.col(c) for c in warnings.LEVELS), F.lit(0))
    assert risk.filter(wrong).count() == 0
    assert risk.agg(F.sum("student_count")).first()[0] == facts.count()


def test_layer_types(spark, sf_dir):
    assert learning(spark, sf_dir).columns == schema.ENROLMENT_NAMES
    assert dict(marts.trend_daily(learning(spark, sf_dir)).dtypes)["stat_date"] == "date"


def test_week_spread(spark):
    weekly = spark.createDataFrame(
        [(2024, 1, "2024-W01", 70.0, 10, 50.0), (2024, 2, "2024-W02", 7.0, 1, None)],
        "stat_year int, stat_week int, week_label string, total_study_time_hours double,"
        " learner_count long, avg_quiz_score double",
    )
    days = overview.week_spread(weekly).orderBy("week_label").collect()
    assert len(days) == 14 and all(r["is_estimate"] for r in days)
    assert tuple(days[0])[:5] == ("2024-W01-D1", 8.6, 8, 50.0, 28)
    assert tuple(days[13])[:5] == ("2024-W02-D7", 1.1, 1, 0.0, 29)
