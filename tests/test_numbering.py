import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lectern.operators import numbering, selecting
from lectern.operators.median import exact_medians
from lectern.plans import marts


@pytest.fixture(scope="module")
def scores(spark):
    random.seed(7)
    data = [
        (i, None if i % 50 == 0 else float(random.choice([1, 1, 1, 2, 3, random.randint(0, 400)])))
        for i in range(3000)
    ]
    return spark.createDataFrame(data, "id int, score double").repartition(6, "id")


def test_number_rows_equals_window(spark, scores):
    order = [F.col("score").desc_nulls_last(), F.col("id")]
    window = scores.withColumn("expected", F.row_number().over(Window.orderBy(*order)))
    numbered = numbering.number_rows(scores, *order)
    joined = numbered.join(window.select("id", "expected"), "id")
    assert joined.count() == 3000
    assert joined.filter(F.col("position") != F.col("expected")).count() == 0


@pytest.mark.parametrize("rank", [numbering.dense_rank, numbering.dense_rank_counts])
def test_dense_rank_equals_window(spark, scores, rank):
    window = F.dense_rank().over(Window.orderBy(F.col("score").desc_nulls_last()))
    ranked = rank(scores, "score", "rank").withColumn("expected", window)
    assert ranked.count() == 3000
    assert ranked.filter(F.col("rank") != F.col("expected")).count() == 0


def test_numbering_of_no_rows(spark, scores):
    assert numbering.number_rows(scores.filter("id < 0"), F.col("id")).count() == 0


def test_number_rows_uses_no_global_window_over_rows(spark, scores):
    plan = numbering.number_rows(scores, F.col("id"))._jdf.queryExecution().optimizedPlan().toString()
    window_input = plan[plan.index("Window") :].split("\n", 2)[1]
    assert "Aggregate [_block" in window_input


@pytest.mark.parametrize("n", [1, 2, 3, 10, 999, 1000])
def test_medians_equal_brute_force(spark, n):
    random.seed(n)
    a = [round(random.random() * 50, 1) for _ in range(n)]
    b = [None if i % 3 else random.choice([-2.0, 7.0]) for i in range(n)]
    df = spark.createDataFrame(list(zip(a, b, [None] * n)), "a double, b double, c double")
    out = {r["measure"]: r["median"] for r in exact_medians(df, ["a", "b", "c"]).collect()}
    assert out == {
        "a": pytest.approx(statistics.median(a)),
        "b": statistics.median([x for x in b if x is not None]),
    }


def test_rank_example(facts):
    learners = {"C1": 5, "C2": 3, "C3": 3, "C4": 1}
    data = [(f"S{i}", c, c.lower()) for c, n in learners.items() for i in range(n)]
    df = facts(["student_id", "course_id", "course_name"], data * 2)
    for ranking in (marts.rank_enrollment, marts.rank_enrollment_scaled):
        assert [(r[0], r[1], r[3]) for r in ranking(df).collect()] == [
            (1, "C1", 5), (2, "C2", 3), (2, "C3", 3), (3, "C4", 1)
        ]


def test_blank_ids_do_not_count(facts):
    data = [("S1", "C1", "x"), ("", "C1", "x"), (None, "C1", "x"), ("S1", "", "x"), ("S1", "C2", "")]
    df = facts(["student_id", "course_id", "course_name"], data)
    assert [tuple(r) for r in marts.rank_enrollment(df).collect()] == [(1, "C1", "x", 1)]


def test_pages(spark):
    df = spark.range(25).repartition(4)
    assert [r[0] for r in selecting.page_rows(df, 9, 10, ["id"]).collect()] == list(range(20, 25))
    assert [r[0] for r in selecting.page_rows(df, 0, 10, ["id"]).collect()] == list(range(10))
    assert [r[0] for r in selecting.page_rows(df, 2, 10, ["id"]).collect()] == list(range(10, 20))
    assert selecting.page_rows(df.filter("id < 0"), 3, 10, ["id"]).count() == 0
    assert selecting.page_count(0, 10) == 1 and selecting.page_count(25, 10) == 3


def test_sorts(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 3.0), ("d", 3.0)], "id string, s double")
    ranked = selecting.rank_by_measure(df, "s", "id").orderBy("position")
    assert [r["id"] for r in ranked.collect()] == ["c", "d", "a", "b"]
    pinned = selecting.pinned_first(df, "id", "b", "s").orderBy("position")
    assert [r["id"] for r in pinned.collect()] == ["b", "c", "d", "a"]
    assert [r["id"] for r in selecting.top(df, 2, "s", "id").collect()] == ["c", "d"]


def test_latest_is_ascending(spark):
    df = spark.createDataFrame([(2023, 52), (2024, 2), (2024, 1)], "y int, w int")
    assert [tuple(r) for r in selecting.latest(df, 2, "y", "w").collect()] == [(2024, 1), (2024, 2)]


def test_top_is_planned_as_top_k(spark):
    plan = selecting.top(spark.range(100), 3, "id", "id")._jdf.queryExecution().executedPlan()
    assert "TakeOrderedAndProject" in plan.toString()


def test_deep_pages_ask_for_the_last_page_of_any_list(spark, sf_dir, monkeypatch):
    """20 rows a page: of a list above 20,000,000 rows page 10**6 is not the last."""
    from lectern.catalog import queries

    asked = []

    def page_rows(df, page, size, order):
        asked.append(page)
        return df.limit(0)

    monkeypatch.setattr(selecting, "page_rows", page_rows)
    queries.all_queries()["page_rows_deep"](spark, sf_dir)
    assert asked[0] >= selecting.page_count(10**15, 20)
