from pyspark.sql import functions as F

from lectern.operators import joining


def _lookup(spark, rows):
    detail = spark.createDataFrame(rows, "k string, n int").repartition(7, "n")
    summary = detail.filter("k <> 'none'").groupBy("k").agg(
        F.count("*").alias("rows"), F.sum("n").alias("total")
    )
    return joining.lookup(detail, summary, "k", ["total"], "rows", ["n"])


ROWS = [("hot", i) for i in range(400)] + [(f"k{i}", i) for i in range(300)]
ROWS += [("none", 1), (None, 5), (None, 6)]


def test_heavy_and_plain_lookups_agree(spark, monkeypatch):
    monkeypatch.setattr(joining, "HEAVY_PARTS", 10)
    split = _lookup(spark, ROWS).collect()
    monkeypatch.setattr(joining, "HEAVY_PARTS", 1)
    plain = _lookup(spark, ROWS).collect()
    assert sorted(map(str, split)) == sorted(map(str, plain))
    assert len(split) == len(ROWS)
    assert {r["total"] for r in split if r["k"] == "hot"} == {sum(range(400))}
    assert {r["total"] for r in split if r["k"] in (None, "none")} == {None}


def test_heavy_key_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(joining, "SALTS", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = _lookup(spark, ROWS)
        tasks = out.filter("k = 'hot'").select(F.spark_partition_id()).distinct().count()
        nulls = out.filter("k is null").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert tasks > 1 and nulls == 2


def test_heavy_keys_are_few(spark):
    summary = spark.createDataFrame([("a", 900), ("b", 99), ("c", 1)], "k string, rows int")
    assert {r[0] for r in joining.heavy_keys(summary, "k", "rows").collect()} == {"a", "b"}


def test_merge_keeps_the_left_side_on_a_clash(spark):
    left = spark.createDataFrame([("C1", None), ("C2", "left")], "course_id string, name string")
    right = spark.createDataFrame([("C1", "right", 7)], "course_id string, name string, n int")
    merged = joining.merge_left(left, right, "course_id").orderBy("course_id")
    assert [tuple(r) for r in merged.collect()] == [("C1", None, 7), ("C2", "left", None)]


def test_first_per_key_keeps_one_whole_row(spark):
    df = spark.createDataFrame([(1, "a", "z"), (1, "b", "y"), (1, "b", "y")], "k int, x string, y string")
    assert [tuple(r) for r in joining.first_per_key(df, ["k"]).collect()] == [(1, "b", "y")]
