import datetime

import pytest
from pyspark.sql import functions as F

from lectern import schema
from lectern.functions import numeric, parsing, text


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_tidy_collapses_every_kind_of_space(spark):
    values = ["\t a  b  c\x1c", "None", "a b", "   ", None, "　x　"]
    assert apply(spark, text.tidy, values) == ["a b c", "None", "a b", "", None, "x"]


def test_null_tokens_are_case_sensitive(spark):
    values = ["null", "NULL", "None", "nan", "", "Nan", "NONE", None, "x"]
    out = apply(spark, lambda c: text.null_tokens(c, schema.NULL_TOKENS), values)
    assert out == [None] * 5 + ["Nan", "NONE", None, "x"]


def test_category(spark):
    values = ["MALE", "m", "女", "f", "其他", "x?", None]
    out = apply(spark, lambda c: text.category(c, schema.GENDER_SPELLINGS, "Unknown"), values)
    assert out == ["Male", "Male", "Female", "Female", "Other", "Unknown", "Unknown"]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("abc", None),
        ("1d", None),
        ("NaN", None),
        ("inf", None),
        ("0x10", None),
        (".", None),
        ("", None),
        ("1e3", 1000.0),
        (" 7 ", 7.0),
        ("\t-2.5\n", -2.5),
        ("+.5", 0.5),
        ("3.", 3.0),
        (None, None),
    ],
)
def test_to_number(spark, value, expected):
    assert apply(spark, numeric.to_number, [value]) == [expected]


def test_to_int_drops_the_fraction(spark):
    values = ["12", "12.7", "-3.9", "x", "99999999999", None]
    assert apply(spark, numeric.to_int, values) == [12, 12, -3, None, None, None]


def test_percentage(spark):
    values = ["80%", "80", "0.8", "0.8%", "1", "0", "x", "80 %", None, "\u300080%", "\u00a00.5 "]
    assert apply(spark, parsing.parse_percentage, values) == [
        80.0, 80.0, 80.0, 0.8, 100.0, 0.0, None, 80.0, None, 80.0, 50.0
    ]


def test_flag(spark):
    values = ["Yes", "已完成", " complete ", "dropout", "否", "2", "maybe", None]
    out = apply(spark, lambda c: parsing.parse_flag(c, schema.FLAG_SPELLINGS), values)
    assert out == [1.0, 1.0, 1.0, 0.0, 0.0, 2.0, None, None]


def test_date_formats(spark):
    values = ["2024-02-29", " 2024-03-01 ", "2024-02-30", "31/12/2023", None]
    day = datetime.date
    assert apply(spark, parsing.parse_date, values) == [
        day(2024, 2, 29), day(2024, 3, 1), None, None, None
    ]
    parts = ["2024-01-05 10:00:00", "2024-01-05T10:00", "2024-1-5", "2024-01-05x"]
    assert apply(spark, parsing.parse_date, parts) == [day(2024, 1, 5)] * 3 + [None]
    others = ["2024/01/05", "2024/1/5", "2024.01.05", "2024-01-05", "5.1.2024"]
    assert apply(spark, lambda c: parsing.parse_date(c, parsing.DAY_FORMATS), others)[:4] == [day(2024, 1, 5)] * 4
    both = ("yyyy-MM-dd", "dd/MM/yyyy")
    assert apply(spark, lambda c: parsing.parse_date(c, both), values)[3] == day(2023, 12, 31)


def test_rounding(spark):
    assert apply(spark, numeric.whole, [0.5, 1.5, 2.5, None], "double") == [0, 2, 2, None]
    assert apply(spark, numeric.half_up, [1.005, 2.345], "double") == [1.01, 2.35]
    assert apply(spark, numeric.half_even, [0.125, 0.375, 0.575], "double") == [0.12, 0.38, 0.57]


def test_submission_rate(spark):
    df = spark.createDataFrame([(0, 0), (1, 2), (None, 1)], "a int, b int")
    rate = numeric.submission_rate(F.col("a"), F.col("b"))
    assert [r[0] for r in df.select(rate).collect()][:2] == [0.0, 33.33]


def test_rate_to_percent(spark):
    values = [0.5, 1.0, 37.0, None]
    assert apply(spark, numeric.rate_to_percent, values, "double") == [50.0, 100.0, 37.0, 0.0]


def test_percent_of_nothing_is_zero(spark):
    df = spark.createDataFrame([(1, 4), (0, 0)], "a int, b int")
    share = numeric.percent_of(F.col("a"), F.col("b"))
    assert [r[0] for r in df.select(share).collect()] == [25.0, 0.0]


def test_first_text(spark):
    df = spark.createDataFrame([("", "b"), (None, ""), ("a", "b")], "x string, y string")
    label = text.first_text(F.col("x"), F.col("y"), default=schema.UNCATEGORISED)
    assert [r[0] for r in df.select(label).collect()] == ["b", schema.UNCATEGORISED, "a"]


def test_views_limit_generated_methods_in_any_session(spark, sf_dir):
    """Spark's own limit lets methods through that the JVM never compiles."""
    from lectern.sources.views import learning

    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    try:
        for given, wanted in (("65535", "8000"), ("4000", "4000")):
            spark.conf.set(key, given)
            learning(spark, sf_dir)
            assert spark.conf.get(key) == wanted
    finally:
        spark.conf.set(key, before)
