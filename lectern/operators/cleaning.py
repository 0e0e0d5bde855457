"""Row-level cleaning, row removal and filling."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern import schema
from lectern.functions import numeric, parsing, text
from lectern.operators.median import exact_medians


def present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The wanted columns that ``df`` has; optional columns may be absent."""
    return [c for c in columns if c in df.columns]


def _each(df: DataFrame, columns: Sequence[str], change) -> DataFrame:
    return df.withColumns({c: change(F.col(c)) for c in present(df, columns)})


def clean_headers(df: DataFrame) -> DataFrame:
    """Strip column names and turn runs of white space into ``_``."""
    return df.toDF(*[re.sub(r"\s+", "_", str(c).strip()) for c in df.columns])


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"required columns are missing: {missing}")
    return df


def tidy_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _each(df, columns, text.tidy)


def drop_null_tokens(
    df: DataFrame, columns: Sequence[str], tokens: Sequence[str] = schema.NULL_TOKENS
) -> DataFrame:
    return _each(df, columns, lambda c: text.null_tokens(c, tokens))


def map_category(
    df: DataFrame,
    column: str,
    mapping: Mapping[str, str] = schema.GENDER_SPELLINGS,
    default: str = schema.UNKNOWN,
) -> DataFrame:
    return _each(df, [column], lambda c: text.category(c, mapping, default))


def fill_text(
    df: DataFrame, columns: Sequence[str], default: str = schema.UNKNOWN
) -> DataFrame:
    columns = present(df, columns)
    return df.na.fill(default, columns) if columns else df


def parse_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _each(df, columns, numeric.to_number)


def parse_percentages(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _each(df, columns, parsing.parse_percentage)


def parse_flags(
    df: DataFrame,
    columns: Sequence[str],
    spellings: Mapping[str, int] = schema.FLAG_SPELLINGS,
) -> DataFrame:
    return _each(df, columns, lambda c: parsing.parse_flag(c, spellings))


def parse_dates(
    df: DataFrame, columns: Sequence[str], formats: tuple[str, ...] = parsing.DAY_FORMATS
) -> DataFrame:
    return _each(df, columns, lambda c: parsing.parse_date(c, formats))


def is_missing(columns: Sequence[str]) -> Column:
    """True when any of the columns is NULL."""
    return numeric.any_of([F.col(c).isNull() for c in columns])


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop("any", subset=list(columns))


def keep_last(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    among: Column | None = None,
) -> DataFrame:
    """One row per key, the greatest by ``order``, which must be total per key.

    With ``among``, the last of the rows for which it holds. The condition takes part
    in the ordering instead of filtering first: Spark would evaluate the parsing
    behind such a filter once more for it.

    The rank-1 filter lets Spark drop all but one row per key inside each task
    before the shuffle, so a key with a very large share of the rows sends at
    most one row per task.
    """
    newest = [(F.col(o) if isinstance(o, str) else o).desc() for o in order]
    if among is not None:
        df = df.withColumn("_among", F.coalesce(among, F.lit(False)))
        newest.insert(0, F.col("_among").desc())
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest))
    kept = df.withColumn("_nth", first).filter(F.col("_nth") == 1).drop("_nth")
    return kept if among is None else kept.filter("_among").drop("_among")


def out_of_range(
    df: DataFrame, ranges: Mapping[str, tuple[float, float]] = schema.RAW_RANGES
) -> Column:
    """True when a non-NULL value lies outside its inclusive bounds."""
    rules = [
        F.col(c).isNotNull() & ~F.col(c).between(*ranges[c])
        for c in present(df, list(ranges))
    ]
    return numeric.any_of(rules) if rules else F.lit(False)


def drop_out_of_range(
    df: DataFrame, ranges: Mapping[str, tuple[float, float]] = schema.RAW_RANGES
) -> DataFrame:
    return df.filter(~out_of_range(df, ranges))


def fill_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs become the exact median of their column, 0 where all are NULL.

    ``df`` is read several times, so pass a stored table. Columns without a NULL
    are found first, by one light pass, and left out of the counting.
    """
    columns = present(df, columns)
    if not columns:
        return df
    holes = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    columns = [c for c in columns if holes[c]]
    if not columns:
        return df
    medians = {
        row["measure"]: row["median"] for row in exact_medians(df, columns).collect()
    }
    return df.na.fill({c: medians.get(c, 0.0) for c in columns})


def add_submission_rate(
    df: DataFrame, submitted: str, missed: str, name: str
) -> DataFrame:
    if submitted not in df.columns or missed not in df.columns:
        return df
    return df.withColumn(
        name, numeric.submission_rate(F.col(submitted), F.col(missed))
    )


def round_whole(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _each(df, columns, numeric.whole)


def round_decimals(
    df: DataFrame, columns: Sequence[str], digits: int = 2
) -> DataFrame:
    return _each(df, columns, lambda c: numeric.half_even(c, digits))
