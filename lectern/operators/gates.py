"""Checks on the way into and out of a layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.numeric import any_of


def conform_columns(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """The target's columns in the target's order; fails when one is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(
            f"{table}: columns {missing} are missing, found {df.columns}"
        )
    return df.select(*columns)


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("row_count"))
        .filter(F.col("row_count") > 1)
    )


def _is_number(kind: str) -> bool:
    return kind.startswith(("decimal", "int", "bigint", "tinyint"))


def conform_types(
    df: DataFrame, target: Sequence[tuple[str, str]], nullable: Sequence[str] = ()
) -> DataFrame:
    """Target columns with their declared types. A measure that is NULL or does
    not fit becomes 0, unless it is nullable; see ``overflow_counts``."""
    out: list[Column] = []
    for name, kind in target:
        value = F.col(name).try_cast(kind)
        if _is_number(kind) and name not in nullable:
            value = F.coalesce(value, F.lit(0).cast(kind))
        out.append(value.alias(name))
    return df.select(*out)


def _overflow(name: str, kind: str) -> Column:
    return F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()


def overflow_counts(df: DataFrame, target: Sequence[tuple[str, str]]) -> DataFrame:
    """One row: per numeric target column, the values that do not fit its type."""
    return df.agg(
        *[
            F.count_if(_overflow(name, kind)).alias(name)
            for name, kind in target
            if _is_number(kind)
        ]
    )


def load_counts(
    df: DataFrame, target: Sequence[tuple[str, str]], not_null: Sequence[str]
) -> DataFrame:
    """One row, one pass: rows, rows with a value that does not fit, rows with a
    NULL where none is allowed."""
    misfits = [_overflow(name, kind) for name, kind in target if _is_number(kind)]
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(any_of(misfits or [F.lit(False)])).alias("misfits"),
        F.count_if(any_of([F.col(c).isNull() for c in not_null])).alias("nulls"),
    )


def require_rows(df: DataFrame, table: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{table}: no rows")
    return df


def quality_counts(df: DataFrame, valid: Column) -> DataFrame:
    """Input, valid and rejected rows in one pass; NULL counts as rejected."""
    return df.agg(
        F.count("*").alias("input_rows"), F.count_if(valid).alias("valid_rows")
    ).withColumn("rejected_rows", F.col("input_rows") - F.col("valid_rows"))


def reconcile_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """Rows on both sides and whether they agree."""
    return (
        source.agg(F.count("*").alias("source_rows"))
        .withColumn(
            "target_rows", target.agg(F.count("*").alias("n")).scalar()
        )
        .withColumn("matched", F.col("source_rows") == F.col("target_rows"))
    )
