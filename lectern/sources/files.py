"""Delimited text, ORC and table scans. A missing path fails when the scan is
built; nothing checks for it beforehand."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern import schema
from lectern.functions.text import null_tokens

# A quote inside a quoted field is doubled, as data-frame libraries write it.
_CSV = {
    "header": True,
    "encoding": "UTF-8",
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def scan_raw_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    na_tokens: Sequence[str] = schema.CSV_NA_TOKENS,
    line_breaks: bool = False,
) -> DataFrame:
    """Delimited text with a header, every column text, in file order; fields
    that spell a missing value become NULL.

    Files are split and read by many tasks. Quoted fields with line breaks in them
    need ``line_breaks``, which reads each file in one task: a single large file then
    has one reader.
    """
    text = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = (
        spark.read.schema(text)
        .options(**_CSV, multiLine=line_breaks)
        .csv(path)
    )
    return df.select(*[null_tokens(F.col(c), na_tokens).alias(c) for c in columns])


def scan_clean_csv(
    spark: SparkSession, path: str, table: T.StructType = schema.ENROLMENT_SCHEMA
) -> DataFrame:
    """Cleaned text with a header and declared types."""
    return (
        spark.read.schema(table)
        .options(**_CSV, dateFormat="yyyy-MM-dd")
        .csv(path)
    )


def scan_positional(
    spark: SparkSession, path: str, table: T.StructType = schema.ODS_SCHEMA
) -> DataFrame:
    """Delimited text bound by position; the header line is skipped, its names
    are not looked at."""
    return spark.read.schema(table).options(**_CSV, enforceSchema=True).csv(path)


def scan_orc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path)


def use_database(spark: SparkSession, name: str) -> None:
    """Create the namespace when it is absent and switch to it."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    spark.sql(f"USE `{name}`")
