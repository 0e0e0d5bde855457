"""Column handling that the operators share."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.staging import stage


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, ``new name = old name``, matched by exact spelling.

    An extra column whose name differs in case alone (``TEXT`` beside ``text``) or that
    is named like one of an operator's own columns cannot clash: it is not carried.
    """
    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.select(
        *[F.col(f"c{names.index(old)}").alias(new) for new, old in columns.items()]
    )


def extend(df: DataFrame, used: Mapping[str, str], **added) -> DataFrame:
    """All columns of ``df`` and the ``added`` ones.

    ``added`` maps a new name to a function that gets the columns in ``used`` (by their
    keys there) and returns a Column. An input column of a new column's name, in any
    case, gives way to it.
    """
    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    inputs = {key: F.col(f"c{names.index(old)}") for key, old in used.items()}
    taken = {name.lower() for name in added}
    kept = [
        F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n.lower() not in taken
    ]
    return plain.select(*kept, *[make(inputs).alias(n) for n, make in added.items()])


def staged_and_released(df: DataFrame) -> DataFrame:
    """``stage``, after which the shuffle files of the step are deleted at once: large steps
    that follow each other do not hold their shuffles at the same time."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key)
    conf.set(key, "true")
    try:
        return stage(df)
    finally:
        conf.set(key, before)


def text_or_empty(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def once(function):
    """``function``, an Arrow UDF, evaluated once for each row. Spark copies a deterministic
    one into filters that it infers from an explode or pulls below a projection."""
    return function.asNondeterministic()


def byte_texts(array: pa.Array) -> Iterator[bytes]:
    """UTF-8 of each text, one at a time; a null text is empty."""
    for value in array.cast(pa.large_binary()):
        yield value.as_py() or b""


def texts(array: pa.Array) -> Iterator[str]:
    for value in array:
        yield value.as_py() or ""
