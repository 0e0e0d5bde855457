"""Grouped marts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.numeric import all_of, half_up, percent_of, zero_if_null


def mean(column: str | Column, digits: int = 2) -> Column:
    return half_up(F.avg(column), digits)


def total(column: str | Column, digits: int = 2) -> Column:
    return half_up(F.sum(column), digits)


def tally(condition: Column) -> Column:
    """Rows for which the condition holds; NULL counts as no."""
    return F.count_if(condition)


def summarise_distinct(
    df: DataFrame,
    keys: Sequence[str],
    distinct: Mapping[str, str | Column],
    measures: Mapping[str, Column],
) -> DataFrame:
    """``measures`` per key and exact numbers of different values, one pass for each.

    Several distinct counts in one aggregate make Spark repeat every row for each of them
    (Expand). Here each is a distinct and a count of its own over two columns, joined to the
    measures on the key; a hot key's values are spread over all tasks. ``df`` is read once
    for each count and once more, so pass a stored table of the columns that are needed.
    NULL is a key and never a value. Without keys the result is one row.
    """
    summary = df.groupBy(*keys).agg(*[m.alias(n) for n, m in measures.items()])
    for name, value in distinct.items():
        value = F.col(value) if isinstance(value, str) else value
        values = df.select(*keys, value.alias("_value")).filter("_value IS NOT NULL").distinct()
        counts = values.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
            F.count("*").alias(name)
        )
        if keys:
            same = all_of([F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
            summary = (
                summary.join(counts, same, "left")
                .drop(*[f"_{k}" for k in keys])
                .withColumn(name, F.coalesce(name, F.lit(0).cast("long")))
            )
        else:
            summary = summary.withColumn(name, counts.scalar())
    return summary


def gathered(df: DataFrame, key: str) -> DataFrame:
    """The same rows, those of a key in one task or, where they are too many, in several.

    A summary with very many keys holds in each task an entry for every key that the task
    meets; over rows in no order these are nearly all keys. Rows brought together by a hash
    of the key first leave a task its share of them. The hash is a column of its own, so
    that the summary still combines a task's rows before its own shuffle: a hot key's rows,
    which adaptive execution deals to several tasks, meet there as one row per task.
    """
    share = F.xxhash64(key)
    return df.withColumn("_share", share).hint("rebalance", "_share").drop("_share")


def summarise_labelled(
    df: DataFrame,
    key: str,
    labels: Sequence[str],
    rows: str,
    sums: Mapping[str, str] | None = None,
    tallies: Mapping[str, Column] | None = None,
    means: Mapping[str, str] | None = None,
) -> DataFrame:
    """Group by ``key``; ``labels`` are attributes of the key, one value of each
    is kept (the greatest), whatever the number of spellings.

    ``max`` over text in the first aggregate would make Spark sort all input
    rows. Grouping by key and labels first keeps the big pass a hash aggregate
    over fixed-width buffers; the second pass sees one row per spelling.
    """
    sums, tallies, means = dict(sums or {}), dict(tallies or {}), dict(means or {})
    first = df.groupBy(key, *labels).agg(
        F.count("*").alias("_rows"),
        *[F.sum(c).alias(f"_sum_{n}") for n, c in sums.items()],
        *[F.count_if(c).alias(f"_tally_{n}") for n, c in tallies.items()],
        *[F.sum(F.col(c).cast("double")).alias(f"_total_{n}") for n, c in means.items()],
        *[F.count(c).alias(f"_count_{n}") for n, c in means.items()],
    )
    return first.groupBy(key).agg(
        *[F.max(c).alias(c) for c in labels],
        F.sum("_rows").alias(rows),
        *[F.sum(f"_sum_{n}").alias(n) for n in sums],
        *[F.sum(f"_tally_{n}").alias(n) for n in tallies],
        *[
            F.try_divide(F.sum(f"_total_{n}"), F.sum(f"_count_{n}")).alias(n)
            for n in means
        ],
    )


def share_by_label(
    df: DataFrame, label: str, count_name: str, share_name: str
) -> DataFrame:
    """Rows per label and their share in percent, for labels from a closed list
    (risk levels, personas): the total is summed over that handful of groups."""
    counted = df.groupBy(label).agg(F.count("*").alias(count_name))
    everything = F.sum(count_name).over(Window.partitionBy())
    return counted.withColumn(share_name, percent_of(F.col(count_name), everything))


def sum_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """One row of totals over a summary; NULL counts as 0."""
    return df.agg(
        *[F.sum(zero_if_null(F.col(c))).alias(name) for name, c in columns.items()]
    )


def average_columns(
    df: DataFrame, columns: Mapping[str, str], digits: int | None = None
) -> DataFrame:
    """One row of unweighted means over a summary; NULL counts as 0, and so does
    the mean of no rows."""
    out = []
    for name, column in columns.items():
        value = zero_if_null(F.avg(zero_if_null(F.col(column)).cast("double")))
        out.append((value if digits is None else half_up(value, digits)).alias(name))
    return df.agg(*out)


def filter_share(df: DataFrame, condition: Column) -> DataFrame:
    """Matching rows, all rows and the share, in one pass."""
    return df.agg(
        F.count_if(condition).alias("matched_rows"), F.count("*").alias("total_rows")
    ).withColumn("share_pct", percent_of(F.col("matched_rows"), F.col("total_rows")))
