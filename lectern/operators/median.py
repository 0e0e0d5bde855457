"""Exact medians of many columns with bounded memory per task.

The built-in ``median`` merges every distinct value of a column in one task. Here
the values are counted by a shuffled aggregate and sorted into partitions, and
only the partition that holds the middle is walked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.operators.numbering import INDEX_BITS
from lectern.staging import pin_order


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(measure, value, n) for every non-NULL value, counted before the shuffle."""
    return (
        df.select(*[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot([], list(columns), "measure", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("measure", "value")
        .agg(F.count("*").alias("n"))
    )


def exact_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(measure, median) per column; a column without values has no row.

    The mean of the two middle values when their number is even.
    """
    counts = pin_order(value_counts(df, columns).orderBy("measure", "value"))
    counts = counts.withColumn("block", F.shiftright("_id", INDEX_BITS)).drop("_id")

    # One row per (measure, partition); the windows below run over these only.
    blocks = counts.groupBy("measure", "block").agg(F.sum("n").alias("size"))
    whole = Window.partitionBy("measure")
    earlier = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    middle = (
        blocks.withColumns(
            {
                "start": F.coalesce(F.sum("size").over(earlier), F.lit(0)),
                "total": F.sum("size").over(whole),
            }
        )
        .withColumns(
            {
                "lower": F.floor((F.col("total") - 1) / 2),
                "upper": F.floor(F.col("total") / 2),
            }
        )
        .filter(
            (F.col("start") <= F.col("upper"))
            & (F.col("start") + F.col("size") > F.col("lower"))
        )
        .select("measure", "block", "start", "lower", "upper")
    )

    # At most two blocks per measure are left, so the broadcast is bounded.
    walk = Window.partitionBy("measure", "block").orderBy("value")
    return (
        counts.join(F.broadcast(middle), ["measure", "block"])
        .withColumn(
            "end",
            F.col("start")
            + F.sum("n").over(walk.rowsBetween(Window.unboundedPreceding, 0)),
        )
        .filter(
            (F.col("end") > F.col("lower"))
            & (F.col("end") - F.col("n") <= F.col("upper"))
        )
        .groupBy("measure")
        .agg(((F.min("value") + F.max("value")) / 2).alias("median"))
    )
