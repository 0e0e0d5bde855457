"""Global positions and ranks without a one-task window.

``Window.orderBy`` with no partition sends every row to one task. Here the rows
are range-partitioned by a sort, which spreads them, and only one counter per
partition is brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.staging import pin_order

# Row ids of a pinned frame: partition number above this bit, row index below.
INDEX_BITS = 33


def _block_starts(blocks: DataFrame, block: str, size: str, *groups: str) -> Column:
    """Rows before a block. One row per partition of a pinned frame reaches this
    window, a number fixed by the shuffle width and not by the data."""
    earlier = (
        Window.partitionBy(*groups)
        .orderBy(block)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return F.coalesce(F.sum(size).over(earlier), F.lit(0))


def number_rows(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """1, 2, 3, … over all rows in ``order``, which must be total."""
    rows = pin_order(df.orderBy(*order)).withColumns(
        {
            "_block": F.shiftright("_id", INDEX_BITS),
            "_index": F.col("_id").bitwiseAND((1 << INDEX_BITS) - 1),
        }
    )
    blocks = rows.groupBy("_block").agg(F.count("*").alias("_size"))
    starts = blocks.select(
        "_block", _block_starts(blocks, "_block", "_size").alias("_start")
    )
    return (
        rows.join(F.broadcast(starts), "_block")
        .withColumn(name, F.col("_start") + F.col("_index") + 1)
        .drop("_id", "_block", "_index", "_start")
    )


def dense_rank_values(df: DataFrame, measure: str, name: str) -> DataFrame:
    """Dense rank of each distinct value of ``measure``, greatest first."""
    values = df.select(measure).distinct()
    return number_rows(values, F.col(measure).desc_nulls_last(), name=name)


def dense_rank(df: DataFrame, measure: str, name: str) -> DataFrame:
    """Dense rank of every row by ``measure``, greatest first; NULL comes last.

    ``df`` is read twice, so pass a stored table. The ranked values join back on
    equality; a value shared by very many rows is split by the adaptive skew
    join, a short list of values is broadcast once its size is known.
    """
    ranks = dense_rank_values(df, measure, name).withColumnRenamed(measure, "_value")
    return df.join(ranks, F.col(measure).eqNullSafe(F.col("_value")), "left").drop(
        "_value"
    )


def dense_rank_counts(df: DataFrame, measure: str, name: str) -> DataFrame:
    """Dense rank by a count that sums to at most N input rows, greatest first.

    d different positive counts sum to at least d(d+1)/2, so at most sqrt(2N)
    values are ranked: about a million for 5e11 rows. That list, not the rows,
    goes through the one-task window. Both uses of ``df`` need the same columns, so
    they share one exchange and the input is read once.
    """
    values = df.select(F.col(measure).alias("_value")).distinct()
    ranks = values.withColumn(
        name, F.dense_rank().over(Window.orderBy(F.col("_value").desc_nulls_last()))
    )
    return df.join(ranks, F.col(measure).eqNullSafe(F.col("_value")), "left").drop(
        "_value"
    )
