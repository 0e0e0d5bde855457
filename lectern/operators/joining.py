"""Lookups of summaries.

No side is broadcast because it looks small: a summary grows with the number of
courses or students, so that choice is left to sizes measured at run time. What is
broadcast here is a list of heavy keys, which cannot be long (see ``heavy_keys``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.staging import stage

# A key is heavy when it holds more than 1/HEAVY_PARTS of all rows.
HEAVY_PARTS = 1_000
SALTS = 64


def first_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, whole rows compared: the greatest one is kept."""
    rest = [c for c in df.columns if c not in keys]
    distinct = df.distinct()
    return (
        distinct.groupBy(*keys)
        .agg(F.max(F.struct(*rest)).alias("_row"))
        .select(*keys, "_row.*")
    )


def merge_left(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join of two summaries, the key unique on both sides; on a clash of
    names the left side wins."""
    added = [c for c in right.columns if c not in left.columns]
    return left.join(right.select(key, *added), key, "left")


def heavy_keys(summary: DataFrame, key: str, rows: str) -> DataFrame:
    """Keys with more than 1/HEAVY_PARTS of all rows. There are fewer than
    HEAVY_PARTS of them, whatever the data."""
    everything = summary.agg(F.sum(rows)).scalar()
    return summary.filter(F.col(rows) * HEAVY_PARTS > everything).select(key)


def lookup(
    left: DataFrame,
    summary: DataFrame,
    key: str,
    columns: Sequence[str | Column],
    rows: str,
    spread: Sequence[str] = (),
) -> DataFrame:
    """Left join of detail rows with a stored summary that is unique on ``key``.

    ``rows`` names the summary's column with the number of detail rows per key.
    The rows of a heavy key are dealt out over SALTS join keys and its summary row
    is repeated for each of them; all other keys join once. A summary that is an
    aggregate on the join key needs no shuffle of its own, and without one the
    adaptive skew join does not apply, hence the explicit split.

    The salt comes from the ``spread`` columns, which should vary within a key, and
    from the task number, which parts identical copies. A repeated task reads the
    same rows, so a lost executor cannot deal a row out differently. The list of
    heavy keys is read by both sides; it is stored while the plan is built.
    """
    heavy = F.broadcast(
        stage(heavy_keys(summary, key, rows)).withColumn("_heavy", F.lit(True))
    )
    none = F.lit(0)
    # A row without a key matches nothing, so it may go anywhere.
    deal = F.col("_heavy") | F.col(key).isNull()
    salt = F.pmod(F.hash(F.spark_partition_id(), *spread), F.lit(SALTS))
    dealt = left.join(heavy, key, "left").withColumn(
        "_salt", F.when(deal, salt).otherwise(none)
    )
    every = F.when(F.col("_heavy"), F.sequence(none, F.lit(SALTS - 1))).otherwise(
        F.array(none)
    )
    repeated = (
        summary.join(heavy, key, "left")
        .withColumn("_salt", F.explode(every))
        .select(key, "_salt", *columns)
    )
    return dealt.drop("_heavy").join(repeated, [key, "_salt"], "left").drop("_salt")


def lookup_or_zero(
    left: DataFrame,
    summary: DataFrame,
    key: str,
    columns: dict[str, str],
    rows: str,
    spread: Sequence[str] = (),
) -> DataFrame:
    """``lookup`` under new names; 0 where there is no match."""
    measures = [F.col(source).alias(name) for name, source in columns.items()]
    joined = lookup(left, summary, key, measures, rows, spread)
    return joined.withColumns(
        {name: F.coalesce(F.col(name), F.lit(0)) for name in columns}
    )
