"""Arrays of a key's rows, gathered in bounded steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.operators.numbering import number_rows
from lectern.staging import stage

# Rows, and then arrays of rows, that one aggregation step puts together; at least 4, as a key
# may begin and end inside a run.
RUN = 256


def nest(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], item: Column, name: str
) -> DataFrame:
    """One row per key with the array ``name`` of its items, in ``order``, ties by the item.

    A key may hold any part of all rows. The rows are numbered over the whole sorted table, so
    the rows of one key lie in many partitions; runs of RUN neighbours become arrays, then
    runs of arrays, until a key has at most RUN of them. No step gathers more than RUN values
    and none sorts a key's rows; only the finished array is as long as its key. A null key is
    a key of its own; no rows give no rows.
    """
    by = [F.col(o) if isinstance(o, str) else o for o in order]
    wanted = df.select(*keys, *[o.alias(f"_o{i}") for i, o in enumerate(by)], item.alias("_item"))
    placed = [F.col(c).asc_nulls_first() for c in (*keys, *[f"_o{i}" for i in range(len(by))], "_item")]
    numbered = number_rows(wanted, *placed, name="_place")
    most = numbered.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    # Each round of runs is stored, so that no two rounds hold their shuffles at once.
    runs = stage(_gather(numbered.withColumn("_items", F.array("_item")), keys, F.floor(F.col("_place") / RUN)))
    longest = most // RUN + 2
    while longest > RUN:
        runs = stage(_gather(runs, keys, F.floor(F.col("_place") / RUN)))
        longest = longest // RUN + 2
    return _gather(runs, keys).withColumnRenamed("_items", name).drop("_place")


def _gather(runs: DataFrame, keys: Sequence[str], run: Column | None = None) -> DataFrame:
    """The runs of a key, those of equal ``run`` if given, as one."""
    shown = runs.withColumn("_run", F.lit(0) if run is None else run)
    parts = F.array_sort(F.collect_list(F.struct("_place", "_items")))
    joined = shown.groupBy(*keys, "_run").agg(parts.alias("_parts"))
    return joined.select(*keys, F.col("_run").alias("_place"), F.flatten("_parts._items").alias("_items"))
