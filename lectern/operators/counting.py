"""Counts taken by the pass that writes the rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LoadCounts:
    input_rows: int
    valid_rows: int

    @property
    def rejected_rows(self) -> int:
        return self.input_rows - self.valid_rows


def counted_load(df: DataFrame, valid: Column, load: Callable[[DataFrame], None]) -> LoadCounts:
    """Hand the valid rows of ``df`` to ``load`` and return how many were read, kept and
    rejected (NULL counts as rejected).

    ``load`` must write what it is given in one action: the counts are observed in its tasks
    and cost no second read. Tasks that run again after a lost executor may be counted
    again, so a load whose counts decide anything should compare them with what arrived.
    ``df`` should hold only the columns that are needed.
    """
    seen = Observation()
    watched = df.observe(
        seen, F.count("*").alias("input_rows"), F.count_if(valid).alias("valid_rows")
    )
    load(watched.filter(valid))
    return LoadCounts(**seen.get)
