"""Load served tables into their target, one after the other.

The target is described by two functions, so the same loop serves a database and
a folder of files.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern import schema
from lectern.operators import gates
from lectern.sinks import swap
from lectern.sinks.jdbc import write_replace
from lectern.sources.files import scan_orc
from lectern.sources.jdbc import JdbcTarget, jdbc_count
from lectern.staging import released


@dataclass(frozen=True)
class SyncTask:
    path: str
    table: str


@dataclass(frozen=True)
class SyncResult:
    table: str
    source_rows: int
    target_rows: int


@dataclass(frozen=True)
class SyncTarget:
    """``count`` tells the rows that ``write`` brought. A target that can keep its old rows
    until then has ``settle``: called with the table and whether the count was right, it
    puts the new rows in place or drops them."""

    write: Callable[[DataFrame, str], None]
    count: Callable[[str], int]
    settle: Callable[[str, bool], None] = lambda table, right: None


def sync_table(spark: SparkSession, task: SyncTask, target: SyncTarget) -> SyncResult:
    """Scan, check columns, types and rows in one pass, check the key, write, compare counts,
    settle."""
    columns = schema.TARGETS[task.table]
    names = [name for name, _ in columns]
    source = gates.conform_columns(scan_orc(spark, task.path), names, task.table)
    checked = gates.load_counts(
        source, columns, schema.TARGET_NOT_NULL[task.table]
    ).first()
    if checked["rows"] == 0:
        raise ValueError(f"{task.table}: no rows in {task.path}")
    if checked["misfits"] or checked["nulls"]:
        raise ValueError(
            f"{task.table}: {checked['misfits']} rows do not fit the declared types, "
            f"{checked['nulls']} rows lack a required value"
        )
    keys = schema.TARGET_KEYS[task.table]
    repeated = gates.key_violations(source, keys).agg(F.count("*").alias("n")).first()["n"]
    if repeated:
        raise ValueError(f"{task.table}: {repeated} keys {keys} occur more than once")
    target.write(
        gates.conform_types(source, columns, schema.TARGET_NULLABLE[task.table]),
        task.table,
    )
    landed = target.count(task.table)
    target.settle(task.table, landed == checked["rows"])
    if landed != checked["rows"]:
        raise ValueError(
            f"{task.table}: {checked['rows']} rows read, {landed} rows in the target"
        )
    return SyncResult(task.table, checked["rows"], landed)


def sync_tables(
    spark: SparkSession, tasks: Iterable[SyncTask], target: SyncTarget
) -> list[SyncResult]:
    """All tasks in order; the first failure stops the run."""
    with released(spark):
        return [sync_table(spark, task, target) for task in tasks]


def jdbc_target(spark: SparkSession, connection: JdbcTarget) -> SyncTarget:
    return SyncTarget(
        write=lambda df, table: write_replace(df, connection, table),
        count=lambda table: jdbc_count(spark, connection, table).first()["row_count"],
    )


def folder_target(spark: SparkSession, folder: str) -> SyncTarget:
    """One Parquet directory per table. Rows arrive beside the old ones and take their place
    once the count is right."""
    arriving: dict[str, str] = {}

    def write(df: DataFrame, table: str) -> None:
        arriving[table] = swap.incoming(f"{folder}/{table}")
        df.write.parquet(arriving[table])

    def settle(table: str, right: bool) -> None:
        fresh = arriving.pop(table)
        if right:
            swap.swap(spark, fresh, f"{folder}/{table}")
        else:
            swap.discard(spark, fresh)

    return SyncTarget(write, lambda table: spark.read.parquet(arriving[table]).count(), settle)
