"""Database writers, as options of Spark's own JDBC writer."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lectern.sources.jdbc import JdbcTarget


def overwrite_options(
    target: JdbcTarget, table: str, connections: int, batch: int = 1000
) -> dict[str, str]:
    """The table is dropped and created again. ``connections`` limits the
    writers; Spark coalesces to it only when there are more partitions."""
    return {
        **target.options(),
        "dbtable": table,
        "batchsize": str(batch),
        "numPartitions": str(connections),
    }


def replace_options(
    target: JdbcTarget, table: str, connections: int, batch: int = 1000
) -> dict[str, str]:
    """The rows are replaced, the table with its keys stays."""
    return {
        **overwrite_options(target, table, connections, batch),
        "truncate": "true",
        "isolationLevel": "READ_COMMITTED",
    }


def write_overwrite(
    df: DataFrame, target: JdbcTarget, table: str, connections: int = 2
) -> None:
    options = overwrite_options(target, table, connections)
    df.write.format("jdbc").options(**options).mode("overwrite").save()


def write_replace(
    df: DataFrame, target: JdbcTarget, table: str, connections: int = 4
) -> None:
    options = replace_options(target, table, connections)
    df.write.format("jdbc").options(**options).mode("overwrite").save()
