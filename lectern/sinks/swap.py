"""Replace a folder only after its new rows have been checked.

The new rows are written beside the old ones, checked there and moved into place by two
renames. The old rows stay until then, whatever fails before. On a file system whose
renames are not atomic (an object store), ``recover`` puts them back after a crash between
the two.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _files(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _neighbour(path: str, kind: str) -> str:
    """A name beside ``path`` that readers of the parent folder pass over."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/_{name}.{kind}"


def incoming(path: str) -> str:
    """A fresh place beside ``path``."""
    return _neighbour(path, f"incoming-{uuid.uuid4().hex}")


def discard(spark: SparkSession, fresh: str) -> None:
    files, place = _files(spark, fresh)
    files.delete(place, True)


def recover(spark: SparkSession, path: str) -> None:
    """Put the old rows back if a swap ended between its two renames."""
    files, target = _files(spark, path)
    _, old = _files(spark, _neighbour(path, "replaced"))
    if not files.exists(target) and files.exists(old):
        files.rename(old, target)


def swap(spark: SparkSession, fresh: str, path: str) -> None:
    """Move ``fresh`` to ``path``; what was there is deleted afterwards."""
    recover(spark, path)
    files, target = _files(spark, path)
    _, new = _files(spark, fresh)
    _, old = _files(spark, _neighbour(path, "replaced"))
    files.delete(old, True)
    if files.exists(target) and not files.rename(target, old):
        raise OSError(f"{path}: the old rows could not be moved")
    if not files.rename(new, target):
        recover(spark, path)
        raise OSError(f"{path}: the new rows could not be moved in")
    files.delete(old, True)


def replace_checked(
    df: DataFrame,
    path: str,
    write: Callable[[DataFrame, str], None],
    accept: Callable[[str], bool],
) -> None:
    """Write ``df`` beside ``path`` and replace it if ``accept`` says so of the new place; else
    nothing is left behind and a ValueError is raised."""
    spark = df.sparkSession
    fresh = incoming(path)
    try:
        write(df, fresh)
        accepted = accept(fresh)
    except BaseException:
        discard(spark, fresh)
        raise
    if not accepted:
        discard(spark, fresh)
        raise ValueError(f"{path}: the new rows were not accepted, the old ones stay")
    swap(spark, fresh, path)
