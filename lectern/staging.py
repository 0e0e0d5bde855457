"""Results that several later steps read are written once to shared storage.

Shared storage is the folder named by ``spark.checkpoint.dir``. A lost executor
then costs a re-read, not a recomputation of everything upstream.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Parts in which ``stage_in_parts`` shuffles its rows at most, and the bytes of stored columns
# that are worth another part.
PARTS = 4
PART_BYTES = 32 << 20


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder: the one that is set, the one the session names, in
    local mode without either a folder in the warehouse."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured:
            context.setCheckpointDir(configured)
        elif context.master.startswith("local"):
            warehouse = spark.conf.get("spark.sql.warehouse.dir")
            context.setCheckpointDir(f"{warehouse.rstrip('/')}/_lectern")
        else:
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder every executor can reach"
            )
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Each action inside deletes its shuffle files when it ends, so that steps that follow
    each other do not hold their shuffles at the same time. For writes, and for frames
    that are collected only once."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet and read it back, so that later passes scan
    only the columns they need."""
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    with released(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_in_parts(
    df: DataFrame,
    keys: Sequence[str],
    step: Callable[[DataFrame], DataFrame],
    store: Callable[[DataFrame], DataFrame] = stage,
) -> DataFrame:
    """``store(step(df))`` for a ``step`` that brings whole rows of equal ``keys`` together and
    looks at no others.

    Shuffled rows take several times the space of columns. So the rows are stored first, in
    PARTS folders by a hash of the keys, which ends the shuffles behind ``df``. Then the
    folders are taken one after the other, as many at a time as hold PART_BYTES, and each
    shuffle ends before the next begins. ``step`` is called for each of them, also for one
    without rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "parts")
    folder = F.pmod(F.xxhash64(*keys), F.lit(PARTS)).cast("int")
    with released(spark):
        df.withColumn("_folder", folder).write.partitionBy("_folder").parquet(path)
    stored = T.StructType([*df.schema, T.StructField("_folder", T.IntegerType())])
    rows = spark.read.schema(stored).parquet(path)
    files, place = _files(spark, path)
    parts = min(PARTS, files.getContentSummary(place).getLength() // PART_BYTES + 1)
    done = [
        store(step(rows.filter(F.col("_folder") % parts == i).drop("_folder"))) for i in range(parts)
    ]
    files.delete(place, True)
    return reduce(DataFrame.unionByName, done)


def _files(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def pin_order(df: DataFrame) -> DataFrame:
    """Store a sorted ``df`` with ``_id``, the partition number above the lower 33 bits and the
    place inside the partition in them: the order is fixed from here on. Columnar files
    take a fraction of a checkpoint's space."""
    return stage(df.withColumn("_id", F.monotonically_increasing_id()))


def drop_staged(spark: SparkSession) -> None:
    """Delete everything this session has staged, checkpointed or scratched. Results that
    still read it are lost."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for entry in files.listStatus(path):
        files.delete(entry.getPath(), True)
