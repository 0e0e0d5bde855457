"""Shards of near-equal bytes by sampled splitters, in DataFrame operations.

Keys are sampled with a probability in proportion to a row's size, so the quantiles of the
sample cut the key space into ranges of near-equal bytes. Each row is put into its range;
a range that turns out overfull is sampled and cut again, until none is. Sums over the
ranges then tell where each shard begins, to the row.

A key is the hash of a row's group, its id and a number that tells repeated rows apart, so
a group of copies lies together but can be cut anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.staging import stage

SHARDS = 24
#: Ranges of the first cut for each shard, and parts that an overfull range is cut into.
RANGES = 8
PARTS = 64
#: Samples for each range that a cut makes, on average.
SAMPLES = 16
#: A range above so many rows is cut again: what one task sorts.
RANGE_ROWS = 1_000_000
#: Rows of a range that cannot be told apart by key are not cut, after so many rounds.
ROUNDS = 12


def _splitters(rows: DataFrame, cuts: int, round_: int) -> DataFrame:
    """``range``, ``bounds``: for each range of ``rows`` that is to be cut, at most ``cuts``
    keys at the quantiles of a sample weighted by size."""
    totals = rows.groupBy("range").agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))
    totals = totals.select(F.struct("range").alias("_r"), "_bytes", "_rows", F.lit(1).alias("_one"))
    # In the first round all rows are one range, so this is one row.
    totals = totals if round_ else F.broadcast(totals)
    u = F.pmod(F.xxhash64("key", F.lit(round_)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    # A range without any bytes is sampled by rows.
    weight, total = (F.when(F.col("_bytes") > 0, F.col(c)).otherwise(F.col(d)) for c, d in (("size", "_one"), ("_bytes", "_rows")))
    chance = weight * F.lit(float(cuts * SAMPLES)) / total
    sampled = (
        rows.withColumn("_r", F.struct("range")).join(totals, "_r").filter(u < chance).select("range", "key")
    )
    # About cuts * SAMPLES keys a range, whatever it holds.
    keys = F.sort_array(F.collect_set("key"))
    at = F.transform(
        F.sequence(F.lit(1), F.lit(cuts)),
        lambda i: F.element_at(F.col("keys"), F.greatest(F.lit(1), F.ceil(i * F.size("keys") / (cuts + 1)).cast("int"))),
    )
    return sampled.groupBy("range").agg(keys.alias("keys")).select("range", F.array_distinct(at).alias("bounds"))


def _cut(rows: DataFrame, cuts: int, round_: int) -> DataFrame:
    """``rows`` with ``range`` extended by the number of the part that a key falls into."""
    bounds = stage(_splitters(rows, cuts, round_))
    bounds = bounds if round_ else F.broadcast(bounds)
    part = F.size(F.filter(F.coalesce("bounds", F.array()), lambda b: b <= F.col("key")))
    return rows.join(bounds, "range", "left").select(
        "key", "size", "row", F.concat("range", F.array(part.cast("int"))).alias("range")
    )


def ranged(rows: DataFrame, shards: int = SHARDS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``rows`` (key, size, row) with ``range``: a path of part numbers in key order. Stored."""
    first = rows.withColumn("range", F.array().cast("array<int>"))
    current = stage(_cut(first, shards * RANGES, 0))
    done, round_ = None, 1
    while True:
        counts = stage(current.groupBy("range").agg(F.count("*").alias("_rows")))
        over = counts.filter(F.col("_rows") > range_rows).select(F.struct("range").alias("_r"))
        if round_ > ROUNDS or over.isEmpty():
            return current if done is None else stage(done.unionByName(current))
        keyed = current.withColumn("_r", F.struct("range"))
        fine = keyed.join(over, "_r", "left_anti").drop("_r")
        done = fine if done is None else done.unionByName(fine)
        current = stage(_cut(keyed.join(over, "_r", "left_semi").drop("_r"), PARTS, round_))
        round_ += 1


def assigned(docs: DataFrame, size: str, group: str, doc_id: str = "doc_id", shards: int = SHARDS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``docs`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (from 0, gapless in a shard).

    Each shard's bytes differ from an equal share by one row's size at most. ``size`` must
    not be null or negative. ``group`` is the column whose equal values lie together; null is
    one group. Repeated rows are told apart by their place in the stored table. Columns of
    these two names give way. No rows: none.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at = {k: f"c{names.index(n)}" for k, n in (("size", size), ("group", group), ("id", doc_id))}
    rows = stage(plain.withColumn("row", F.monotonically_increasing_id()))
    key = F.struct(
        F.xxhash64(F.col(at["group"])).alias("h"), F.col(at["id"]).alias("id"), F.xxhash64("row").alias("s"), F.col("row").alias("r")
    )
    slim = rows.select(key.alias("key"), F.col(at["size"]).cast("long").alias("size"), "row")
    cut = ranged(slim, shards, range_rows)
    placed = stage(_placed(cut, shards))
    kept = [F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n.lower() not in ("shard", "slot")]
    return rows.join(placed, "row").select(*kept, "shard", "slot")


def _placed(cut: DataFrame, shards: int) -> DataFrame:
    """``row``, ``shard``, ``slot``. Running sums go over ranges first, a row for each, then
    over the rows of a range, of which there are few enough for a task."""
    ranges = cut.groupBy("range").agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(
        ranges.select(
            "range",
            F.coalesce(F.sum("_bytes").over(earlier), F.lit(0)).alias("_bytes_before"),
            F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        )
    )
    total = ranges.agg(F.sum("_bytes")).first()[0]
    if not total:
        # Rows without any bytes: all in the first shard, in key order.
        total = 1
    inside = Window.partitionBy("range").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.col("_bytes_before") + F.sum("size").over(inside) - F.col("size") / 2
    shard = F.least(F.lit(shards - 1), F.floor(middle * F.lit(shards) / F.lit(total)).cast("int"))
    rows = cut.join(offsets, "range").select(
        "row",
        shard.alias("shard"),
        (F.col("_rows_before") + F.count("*").over(inside) - 1).alias("_place"),
    )
    rows = stage(rows)
    # One row for each shard.
    starts = rows.groupBy("shard").agg(F.min("_place").alias("_start"))
    return rows.join(F.broadcast(starts), "shard").select(
        "row", "shard", (F.col("_place") - F.col("_start")).alias("slot")
    )


def byte_size(text: Column) -> Column:
    """UTF-8 bytes of a text and 8 more; a null text has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def write_shards(assigned_docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Parquet below ``path``, a folder for each shard, rows in slot order."""
    by_shard = assigned_docs.repartitionByRange(4 * shards, "shard", "slot").sortWithinPartitions("shard", "slot")
    by_shard.write.partitionBy("shard").parquet(path)
