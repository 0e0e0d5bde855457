"""Mixing of sources to target weights by Poisson replication.

Each document is repeated a Poisson-distributed number of times whose mean is its source's
repetition rate. The number is found by inverting the distribution at a uniform number
that a seeded hash gives the document, so any task, or any later run, finds the same. The
copies are shuffled globally by a second hash.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import pick

#: Hash digits that make a uniform number: 13 of base 16 are 52 bits, exact in a double.
_DIGITS = 13
OTHER = "other"
#: The highest rate of one Poisson draw; its first term would vanish at 745.
DRAW_RATE = 500.0
#: Copies are numbered in runs of so many, which bounds the array that a row is unfolded by.
_RUN = 1 << 16


def uniform(seed: str, *keys: Column) -> Column:
    """A number in [0, 1) from the MD5 of the seed and the keys, null as an empty key."""
    joined = F.concat_ws(":", F.lit(seed), *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])
    head = F.conv(F.substring(F.md5(joined), 1, _DIGITS), 16, 10).cast("long")
    return head / F.lit(float(16**_DIGITS))


def source_rates(
    docs: DataFrame, weights: Mapping[str, float], other: float, rows: float | None = None, source: str = "source"
) -> DataFrame:
    """``bucket``, ``n``, ``rate``: repetition rates that bring each source of ``weights`` to
    its share of ``rows`` documents (as many as there are, unless given).

    All other sources, and null, make up the bucket None, whose share is ``other``. A share
    is taken of the weights of the buckets that have documents. At most one row more than
    ``weights`` has; counted over all rows.
    """
    named = F.col("source").isin(list(weights))
    bucket = F.when(named, F.col("source"))
    counts = pick(docs, source=source).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    table = F.create_map(*[F.lit(x) for pair in weights.items() for x in (pair[0], float(pair[1]))]) if weights else None
    weight = F.coalesce(table[F.col("bucket")], F.lit(float(other))) if weights else F.lit(float(other))
    found = [(r["bucket"], r["n"], r["w"]) for r in counts.withColumn("w", weight).collect()]
    total = math.fsum(w for _, _, w in sorted(found, key=lambda r: (r[0] is None, r[0] or "")))
    wanted = sum(n for _, n, _ in found) if rows is None else rows
    rates = [(b, n, w * wanted / (total * n) if total else 0.0) for b, n, w in found]
    return docs.sparkSession.createDataFrame(rates, "bucket string, n long, rate double")


def poisson_steps(rate: float) -> list[float]:
    """The distribution function at 0, 1, 2, … as far as a double tells it from 1.

    For rates up to ``DRAW_RATE``; ``draws`` divides higher ones.
    """
    if not 0 <= rate <= DRAW_RATE:
        raise ValueError(f"a rate of {rate} for one draw")
    term = total = math.exp(-rate)
    steps = [total]
    k = 0
    while total < 1 - 2.0**-52 and (k < rate or term > 2.0**-60):
        k += 1
        term = term * rate / k
        total += term
        steps.append(total)
    return steps


def draws(rate: float) -> int:
    """How many independent Poisson draws of equal rates, at most ``DRAW_RATE``, add up to one
    of ``rate``."""
    return max(1, math.ceil(rate / DRAW_RATE))


def replicated(
    docs: DataFrame, weights: Mapping[str, float], other: float, rows: float | None = None, seed: str = "mix",
    doc_id: str = "doc_id", source: str = "source",
) -> DataFrame:
    """``docs`` with ``copy`` (0, 1, …) and ``order_key``, a row for each copy.

    The sources' distributions are a literal, at most one more than ``weights``, so no row
    is shuffled to learn its rate and a large source is no hot key. Repeated rows have equal
    numbers of copies. A null doc_id hashes as an empty key. Columns of these two names give
    way. No rows: none.

    A rate above ``DRAW_RATE`` is the sum of several draws, each by a hash of its own.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    key, origin = F.col(f"c{names.index(doc_id)}"), F.col(f"c{names.index(source)}")
    rates = source_rates(docs, weights, other, rows, source).collect()
    parts = {r["bucket"]: draws(r["rate"]) for r in rates}
    steps = {r["bucket"]: poisson_steps(r["rate"] / parts[r["bucket"]]) for r in rates}

    def count(bucket: str | None) -> Column:
        # As many copies as there are steps that u has reached.
        table = F.array(*map(F.lit, steps[bucket]))

        def reached(u: Column) -> Column:
            return F.size(F.filter(table, lambda s: s <= u))

        if parts[bucket] == 1:
            return reached(uniform(f"{seed}/copies", key))
        each = F.sequence(F.lit(0), F.lit(parts[bucket] - 1))
        return F.aggregate(each, F.lit(0), lambda n, i: n + reached(uniform(f"{seed}/copies", key, i)))

    number = count(None) if None in steps else F.lit(0)
    for bucket in sorted(b for b in steps if b is not None):
        number = F.when(origin == bucket, count(bucket)).otherwise(number)
    kept = [F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n.lower() not in ("copy", "order_key")]
    copies = plain.withColumn("_n", number).filter("_n > 0")
    last = F.col("_n") - 1
    runs = copies.withColumn("_run", F.explode(F.sequence(F.lit(0), F.expr(f"cast((_n - 1) div {_RUN} as int)"))))
    run = F.sequence(F.col("_run") * _RUN, F.least(last, F.col("_run") * _RUN + (_RUN - 1)))
    return runs.withColumn("_copy", F.explode(run)).select(
        *kept, F.col("_copy").alias("copy"), F.md5(F.concat_ws(":", F.lit(f"{seed}/order"), F.coalesce(key.cast("string"), F.lit("")), F.col("_copy"))).alias("order_key")
    )


def mixed(docs: DataFrame, weights: Mapping[str, float], other: float, **options) -> DataFrame:
    """``replicated`` rows in their shuffled order: range-partitioned and sorted by the hash.

    Rows of one id are told apart by a hash of their other columns, so the order is the same
    in every run; rows that are equal in all columns are alike. Maps, which have no order of their
    own, are left out of that hash.
    """
    copies = replicated(docs, weights, other, **options)
    names = copies.columns
    plain = copies.toDF(*[f"c{i}" for i in range(len(names))])
    column = {name: f"c{i}" for i, name in enumerate(names)}
    hashable = [f.name for f in plain.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    first = [column[n] for n in ("order_key", options.get("doc_id", "doc_id"), "copy")]
    return plain.orderBy(*first, F.xxhash64(*hashable)).toDF(*names)
