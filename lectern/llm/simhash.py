"""SimHash fingerprints and near-duplicate classes by bit-sliced comparison.

Fingerprints that differ in at most r bits agree in at least two of r + 2 blocks of bits,
so each distinct fingerprint is put into one bucket for each pair of blocks (r = 2: 6
buckets, keyed by 32 bits). Within buckets, the fingerprints are turned into bit planes,
packed integers that hold one bit of every fingerprint, and the distances of very many
pairs are counted at once with carry-save counters.

A bucket may hold very many fingerprints that are alike. One above ``BUCKET_ROWS`` is not
compared as it is: its fingerprints agree in 32 bits, so the same rule is applied to the
other 32, then to the last 16. What is left agrees in 56 bits and has at most 256
members, so no task gets an unbounded bucket and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import byte_texts, extend, once, pick
from lectern.llm.components import connected_components
from lectern.staging import stage

BITS = 64
#: The rows of a bucket that one task compares; larger buckets are divided by more bits.
BUCKET_ROWS = 4096
_HASH_BLOCK = 1 << 16


def fingerprint(text: bytes, words: int = 3) -> int:
    """64 bits: bit i is 1 if set in over half of the shingles' hashes, repeats included.

    A-Z is lower-cased and words are what stands between the characters 9-13 and 32,
    which is what ``bytes.lower`` and ``bytes.split`` do. Fewer words than a shingle has:
    the whole sequence is one shingle. No word: 0.
    """
    found = text.lower().split()
    if not found:
        return 0
    n = max(1, len(found) - words + 1)
    ones = np.zeros(BITS, np.int64)
    for hashes in shingle_hashes(found, words):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > n, bitorder="little")
    return int(packed.view("<u8")[0])


def shingle_hashes(found: list[bytes], words: int) -> Iterator[np.ndarray]:
    """The hashes of a text's shingles in order, in blocks; ``found`` has a word at least."""
    n = max(1, len(found) - words + 1)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for start in range(0, n, _HASH_BLOCK):
        stop = min(n, start + _HASH_BLOCK)
        runs = zip(*[found[start + i : stop + i] for i in range(min(words, len(found)))])
        yield np.fromiter((digest(join(run), 42) for run in runs), np.uint64, stop - start)


def with_fingerprint(
    df: DataFrame, text: str = "text", name: str = "fingerprint", words: int = 3
) -> DataFrame:
    """``df`` and the fingerprint of each whole text as a signed long; null text: 0."""

    @once
    @F.arrow_udf("long")
    def simhash(column: pa.Array) -> pa.Array:
        values = [fingerprint(t, words) for t in byte_texts(column)]
        return pa.array(np.array(values, np.uint64).view(np.int64))

    return extend(df, {"text": text}, **{name: lambda c: simhash(c["text"])})


def _planes(fps: np.ndarray) -> list[int]:
    """Bit plane p: an integer whose bit i is bit p of fingerprint i."""
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8), bitorder="little")
    packed = np.packbits(bits.reshape(-1, BITS), axis=0, bitorder="little")
    return [int.from_bytes(packed[:, p].tobytes(), "little") for p in range(BITS)]


def _ones(plane: int, n: int) -> np.ndarray:
    raw = np.frombuffer(plane.to_bytes((n + 7) // 8, "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(raw, bitorder="little")[:n])


def sliced_pairs(fps: np.ndarray, group: np.ndarray, radius: int) -> Iterator[np.ndarray]:
    """Index pairs of a group whose fingerprints differ in at most ``radius`` bits.

    Row i is compared with row i + lag, for all i at once. ``alive`` holds the pairs
    still within the radius; counters[b] holds bit b of every pair's distance. A plane's
    differences are added by rippling carries, and the lag is left as soon as no pair is
    alive.
    """
    n = len(fps)
    planes = _planes(fps)
    counter_bits = (radius + 1).bit_length()
    lag = 1
    while lag < n:
        same = np.packbits(group[:-lag] == group[lag:], bitorder="little").tobytes()
        alive = int.from_bytes(same, "little")
        if not alive:
            return
        counters = [0] * counter_bits
        for plane in planes:
            carry = (plane ^ (plane >> lag)) & alive
            exceeded = alive
            for b in range(counter_bits):
                counters[b], carry = counters[b] ^ carry, counters[b] & carry
                wanted = (radius + 1) >> b & 1
                exceeded &= counters[b] if wanted else exceeded ^ (exceeded & counters[b])
            alive ^= alive & exceeded
            if not alive:
                break
        if alive:
            first = _ones(alive, n)
            yield np.stack([first, first + lag])
        lag += 1


def _forest(pairs: Iterator[np.ndarray], n: int) -> list[tuple[int, int]]:
    """The pairs that join two trees; they connect all that the pairs connect."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    kept = []
    for block in pairs:
        for i, j in block.T.tolist():
            x, y = find(i), find(j)
            if x != y:
                root[y] = x
                kept.append((i, j))
    return kept


def _compare(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links within the buckets of a task, whose rows come sorted by bucket."""
    part, value, fp = (np.zeros(0, np.int64) for _ in range(3))

    def links(part: np.ndarray, value: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        new = np.r_[True, (part[1:] != part[:-1]) | (value[1:] != value[:-1])]
        group = np.cumsum(new) - 1
        sizes = np.bincount(group)
        found = []
        # Buckets of like size together: a lag then fits all or most of them.
        scale = np.ceil(np.log2(sizes)).astype(int)[group]
        for k in np.unique(scale[scale > 0]):
            rows = np.flatnonzero(scale == k)
            fps = fp[rows].view(np.uint64)
            forest = _forest(sliced_pairs(fps, group[rows], radius), len(rows))
            found += [(fp[rows[i]], fp[rows[j]]) for i, j in forest]
        a, b = zip(*found) if found else ((), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
        )

    for batch in batches:
        columns = [batch.column(name).to_numpy() for name in ("part", "value", "fp")]
        part, value, fp = (np.r_[x, y] for x, y in zip((part, value, fp), columns))
        if not len(part):
            continue
        last = int(np.argmax((part == part[-1]) & (value == value[-1])))
        if last:
            yield links(part[:last], value[:last], fp[:last])
            part, value, fp = part[last:], value[last:], fp[last:]
    if len(part):
        yield links(part, value, fp)


def _divide(free: list[int], radius: int) -> list[int]:
    """Masks over the bits in ``free``: two of radius + 2 blocks each."""
    blocks = [sum(1 << int(b) for b in block) for block in np.array_split(free, radius + 2)]
    return [x | y for x, y in combinations(blocks, 2)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def linked_fingerprints(fps: DataFrame, radius: int = 2) -> DataFrame:
    """Edges ``a``, ``b`` between fingerprints of ``fps`` (one column ``fp``, distinct)
    at most ``radius`` bits apart, as many as connect whatever is so linked."""
    masks = _divide(list(range(BITS)), radius)
    parts = F.array(*[F.lit(p) for p in range(len(masks))])
    rows = fps.select("fp", F.explode(parts).alias("part"))
    found, levels = None, 0
    while True:
        table = F.array(*[F.lit(_signed(m)) for m in masks])
        rows = rows.withColumn("value", F.col("fp").bitwiseAND(table[F.col("part")]))
        counts = rows.groupBy("part", "value").agg(F.count("*").alias("rows"))
        counts = counts.filter("rows > 1").select(
            F.struct("part", "value").alias("bucket"), "rows"
        )
        keyed = rows.withColumn("bucket", F.struct("part", "value"))
        sized = stage(keyed.join(counts, "bucket").select("part", "value", "fp", "rows"))
        levels += 1
        # The third level leaves buckets of 2 ** 8 fingerprints at most (radius 2).
        small = sized if levels == 3 else sized.filter(F.col("rows") <= BUCKET_ROWS)
        links = (
            small.select("part", "value", "fp")
            .repartition("part", "value")
            .sortWithinPartitions("part", "value", "fp")
            .mapInArrow(lambda batches: _compare(batches, radius), "a long, b long")
        )
        found = links if found is None else found.unionByName(links)
        large = sized.filter(F.col("rows") > BUCKET_ROWS)
        if levels == 3 or large.isEmpty():
            return found
        finer = [
            [m | more for more in _divide([b for b in range(BITS) if not m >> b & 1], radius)]
            for m in masks
        ]
        width = len(finer[0])
        masks = [m for row in finer for m in row]
        children = F.sequence(F.lit(0), F.lit(width - 1))
        rows = large.select("fp", "part", F.explode(children).alias("child")).select(
            "fp", (F.col("part") * width + F.col("child")).alias("part")
        )


def near_duplicate_classes(
    docs: DataFrame, doc_id: str = "doc_id", fingerprint: str = "fp", radius: int = 2
) -> DataFrame:
    """``fp``, ``class`` (the least fingerprint reachable over links) and ``component_id``
    (the smallest id reachable) for each distinct fingerprint of ``docs``, which should be
    stored.

    A null id is passed over; a class of null ids only has a null component_id.
    """
    slim = pick(docs, doc_id=doc_id, fp=fingerprint)
    fps = stage(slim.groupBy("fp").agg(F.min("doc_id").alias("first")))
    links = linked_fingerprints(fps.select("fp"), radius)
    nodes = stage(connected_components(links))
    firsts = nodes.join(fps, nodes["node"] == fps["fp"]).select("node", "component", "first")
    least = firsts.groupBy("component").agg(F.min("first").alias("least"))
    least = least.select(F.struct(F.col("component").alias("c")).alias("_c"), "least")
    labels = (
        nodes.withColumn("_c", F.struct(F.col("component").alias("c")))
        .join(least, "_c")
        .select(F.col("node").alias("fp"), "component", "least")
    )
    return fps.join(labels, "fp", "left").select(
        "fp",
        F.coalesce("component", "fp").alias("class"),
        F.when(F.col("component").isNull(), F.col("first"))
        .otherwise(F.col("least"))
        .alias("component_id"),
    )


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 2, words: int = 3
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for each row of ``docs``.

    Exact copies share a fingerprint, which enters the comparison once. A null text
    counts as empty; empty texts have the fingerprint 0, linked like any other. Repeated
    rows stay. No rows: none.
    """
    slim = pick(docs, doc_id=doc_id, text=text)
    rows = stage(with_fingerprint(slim, "text", "fp", words).drop("text"))
    classes = stage(near_duplicate_classes(rows, radius=radius))
    return rows.join(classes, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one_of_each(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 2, words: int = 3
) -> DataFrame:
    """The rows of ``docs`` that stand for their class: the one of the smallest id.

    Among rows of equal id, or none, the first in storage order stays. The columns are
    those of ``docs``.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at = {n: f"c{names.index(n)}" for n in (doc_id, text)}
    marked = with_fingerprint(plain, at[text], "fp", words).withColumn(
        "row", F.monotonically_increasing_id()
    )
    rows = stage(marked)
    classes = stage(near_duplicate_classes(rows, doc_id=at[doc_id], radius=radius))
    slim = rows.select("fp", "row", F.col(at[doc_id]).alias("doc_id"))
    first = (
        slim.join(classes, "fp")
        .groupBy("class")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row")).alias("x"))
        .select(F.col("x.row").alias("row"))
    )
    kept = rows.join(first, "row", "left_semi").drop("fp", "row")
    return kept.toDF(*names)
