"""One document of each class of near copies: five-word shingles, similarity 0.8 or more.

A distinct sequence of words is a node. Its SimHash fingerprint would have to be searched
within ``RADIUS`` bits, too wide for blocks of bits to be selective, so buckets are made of
MinHash bands instead: a pair of similarity 0.8 agrees in one of ``BANDS`` bands of
``BAND_ROWS`` with probability 1 - (1 - 0.8 ** 2) ** 8 = 0.9997. Nodes come to their buckets
with the hashes of their shingles. The bit-sliced search finds the pairs inside the radius,
and each of them that is not yet connected is measured by the exact Jaccard similarity
there and then; trees grow by measured pairs only, so a bucket hands on at most one link
for each of its nodes and loses none.

A bucket above ``BUCKET_ROWS`` is first measured against one of its nodes, the anchor. Nodes
similar to it are connected through it and need no comparison among themselves, however many
they are. The others are dealt out in blocks, and each two blocks, and each of them with each
block of the anchor's nodes, meet in one unit of work of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import byte_texts, once
from lectern.llm.components import connected_components
from lectern.llm.simhash import fingerprint, shingle_hashes, sliced_pairs
from lectern.staging import stage

WORDS = 5
SIMILARITY = 0.8
#: Bits between fingerprints; at 0.8 about 10 of 64 differ, with a deviation of 3.
RADIUS = 24
BANDS = 8
BAND_ROWS = 2
#: Nodes of a bucket, and hashes of their shingles, that one unit of work compares.
BUCKET_ROWS = 4096
BUCKET_SHINGLES = 8_000_000
SALTS = 64
#: Pairs that are measured at once.
MEASURED = 1 << 20

_RNG = np.random.default_rng(42)
_XOR = _RNG.integers(0, 2**64, BANDS * BAND_ROWS, np.uint64)
_ODD = _RNG.integers(0, 2**64, BANDS * BAND_ROWS, np.uint64) | np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _split(text: bytes) -> list[bytes]:
    return text.lower().split()


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """The distinct hashes of a text's shingles, sorted; without a word: none."""
    found = _split(text)
    return np.unique(np.concatenate([*shingle_hashes(found, words)])) if found else np.zeros(0, np.uint64)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sets of hashes; of two empty ones 1."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    total = len(a) + len(b) - common
    return common / total if total else 1.0


def bands(found: np.ndarray) -> np.ndarray:
    """A number for each band of a set of hashes."""
    if not len(found):
        return np.zeros(BANDS, np.uint64)
    least = np.array([((found ^ x) * m).min() for x, m in zip(_XOR, _ODD)], np.uint64).reshape(BANDS, BAND_ROWS)
    value = np.zeros(BANDS, np.uint64)
    for row in least.T:
        value = (value ^ row) * _MIX
        value ^= value >> np.uint64(29)
    return value


def _links(
    group: np.ndarray, side: np.ndarray, fp: np.ndarray, sets: list[np.ndarray], radius: int, similarity: float
) -> list[tuple[int, int]]:
    """Index pairs of a group that are similar, as many as connect whatever is so connected.

    ``side`` 0 is compared with every row of its group, another side only with other sides.
    """
    scale = np.ceil(np.log2(np.bincount(group))).astype(int)[group]
    kept: list[tuple[int, int]] = []
    # Buckets of like size together: a lag then fits all or most of them.
    for k in np.unique(scale[scale > 0]):
        rows = np.flatnonzero(scale == k)
        size = np.array([len(sets[r]) for r in rows])
        ids = np.split(np.unique(np.concatenate([sets[r] for r in rows]), return_inverse=True)[1], np.cumsum(size)[:-1])
        marked = np.zeros(max((int(x.max()) for x in ids if len(x)), default=0) + 1, bool)
        own, mine = group[rows], side[rows]
        root = np.arange(len(rows))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        def measure(i_all: np.ndarray, j_all: np.ndarray) -> None:
            while (root[root] != root).any():
                root[:] = root[root]
            low, high = np.minimum(size[i_all], size[j_all]), np.maximum(size[i_all], size[j_all])
            open_ = (root[i_all] != root[j_all]) & (low >= similarity * high * (1 - 1e-9)) & (low > 0)
            i_all, j_all = i_all[open_], j_all[open_]
            order = np.argsort(i_all, kind="stable")
            firsts, starts = np.unique(i_all[order], return_index=True)
            for i, others in zip(firsts.tolist(), np.split(j_all[order], starts[1:])):
                marked[ids[i]] = True
                seen = marked[np.concatenate([ids[j] for j in others])]
                common = np.add.reduceat(seen.astype(np.int64), np.r_[0, np.cumsum(size[others])[:-1]])
                marked[ids[i]] = False
                for j in others[common / (size[i] + size[others] - common) >= similarity].tolist():
                    x, y = find(i), find(j)
                    if x != y:
                        root[max(x, y)] = min(x, y)
                        kept.append((int(rows[i]), int(rows[j])))

        n_groups, waiting, n_waiting, limit = len(np.unique(own)), [], 0, len(rows)
        for i_all, j_all in sliced_pairs(fp[rows].view(np.uint64), own, radius):
            apart = (mine[i_all] != mine[j_all]) | (mine[i_all] == 0)
            waiting.append(np.stack([i_all[apart], j_all[apart]]))
            n_waiting += int(apart.sum())
            if n_waiting >= limit:
                measure(*np.concatenate(waiting, axis=1))
                waiting, n_waiting, limit = [], 0, min(2 * limit, MEASURED)
                if (root == np.arange(len(rows))).sum() == n_groups:
                    break
        if n_waiting:
            measure(*np.concatenate(waiting, axis=1))
    return kept


def _compare(batches: Iterator[pa.RecordBatch], radius: int, similarity: float) -> Iterator[pa.RecordBatch]:
    """Links within the units of a task, whose rows come sorted by unit."""
    held = [np.zeros(0, np.int64) for _ in range(4)]
    sets: list[np.ndarray] = []

    def batch_of(unit: np.ndarray, side: np.ndarray, node: np.ndarray, fp: np.ndarray, sets: list) -> pa.RecordBatch:
        group = np.cumsum(np.r_[True, unit[1:] != unit[:-1]]) - 1
        pairs = [sorted((int(node[i]), int(node[j]))) for i, j in _links(group, side, fp, sets, radius, similarity)]
        a, b = zip(*pairs) if pairs else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    for batch in batches:
        held = [np.r_[x, batch.column(c).to_numpy()] for x, c in zip(held, ("unit", "side", "node", "fp"))]
        sets += [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("shingles")]
        if not len(sets):
            continue
        last = int(np.argmax(held[0] == held[0][-1]))
        if last:
            yield batch_of(*[x[:last] for x in held], sets[:last])
            held, sets = [x[last:] for x in held], sets[last:]
    if len(sets):
        yield batch_of(*held, sets)


def _similar_to(similarity: float):
    @once
    @F.arrow_udf("boolean")
    def alike(first: pa.Array, second: pa.Array) -> pa.Array:
        pairs = zip(first, second)
        found = [jaccard(*[np.frombuffer(x.as_buffer(), np.uint64) for x in pair]) >= similarity for pair in pairs]
        return pa.array(found, pa.bool_())

    return alike


def _blocks(rows: str, size: str) -> Column:
    """Blocks of half a unit that so many rows with so many shingles fill."""
    return F.ceil(F.greatest(F.col(rows) * 2 / BUCKET_ROWS, F.col(size) * 2 / BUCKET_SHINGLES)).cast("long")


def shared_buckets(nodes: DataFrame) -> DataFrame:
    """node, fp, size, bucket, large and anchor for each bucket of two or more of ``nodes`` (stored;
    node, fp, size, bands)."""
    spread = nodes.select("node", "fp", "size", F.posexplode("bands").alias("part", "value"))
    keyed = spread.select("node", "fp", "size", F.struct("part", "value").alias("bucket"))
    sized = keyed.groupBy("bucket").agg(
        F.count("*").alias("rows"), F.sum("size").alias("shingles"), F.min("node").alias("anchor")
    )
    large = (F.col("rows") > BUCKET_ROWS) | (F.col("shingles") > BUCKET_SHINGLES)
    sized = sized.filter("rows > 1").select("bucket", large.alias("large"), "anchor")
    return keyed.join(sized, "bucket")


def similar_links(
    buckets: DataFrame, sets: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS
) -> DataFrame:
    """Links ``a``, ``b`` that connect what is similar within ``buckets`` (stored). ``sets`` (stored)
    has the node and the ``shingles`` of every node in them."""
    none = F.lit(0).cast("long")
    small = buckets.filter("not large").select("node", "fp", F.xxhash64("bucket").alias("unit"), none.alias("side"))
    crowded = buckets.filter("large")
    units, stars = small, None
    if not crowded.isEmpty():
        # An anchor may stand for a third of all rows: its shingles go to every salt.
        anchors = crowded.select("anchor").distinct().join(sets.toDF("anchor", "aim"), "anchor")
        anchors = anchors.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = crowded.withColumn("salt", F.pmod(F.hash("node"), F.lit(SALTS)))
        both = salted.join(sets, "node").join(anchors, ["anchor", "salt"])
        near = _similar_to(similarity)("shingles", "aim").alias("near")
        crowded = stage(both.select("bucket", "node", "fp", "size", "anchor", near))
        stars = crowded.filter("near and node <> anchor").select(F.col("anchor").alias("a"), F.col("node").alias("b"))
        far, close = F.col("near") == F.lit(False), F.col("near")
        sums = crowded.groupBy("bucket").agg(
            F.sum(far.cast("long")).alias("far_rows"), F.sum(F.when(far, F.col("size")).otherwise(0)).alias("far_size"),
            F.sum(close.cast("long")).alias("near_rows"), F.sum(F.when(close, F.col("size")).otherwise(0)).alias("near_size"),
        )
        blocks = sums.select("bucket", _blocks("far_rows", "far_size").alias("far"), _blocks("near_rows", "near_size").alias("beside"))
        # A bucket that lies around its anchor as a whole has nothing left to compare.
        dealt = crowded.join(blocks.filter("far > 0"), "bucket").withColumn(
            "block",
            F.when(F.col("near"), F.col("far") + F.pmod(F.xxhash64("node", "bucket"), F.col("beside"))).otherwise(
                F.pmod(F.xxhash64("node", "bucket"), F.col("far"))
            ),
        )
        reach = F.sequence(none, F.when(F.col("near"), F.col("far")).otherwise(F.col("far") + F.col("beside")) - 1)
        met = dealt.select("node", "fp", "bucket", "block", F.explode(reach).alias("other"))
        units = small.unionByName(
            met.select(
                "node", "fp", F.xxhash64("bucket", F.least("block", "other"), F.greatest("block", "other")).alias("unit"),
                F.when(F.col("block") == F.col("other"), 0).otherwise(F.col("block") + 1).alias("side"),
            )
        )
    pairs = (
        units.join(sets, "node")
        .select("unit", F.col("side").cast("long").alias("side"), "node", "fp", "shingles")
        .repartition("unit")
        .sortWithinPartitions("unit", "fp", "node")
        .mapInArrow(lambda batches: _compare(batches, radius, similarity), "a long, b long")
    )
    return pairs if stars is None else pairs.unionByName(stars)


def keep_one_of_similar(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, words: int = WORDS,
    radius: int = RADIUS,
) -> DataFrame:
    """The rows of ``docs`` that stand for their class of near copies: the one of the smallest
    id. Classes are what links of similar pairs connect.

    Among rows of equal id, or none, the first in storage order stays. The columns are
    those of ``docs``. Texts without a word, null ones among them, are alike; no rows give none.
    """

    @once
    @F.arrow_udf("struct<node:long,fp:long,size:long,bands:array<long>>")
    def sketch(column: pa.Array) -> pa.Array:
        rows = []
        for t in byte_texts(column):
            node, found = xxhash.xxh3_64_intdigest(b" ".join(_split(t))), shingles(t, words)
            made = np.array([node, fingerprint(t, words), *bands(found)], np.uint64).view(np.int64).tolist()
            rows.append({"node": made[0], "fp": made[1], "size": len(found), "bands": made[2:]})
        return pa.array(rows, pa.struct([*[(n, pa.int64()) for n in ("node", "fp", "size")], ("bands", pa.list_(pa.int64()))]))

    @once
    @F.arrow_udf("binary")
    def hashes(column: pa.Array) -> pa.Array:
        return pa.array([shingles(t, words).tobytes() for t in byte_texts(column)], pa.binary())

    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    body, key = F.col(f"c{names.index(text)}"), F.col(f"c{names.index(doc_id)}")
    marked = plain.withColumn("s", sketch(body)).withColumn("row", F.monotonically_increasing_id())
    rows = stage(marked.select(*plain.columns, "row", "s.*"))
    order = F.min(F.struct(key.isNull().alias("n"), key.alias("doc_id"), "row")).alias("first")
    same = [F.min(c).alias(c) for c in ("fp", "size", "bands")]
    nodes = stage(rows.groupBy("node").agg(*same, order))
    buckets = stage(shared_buckets(nodes))
    heads = nodes.join(buckets.select("node").distinct(), "node", "left_semi").select("node", F.col("first.row").alias("row"))
    sets = stage(rows.select("row", body.alias("text")).join(heads, "row").select("node", hashes("text").alias("shingles")))
    links = stage(similar_links(buckets, sets, similarity, radius))
    classes = connected_components(links).select("node", "component")
    first = (
        nodes.join(classes, "node", "left")
        .groupBy(F.coalesce("component", "node").alias("class"))
        .agg(F.min("first").alias("first"))
        .select(F.col("first.row").alias("row"))
    )
    return rows.join(first, "row", "left_semi").select(*plain.columns).toDF(*names)
