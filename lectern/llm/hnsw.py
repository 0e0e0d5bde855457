"""Approximate nearest neighbours by cosine: a small-world graph for each shard.

Equal vectors are indexed once; of each, the rows of smallest id are kept, as many as an
answer can use. Vectors are dealt to shards of bounded size, each shard's graph is built in
one task and stored as flat arrays: vectors, ids, and for each level the neighbours, -1
where there is none. A search visits every shard with blocks of queries, measures what it
finds on the original vectors in double precision, and merges the shards' best.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import pick, staged_and_released
from lectern.staging import stage

#: Vectors of a shard on average; it bounds a task's memory and time.
SHARD_VECTORS = 4096
#: Queries that are answered on one shard at a time: a graph is sent and read once for each block.
BLOCK_QUERIES = 4096
#: Tasks of a step at most.
MOST_TASKS = 10_000
#: Neighbours of a node on the upper levels; the lowest level has twice as many.
LINKS = 12
#: Candidates kept while inserting and while searching.
BUILD_WIDTH = 64
SEARCH_WIDTH = 96


@dataclass
class Graph:
    """Neighbours by level. ``nodes[k]``: which vectors are on level k; ``links[k]``: a row
    of neighbours for each, -1 to fill up."""

    vectors: np.ndarray  # float32, unit length
    nodes: list[np.ndarray]
    links: list[np.ndarray]
    entry: int

    def __post_init__(self) -> None:
        self._near: list[dict[int, list[int]]] = [
            {int(n): [x for x in row if x >= 0] for n, row in zip(nodes, links.tolist())}
            for nodes, links in zip(self.nodes, self.links)
        ]

    def search(self, query: np.ndarray, width: int) -> list[tuple[float, int]]:
        """About the ``width`` most similar vectors, best first."""
        at = [(float(self.vectors[self.entry] @ query), self.entry)]
        for level in range(len(self.nodes) - 1, 0, -1):
            at = _beam(self.vectors, self._near[level], query, at, 1)
        return _beam(self.vectors, self._near[0], query, at, width)


def _beam(
    vectors: np.ndarray, near: dict[int, list[int]], query: np.ndarray, start: list[tuple[float, int]], width: int
) -> list[tuple[float, int]]:
    """Best-first search on one level: (similarity, node), best first."""
    seen = {n for _, n in start}
    ahead = [(-s, n) for s, n in start]
    best = list(start)
    heapq.heapify(ahead)
    heapq.heapify(best)
    while ahead:
        similarity, node = heapq.heappop(ahead)
        if len(best) >= width and -similarity < best[0][0]:
            break
        new = [n for n in near[node] if n not in seen]
        if not new:
            continue
        seen.update(new)
        for s, n in zip((vectors[new] @ query).tolist(), new):
            if len(best) < width:
                heapq.heappush(best, (s, n))
            elif s > best[0][0]:
                heapq.heapreplace(best, (s, n))
            else:
                continue
            heapq.heappush(ahead, (-s, n))
    return sorted(best, reverse=True)


def _diverse(vectors: np.ndarray, found: list[tuple[float, int]], most: int) -> list[int]:
    """Of ``found``, best first, those nearer to the node than to any chosen before; filled
    up with the best of the others."""
    if len(found) <= most:
        return [n for _, n in found]
    nodes = [n for _, n in found]
    among = vectors[nodes] @ vectors[nodes].T
    closest = np.full(len(nodes), -2.0, np.float32)
    chosen, passed = [], []
    for i, (similarity, _) in enumerate(found):
        if similarity > closest[i]:
            chosen.append(i)
            if len(chosen) == most:
                break
            np.maximum(closest, among[i], out=closest)
        else:
            passed.append(i)
    return [nodes[i] for i in (chosen + passed)[:most]]


def build(vectors: np.ndarray, links: int = LINKS, width: int = BUILD_WIDTH, seed: int = 7) -> Graph:
    """Inserts the unit vectors one after the other; ``vectors`` has at least one row."""
    n = len(vectors)
    draws = np.random.default_rng(seed).random(n)
    levels = np.minimum(-np.log(1 - draws) / math.log(links), 12).astype(int)
    near: list[dict[int, list[int]]] = []
    entry = 0
    for node in range(n):
        top = int(levels[node])
        query = vectors[node]
        if near:
            at = [(float(vectors[entry] @ query), entry)]
            for level in range(len(near) - 1, -1, -1):
                if level > top:
                    at = _beam(vectors, near[level], query, at, 1)
                    continue
                at = _beam(vectors, near[level], query, at, width)
                most = links if level else 2 * links
                chosen = _diverse(vectors, at, links)
                near[level][node] = chosen
                for other in chosen:
                    back = near[level][other]
                    back.append(node)
                    if len(back) > most:
                        ranked = sorted(zip((vectors[back] @ vectors[other]).tolist(), back), reverse=True)
                        near[level][other] = _diverse(vectors, ranked, most)
        if top >= len(near):
            near += [{node: []} for _ in range(top + 1 - len(near))]
            entry = node
    nodes, flat = [], []
    for level, table in enumerate(near):
        wide = links if level else 2 * links
        ids = np.fromiter(table, np.int32, len(table))
        rows = np.full((len(table), wide), -1, np.int32)
        for i, row in enumerate(table.values()):
            rows[i, : len(row)] = row
        nodes.append(ids)
        flat.append(rows)
    return Graph(vectors, nodes, flat, entry)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = _scaled(vectors)
    return (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32)


INDEX = (
    "dim int, shard int, vectors binary, ids binary, sizes array<int>, nodes binary, links binary, entry int"
)


def _index_shards(members: int, links: int, width: int):
    def make(group: pa.Table) -> pa.Table:
        dim = group.column("dim")[0].as_py()
        given = group.column("vector").combine_chunks().flatten()
        vectors = np.array(given, np.float64).reshape(-1, dim)
        ids = np.full((len(vectors), members), -1, np.int64)
        known = np.zeros((len(vectors), members), bool)
        for i, row in enumerate(group.column("ids")):
            own = row.as_py()
            ids[i, : len(own)], known[i, : len(own)] = own, True
        graph = build(_unit(vectors), links, width)
        row = {
            "dim": dim, "shard": group.column("shard")[0].as_py(), "vectors": vectors.astype("<f4" if pa.types.is_float32(given.type) else "<f8").tobytes(),
            "ids": ids.tobytes() + known.tobytes(), "sizes": [len(x) for x in graph.nodes],
            "nodes": b"".join(x.tobytes() for x in graph.nodes), "links": b"".join(x.tobytes() for x in graph.links),
            "entry": graph.entry,
        }
        return pa.Table.from_pylist(
            [row],
            pa.schema(
                [
                    ("dim", pa.int32()), ("shard", pa.int32()), ("vectors", pa.binary()), ("ids", pa.binary()),
                    ("sizes", pa.list_(pa.int32())), ("nodes", pa.binary()), ("links", pa.binary()), ("entry", pa.int32()),
                ]
            ),
        )

    return make


def usable(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id`` and ``vector`` (floats if they are given as such, else doubles) of the vectors
    that have a direction: not null or zero, without null or non-finite components. Rows of a
    null id are left out."""
    slim = pick(rows, vec_id=vec_id, vector=vector)
    if slim.schema["vector"].dataType.simpleString() != "array<float>":
        slim = slim.withColumn("vector", F.col("vector").cast("array<double>"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return slim.filter(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~odd & F.exists("vector", lambda x: x != 0.0)
    )


def index(
    rows: DataFrame, members: int, links: int = LINKS, width: int = BUILD_WIDTH, shard_vectors: int = SHARD_VECTORS
) -> DataFrame:
    """The stored graphs over ``rows`` (as from ``usable``): one row for each shard.

    Of rows with equal vectors the ``members`` smallest ids stand for all. The limit is
    applied in each task before the shuffle, so a very common vector sends few rows.
    """
    order = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.distinct().withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= members)
    distinct = staged_and_released(few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    shards = max(1, math.ceil(distinct.count() / shard_vectors))
    dealt = distinct.select(
        F.size("vector").alias("dim"), F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int").alias("shard"), "vector", "ids"
    )
    # More tasks than shards, so that few of them get two.
    spread = dealt.repartition(min(4 * shards, MOST_TASKS), "dim", "shard")
    return staged_and_released(spread.groupBy("dim", "shard").applyInArrow(_index_shards(members, links, width), INDEX))


def _restore(row: dict, members: int, links: int) -> tuple[Graph, np.ndarray, np.ndarray, np.ndarray]:
    n = row["sizes"][0]
    stored = "<f4" if len(row["vectors"]) == 4 * n * row["dim"] else "<f8"
    vectors = _scaled(np.frombuffer(row["vectors"], stored).astype(np.float64).reshape(n, row["dim"]))
    ids = np.frombuffer(row["ids"][: 8 * n * members], np.int64).reshape(n, members)
    known = np.frombuffer(row["ids"][8 * n * members :], bool).reshape(n, members)
    nodes, flat, at, to = [], [], 0, 0
    for level, size in enumerate(row["sizes"]):
        wide = links if level else 2 * links
        nodes.append(np.frombuffer(row["nodes"], np.int32, size, at))
        flat.append(np.frombuffer(row["links"], np.int32, size * wide, to).reshape(size, wide))
        at, to = at + 4 * size, to + 4 * size * wide
    return Graph(_unit(vectors), nodes, flat, row["entry"]), vectors, ids, known


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """By powers of two, which is exact: squares of huge or tiny components would not fit."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    return np.ldexp(vectors, -exponent)


def _cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    return vectors @ query / (np.linalg.norm(vectors, axis=1) * np.linalg.norm(query))


def _search_blocks(members: int, links: int, width: int):
    """Searches one shard with one block of queries for each row."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                graph, vectors, ids, known = _restore(row, members, links)
                queries = _scaled(np.array(row["queries"], np.float64).reshape(-1, row["dim"]))
                units = _unit(queries)
                out_query, out_id, out_score = [], [], []
                for q, query, unit in zip(row["query_ids"], queries, units):
                    found = np.array([n for _, n in graph.search(unit, width)])
                    scores = np.repeat(_cosines(query, vectors[found]), members)
                    of, there = ids[found].ravel(), known[found].ravel()
                    scores, of = scores[there], of[there]
                    best = np.lexsort((of, -scores))[:members]
                    out_query += [q] * len(best)
                    out_id += of[best].tolist()
                    out_score += scores[best].tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out_query, pa.int64()), pa.array(out_id, pa.int64()), pa.array(out_score, pa.float64())],
                    names=["query", "vec_id", "score"],
                )

    return search


def nearest(
    rows: DataFrame, queries: DataFrame, k: int = 5, links: int = LINKS, width: int = SEARCH_WIDTH,
    build_width: int = BUILD_WIDTH, shard_vectors: int = SHARD_VECTORS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` most similar of ``rows`` found for each
    row of ``queries``, both as from ``usable``.

    A row is no candidate for a query of its own id; the others are, equal vectors included.
    Ties go to the smaller id. Vectors of another length are no candidates. Repeated rows count
    once, among the queries as well. Fewer candidates than ``k``: all of them. No rows: none.
    """
    members = k + 1
    graphs = index(rows, members, links, build_width, shard_vectors)
    asked = stage(queries.distinct())
    # Equal queries are searched once, under their smallest id.
    single = stage(asked.groupBy("vector").agg(F.min("vec_id").alias("query")))
    blocks = max(1, math.ceil(single.count() / BLOCK_QUERIES))
    dealt = single.select(
        F.size("vector").alias("dim"), F.pmod(F.xxhash64("vector", F.lit(1)), F.lit(blocks)).cast("int").alias("block"),
        "query", "vector",
    )
    # About BLOCK_QUERIES queries a block.
    packed = dealt.groupBy("dim", "block").agg(F.collect_list(F.struct("query", "vector")).alias("q")).select(
        "dim", "block", F.col("q.query").alias("query_ids"), F.flatten("q.vector").alias("queries")
    )
    # A graph is sent once for each block of queries, a block once for each shard; they meet
    # where they are searched.
    shards = graphs.agg(F.max("shard")).first()[0]
    tasks = min(4 * max(1, graphs.count() * blocks), MOST_TASKS)
    meeting = ["dim", "shard", "block"]
    sent = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).repartition(tasks, *meeting)
    asking = packed.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards or 0)))).repartition(tasks, *meeting)
    work = sent.join(asking.hint("merge"), meeting)
    found = work.mapInArrow(_search_blocks(members, links, width), "query long, vec_id long, score double")
    # One row for each shard and candidate: k + 1 times the shards.
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    best = found.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= members)
    lists = best.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("_rank", "vec_id", "score"))).alias("best"))
    answers = stage(
        single.join(lists, "query").select(F.struct(F.col("vector").alias("v")).alias("_v"), "best")
    )
    others = F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (
        asked.select(F.col("vec_id").alias("query_id"), F.struct(F.col("vector").alias("v")).alias("_v"))
        .join(answers, "_v")
        .select("query_id", F.posexplode(others).alias("_at", "x"))
        .select("query_id", (F.col("_at") + 1).alias("rank"), "x.vec_id", "x.score")
    )
