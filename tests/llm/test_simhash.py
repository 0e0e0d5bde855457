import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from llm_fixtures import docs, words  # noqa: F401
from lectern.llm import simhash
from lectern.llm.components import connected_components
from lectern.llm.simhash import fingerprint, near_duplicates, sliced_pairs


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, radius=2):
    """Smallest id reachable, all pairs compared."""
    root = {i: i for i, _ in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, x) in enumerate(prints):
        for j, y in prints[:k]:
            if (x ^ y).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in root}


@pytest.mark.parametrize(
    "text", ["", " \n", "one", "One two", "A b c", "a b c d ÄÖ ä\u00a0x\x1cy", "x " * 70_000, "Ab\tcD\x0bE"]
)
def test_fingerprint_follows_the_definition(text):
    assert fingerprint(text.encode()) == plain_fingerprint(text)


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_sliced_pairs_are_all_pairs(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = np.concatenate([base ^ np.uint64(1 << int(rng.integers(64))) ^ np.uint64(1 << int(rng.integers(64))) for _ in range(4)])
    group = np.sort(rng.integers(0, 5, len(fps)))
    found = {(int(i), int(j)) for pairs in sliced_pairs(fps, group, radius) for i, j in pairs.T}
    wanted = {
        (i, j)
        for i in range(len(fps))
        for j in range(i + 1, len(fps))
        if group[i] == group[j] and (int(fps[i]) ^ int(fps[j])).bit_count() <= radius
    }
    assert found == wanted


def test_large_buckets_are_divided_without_loss(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", 16)
    rng = random.Random(5)
    base = rng.getrandbits(64)
    # One dense bucket at the first and the second level, and strangers.
    prints = {base} | {base ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(20)}
    prints |= {rng.getrandbits(64) for _ in range(200)}
    rows = [(i, p - 2**64 if p >> 63 else p) for i, p in enumerate(sorted(prints))]
    found = simhash.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, fp long"))
    by_fp = {r["fp"]: r["component_id"] for r in found.collect()}
    wanted = classes([(i, p & (2**64 - 1)) for i, p in rows])
    assert {i: by_fp[p] for i, p in rows} == wanted


def test_classes_equal_brute_force(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    prints = [(r["doc_id"], plain_fingerprint(r["text"])) for r in table.collect()]
    wanted = classes(prints)
    found = near_duplicates(table).collect()
    assert sorted(map(tuple, found)) == sorted((i, f"{p:016x}", wanted[i]) for i, p in prints)
    assert len(set(wanted.values())) < len(prints)


def test_odd_rows(docs, words):
    long = words(30_000, 1)
    table = docs([(5, None), (3, ""), (4, " "), (7, "same text here"), (7, "same text here"), (None, "same text here"), (9, long), (8, long + " tail")], clash=True)
    found = {}
    for i, print_, component in near_duplicates(table).collect():
        found.setdefault(i, []).append((print_, component))
    assert found[5] == found[3] == found[4] == [("0" * 16, 3)]
    assert len(found[7]) == 2 and {c for _, c in found[7]} == {7}
    assert found[None][0][1] == 7
    assert found[9][0][1] == found[8][0][1] == 8
    assert near_duplicates(docs([])).count() == 0


def test_one_of_each_class_stays(docs, words):
    text = words(500, 3)
    table = docs([(4, text), (2, text), (2, text), (9, words(500, 4)), (None, None), (None, "")], clash=True)
    kept = simhash.keep_one_of_each(table)
    assert kept.columns == table.columns
    assert sorted(r[0] if r[0] is not None else -1 for r in kept.collect()) == [-1, 2, 9]


def test_components(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    noise = [(2000 + rng.randrange(300), 2000 + rng.randrange(300)) for _ in range(200)]
    edges = chain + star + noise + [(7, 7), (None, 3), (5, None), chain[0]]
    root = {n: n for e in chain + star + noise for n in e}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in chain + star + noise:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    linked = {n for a, b in chain + star + noise if a != b for n in (a, b)}
    df = spark.createDataFrame(edges, "a long, b long")
    assert {tuple(r) for r in connected_components(df).collect()} == {(n, find(n)) for n in linked}
    assert connected_components(df.filter("false")).count() == 0
    named = df.select(F.concat(F.lit("n"), "a").alias("a"), F.concat(F.lit("n"), "b").alias("b"))
    assert connected_components(named).count() == len(linked)
