"""Roots and proofs against a tree built by hand."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from lectern.llm import manifest
from llm_fixtures import docs, rows, words  # noqa: F401


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def lower(text):
    return text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def tree(leaves):
    """The root, and for each leaf the siblings to its left and right on every level."""
    ways, below, level = [[] for _ in leaves], [[i] for i in range(len(leaves))], list(leaves)
    while len(level) > 1:
        runs = [range(i, min(i + 8, len(level))) for i in range(0, len(level), 8)]
        for run in runs:
            for node in run:
                step = ("".join(level[run.start : node]), "".join(level[node + 1 : run.stop]))
                for leaf in below[node]:
                    ways[leaf].append(step)
        level = [digest("".join(level[run.start : run.stop])) for run in runs]
        below = [sum((below[n] for n in run), []) for run in runs]
    return level[0], ways


def by_hand(documents):
    langs = defaultdict(list)
    for r in documents:
        def leaf(text, r=r):
            return digest("".join(field(v) for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))

        changed = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
        order = (r["doc_id"] is not None, r["doc_id"] or 0)
        langs[r["lang"]].append((order, leaf(r["text"]), leaf(lower(r["text"])) if changed else "", r["doc_id"]))
    if not langs:
        return []
    names = sorted(langs, key=lambda n: (n is not None, (n or "").encode()))
    trees = []
    for name in names:
        langs[name].sort()
        trees.append(tree([row[1] for row in langs[name]]))
    root, tops = tree([t[0] for t in trees])
    out = []
    for name, (subroot, ways), top in zip(names, trees, tops):
        for (_, leaf, tampered, doc_id), way in zip(langs[name], ways):
            folded = tampered or leaf
            for left, right in way + top:
                folded = digest(left + folded + right)
            proof = digest("".join(left + right for left, right in way + top))
            out.append((doc_id, leaf, subroot, root, proof, folded, folded == root))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@pytest.mark.parametrize(
    "made",
    [
        [],
        [(1, "Aa", "en", "s", 2)],
        [(1, "Aa", "en", "s", 2)] * 9,
        [(i, None if i % 5 else "Xy", None if i % 3 else f"l{i % 7}", None, i) for i in range(200)] + [(None, "a", "en")] * 3,
        [(i, "T", f"l{i}") for i in range(70)],
        [(0, "T", "a")] + [(i, "T", "b") for i in range(65)] + [(-1, "", ""), (0, None, None)],
    ],
    ids=["empty", "one row", "repeated rows", "nulls", "a tree per row", "lone leaf beside a tree"],
)
def test_manifest(docs, made):  # noqa: F811
    df = docs(made)
    assert rows(manifest.manifest(df), *COLUMNS) == by_hand(df.collect())


def test_manifest_of_a_hot_language_with_long_texts_and_clashing_columns(docs, words):  # noqa: F811
    made = [(i, words(20, i), "de" if i % 3 else f"l{i % 9}", "S", i) for i in range(700)]
    made.append((-5, words(200_000, 1).upper(), "de", "S", 0))
    assert rows(manifest.manifest(docs(made, clash=True)), *COLUMNS) == by_hand(docs(made).collect())


def test_a_jump_meets_few_rows_at_a_key(spark, monkeypatch):
    """Pointers over two and four levels, so that the third round deals out by salts."""
    from pyspark.sql import functions as F

    met = []
    jump = manifest._jump

    def watched(nodes, distance):
        salts = 8 ** max(distance - 2, 0)
        dealt = nodes.withColumn("_salt", F.col("index") % salts)
        most = dealt.filter("way is not null").groupBy("up_tree", "up_level", "up_index", "_salt").count().agg(F.max("count"))
        met.append((distance, most.first()[0]))
        return jump(nodes, distance)

    monkeypatch.setattr(manifest, "_jump", watched)
    df = spark.range(40_000).select(
        F.col("id").alias("doc_id"), F.lit("T").alias("text"), F.lit("en").alias("lang"),
        F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"),
    )
    found = manifest.manifest(df)
    assert found.filter("verified != (crc32(cast(doc_id as string)) % 3 != 0)").isEmpty()
    assert found.select("root").distinct().count() == 1
    assert [d for d, _ in met] == [1, 2, 4] and all(n <= 64 for _, n in met)
