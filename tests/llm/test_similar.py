import random

import numpy as np
import pytest

from llm_fixtures import docs, words  # noqa: F401
from lectern.llm import similar
import corpus_pipeline


def grams(text):
    found = (text or "").encode().lower().split()
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def brute_kept(rows):
    """Smallest ids of the classes, all pairs compared."""
    sets = [(i, grams(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, x) in enumerate(sets):
        for j, y in sets[:k]:
            if (not x and not y) or len(x & y) >= 0.8 * len(x | y) > 0:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return sorted({find(i) for i in root})


def changed(text, n, seed):
    rng = random.Random(seed)
    found = text.split()
    for i in rng.sample(range(len(found)), n):
        found[i] = f"new{seed}x{i}"
    return " ".join(found)


def test_planted_near_copies_leave_the_stage(spark, docs, words):
    rows = []
    for base in range(12):
        text = words(400, base)
        rows.append((100 * base, text))
        # 3 to 6 changed words of 400 leave similarities of 0.86 to 0.96; 40 leave far less.
        rows += [(100 * base + n, changed(text, n, 7 * base + n)) for n in (3, 4, 5, 6)]
        rows.append((100 * base + 50, changed(text, 40, base)))
    table = docs(rows)
    kept = corpus_pipeline.near_dedup(spark, table, "")
    assert kept.columns == table.columns
    wanted = brute_kept(rows)
    assert wanted == sorted(100 * b + k for b in range(12) for k in (0, 50))
    assert sorted(r["doc_id"] for r in kept.collect()) == wanted


@pytest.mark.parametrize("limit", [4096, 8])
def test_stage_equals_all_pairs(spark, sf_dir, words, monkeypatch, limit):
    # With the small limit, buckets are measured against an anchor and dealt out in blocks.
    monkeypatch.setattr(similar, "BUCKET_ROWS", limit)
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    text = words(300, 1)
    more = spark.createDataFrame([(10**6 + i, changed(text, 2, i)) for i in range(60)], "doc_id long, text string")
    table = table.unionByName(more)
    kept = similar.keep_one_of_similar(table)
    assert sorted(r["doc_id"] for r in kept.collect()) == brute_kept([tuple(r) for r in table.collect()])


def test_odd_rows(docs, words):
    text = words(500, 3)
    table = docs([(4, text), (2, text), (2, text), (9, words(500, 4)), (None, None), (None, " ")], clash=True)
    kept = similar.keep_one_of_similar(table)
    assert kept.columns == table.columns
    assert sorted(r[0] if r[0] is not None else -1 for r in kept.collect()) == [-1, 2, 9]
    assert similar.keep_one_of_similar(docs([])).count() == 0


def template_texts(n, planted, seed=5):
    """Texts of one template, mutually alike at about 0.6, and near copies of some of them."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(400)]
    made = [[*base[:300], *[f"t{t}x{i}" for i in range(100)]] for t in range(n)]
    copies = []
    for t in range(planted):
        copy = list(made[t])
        copy[rng.randrange(310, 390)] = f"c{t}"
        copies.append(copy)
    return [" ".join(x) for x in (*made, *copies)]


def links_of_band(texts, band):
    """What the comparing task finds in the largest bucket of a band, and who is in it."""
    sets = [similar.shingles(t.encode()) for t in texts]
    values = np.array([similar.bands(x)[band] for x in sets])
    found, counts = np.unique(values, return_counts=True)
    rows = np.flatnonzero(values == found[counts.argmax()])
    fps = np.array([similar.fingerprint(texts[r].encode(), 5) for r in rows], np.uint64).view(np.int64)
    side = np.zeros(len(rows), np.int64)
    links = similar._links(side, side, fps, [sets[r] for r in rows], similar.RADIUS, similar.SIMILARITY)
    return set(rows.tolist()), {(int(rows[i]), int(rows[j])) for i, j in links}


def test_no_link_is_lost_among_texts_of_one_template():
    texts = template_texts(2000, 200)
    sets = [similar.shingles(t.encode()) for t in texts[:2]]
    assert 0.5 < similar.jaccard(*sets) < 0.7
    for band in range(3):
        inside, links = links_of_band(texts, band)
        wanted = {(t, 2000 + t) for t in range(200) if {t, 2000 + t} <= inside}
        assert len(inside) > 200
        assert {tuple(sorted(x)) for x in links} == wanted


def test_crowded_buckets_of_a_template(spark, monkeypatch):
    # Blocks of 20: no anchor covers the template's texts, so all blocks meet; the near
    # copies of one text lie around theirs.
    monkeypatch.setattr(similar, "BUCKET_ROWS", 40)
    texts = template_texts(150, 40)
    texts += [changed(texts[0], 2, 1000 + i) for i in range(100)]
    rows = list(enumerate(texts))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    kept = similar.keep_one_of_similar(table)
    assert sorted(r["doc_id"] for r in kept.collect()) == brute_kept(rows)
