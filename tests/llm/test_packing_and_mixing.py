import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from conftest import SF_DIR
from llm_fixtures import docs, words  # noqa: F401
from lectern.llm import mixing, packing, queries

FILE = path(queries.TOKENIZER)


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(FILE)


def check_places(rows, capacity=packing.CAPACITY):
    """Every sequence is gapless and not overfull."""
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


@pytest.mark.parametrize(
    "text",
    ["", " ", "It's don't we'll, o'clock 'tis", "a1b2 3.14 x_y", "Σας İx ǅ ﬁ é 日本 語", "<|endoftext|> a<|startoftext|>b",
     "\x85\x1c a\u00a0b", "ÀÉ ÿ ß ª º µ ×÷", "...!? --- #tag @you", "\\ ` ~ ^ | {}", "WORD, Word; word:", "a\x00b \ufffd"],
)
def test_words_encode_as_the_tokenizer_does(whole, text):
    encoder = packing.WordEncoder(whole.to_str())
    for _ in range(2):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_forgetting_words_changes_nothing(whole, monkeypatch, words):
    monkeypatch.setattr(packing, "WORDS_KEPT", 10)
    encoder = packing.WordEncoder(whole.to_str())
    text = words(300, 1, 40)
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_packed_documents_read_back(spark, whole):
    table = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    found = queries.op10_packing(spark, SF_DIR).collect()
    pieces = defaultdict(list)
    for r in found:
        pieces[r["doc_id"]].append(r)
    assert set(pieces) == set(table)
    total = 0
    for i, own in pieces.items():
        ids = np.array(whole.encode(table[i] or "", add_special_tokens=False).ids + [0], "<u4")
        total += len(ids)
        for k, r in enumerate(sorted(own, key=lambda r: r["piece"])):
            part = ids[2048 * k : 2048 * (k + 1)]
            assert (r["piece"], r["start"], r["length"], r["ids_crc32"]) == (k, 2048 * k, len(part), zlib.crc32(part.tobytes()))
        assert sum(r["length"] for r in own) == len(ids)
    assert check_places(found) <= math.ceil(total / 2048) * 1.02 + 1


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_once(seed):
    rng = random.Random(seed)
    counts = Counter(min(64, max(1, int(rng.expovariate(1 / (5 + 9 * seed))))) for _ in range(2000))
    lines = packing.plan(counts, 64)
    used = Counter()
    for lengths, times in lines:
        assert sum(lengths) <= 64 and times > 0
        for n in lengths:
            used[n] += times
    assert used == counts
    total = sum(n * c for n, c in counts.items())
    largest = sum(c for n, c in counts.items() if n > 32)
    assert sum(times for _, times in lines) <= max(math.ceil(total / 64), largest) * 1.03 + 2


def test_exact_complements_come_first():
    assert packing.plan({60: 2, 4: 1, 3: 2, 1: 2, 10: 1}, 64)[0] == ((60, 4), 1)
    assert packing.plan({50: 3, 10: 2, 4: 3}, 64)[0] == ((50, 10, 4), 2)
    assert packing.plan({40: 1, 12: 1, 8: 1, 4: 1}, 64) == [((40, 12, 8, 4), 1)]


def test_packing_odd_rows(docs, words):
    table = docs([(1, None), (1, None), (2, ""), (None, words(3000, 1)), (3, "a b")], clash=True)
    found = packing.packed_documents(table, FILE).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in found if r["doc_id"]) == [(1, 1), (1, 1), (2, 1), (3, 3)]
    assert [r["length"] == 2048 for r in sorted(found, key=lambda r: r["piece"]) if r["doc_id"] is None][0]
    check_places(found)
    assert packing.packed_documents(docs([]), FILE).count() == 0


def test_packing_many_pieces_of_one_length(spark):
    rows = spark.range(5000).selectExpr("id", "cast(if(id % 3 = 0, 700, 30 + id % 5) as long) as length")
    found = packing.pack(rows).collect()
    assert len(found) == 5000
    # Two of 700 fit, not three.
    long = sum(r["length"] == 700 for r in found)
    assert check_places(found) <= math.ceil(long / 2) + 1


def test_lengths_out_of_range_are_refused(spark):
    with pytest.raises(ValueError):
        packing.pack(spark.range(3).selectExpr("id", "id as length"))


@pytest.mark.parametrize("rate", [0.0, 0.1, 1.0, 3.7, 40.0, 400.0])
def test_poisson_steps(rate):
    steps = mixing.poisson_steps(rate)
    for k in range(min(len(steps), 170)):
        exact = math.fsum(math.exp(-rate + i * math.log(rate) - math.lgamma(i + 1)) for i in range(k + 1)) if rate else 1.0
        assert steps[k] == pytest.approx(exact, rel=1e-9, abs=1e-12)
    assert steps[-1] > 1 - 1e-12


def test_rates_and_counts(spark):
    rows = spark.range(20_000).selectExpr(
        "id as doc_id", "case when id % 3 = 0 then 'big' when id % 3 = 1 then 'small' when id % 30 = 2 then null else 'z' end as source"
    )
    rates = {r["bucket"]: (r["n"], r["rate"]) for r in mixing.source_rates(rows, {"big": 1, "small": 2, "absent": 5}, 1).collect()}
    assert set(rates) == {"big", "small", None}
    assert sum(n for n, _ in rates.values()) == 20_000
    assert sum(n * r for n, r in rates.values()) == pytest.approx(20_000)
    found = mixing.replicated(rows, {"big": 1, "small": 2}, 1).groupBy("source").count().collect()
    got = {r["source"]: r["count"] for r in found}
    assert got["big"] == pytest.approx(5000, rel=0.05) and got["small"] == pytest.approx(10_000, rel=0.05)
    # The same again, whatever the partitions.
    again = mixing.replicated(rows.repartition(7), {"big": 1, "small": 2}, 1)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, mixing.replicated(rows, {"big": 1, "small": 2}, 1).collect()))


def test_mixing_odd_rows(docs):
    table = docs([(1, "a", "en", "s", 1), (1, "a", "en", "s", 1), (None, None, None, None, None), (2, "", "en", "t", 0)], clash=True)
    found = mixing.mixed(table, {"s": 1.0}, 1.0, rows=40)
    assert [c for c in found.columns if c in ("copy", "order_key")] == ["copy", "order_key"]
    keys = [r["order_key"] for r in found.collect()]
    assert keys == sorted(keys) and len(keys) > 10
    assert mixing.mixed(docs([]), {"s": 1.0}, 1.0).count() == 0
    assert mixing.mixed(table, {}, 1.0).count() > 0
    assert mixing.mixed(table, {"s": 0.0}, 0.0).count() == 0


def test_rows_of_one_id_have_one_order(docs):
    rows = [(i % 3, f"text {i}", "en", "s", i) for i in range(60)]
    orders = [
        [r["text"] for r in mixing.mixed(docs(part, clash=True).repartition(n), {"s": 1.0}, 1.0, rows=200).collect()]
        for part, n in ((rows, 2), (rows[::-1], 7))
    ]
    assert orders[0] == orders[1] and len(orders[0]) > 60


def test_rare_source_of_a_high_rate(spark):
    # 3 documents are to make up half of 100,000, a rate near 16,667: several draws, added up.
    rows = spark.range(100_000).selectExpr("id as doc_id", "if(id < 3, 'rare', 'big') as source")
    found = mixing.replicated(rows, {"rare": 1.0, "big": 1.0}, 0.0)
    rate = 50_000 / 3
    got = found.filter("source = 'rare'").groupBy("doc_id").agg({"copy": "max", "*": "count"}).collect()
    numbers = [r["count(1)"] for r in got]
    assert len(numbers) == len(set(numbers)) == 3
    assert all(abs(n - rate) < 5 * math.sqrt(rate) for n in numbers)
    assert all(r["max(copy)"] == r["count(1)"] - 1 for r in got)
    assert mixing.replicated(rows.repartition(3), {"rare": 1.0, "big": 1.0}, 0.0).count() == found.count()


def test_copies_of_a_high_rate_are_poisson(spark):
    # 2,000 documents at a rate of 1,200: mean and variance are the rate.
    rows = spark.range(2000).selectExpr("id as doc_id", "'s' as source")
    found = mixing.replicated(rows, {"s": 1.0}, 0.0, rows=2000 * 1200).groupBy("doc_id").count().collect()
    numbers = np.array([r["count"] for r in found])
    assert len(numbers) == 2000
    assert abs(numbers.mean() - 1200) < 5 * math.sqrt(1200 / 2000)
    assert numbers.var() == pytest.approx(1200, rel=0.2)


def test_copies_are_numbered_over_runs(spark, monkeypatch):
    monkeypatch.setattr(mixing, "_RUN", 7)
    rows = spark.range(50).selectExpr("id as doc_id", "'s' as source")
    found = mixing.replicated(rows, {"s": 1.0}, 0.0, rows=50 * 30).groupBy("doc_id").agg({"copy": "max", "*": "count"}).collect()
    assert len(found) == 50 and all(r["max(copy)"] == r["count(1)"] - 1 for r in found)


def test_plan_takes_no_more_sequences_than_best_fit_alone():
    rng, better = random.Random(4), 0
    for _ in range(30):
        counts = {n: rng.randrange(1, 1000) for n in range(1, 65)}
        sequences = [sum(t for _, t in lines) for lines in (
            packing.plan(counts, 64), packing._best_fit(counts, 64), packing._exact_first(counts, 64))]
        assert sequences[0] == min(sequences)
        better += sequences[1] < sequences[2]
        used = Counter()
        for lengths, times in packing.plan(counts, 64):
            assert sum(lengths) <= 64
            for n in lengths:
                used[n] += times
        assert used == counts
    assert better
