"""The queries against their SQL, and the pipeline stage by stage."""

import hashlib
import math
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from compare import connect, differences, duckdb_bag, duckdb_types, spark_bag
from conftest import SF_DIR
from lectern.llm import lines, queries, toxicity
from lectern.llm.queries import _learnable
from test_similar import brute_kept


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries.llm_oracles()))
def test_query_equals_sql(spark, con, name):
    df = queries.llm_queries()[name](spark, SF_DIR)
    sql = queries.llm_oracles()[name]
    columns, rows = spark_bag(df)
    expected_columns, expected = duckdb_bag(con, sql)
    assert columns == expected_columns
    assert dict(df.dtypes) == duckdb_types(con, sql)
    assert rows == expected, differences(rows, expected)


TOKENS = Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER))


def copies_by_hand(documents):
    """How often each document is repeated: the Poisson distribution of its source's rate,
    inverted at the uniform number of its id."""
    def weight(source):
        return queries.MIX_WEIGHTS.get(source, queries.OTHER_WEIGHT)

    named = [r["source"] if r["source"] in queries.MIX_WEIGHTS else None for r in documents]
    total = sum(weight(s) for s in set(named))
    found = Counter()
    for row, source in zip(documents, named):
        rate = weight(source) * len(documents) / (total * named.count(source))
        text = f"{queries.MIX_SEED}/copies:{row['doc_id']}"
        uniform = int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / 2**52
        k, term = 0, math.exp(-rate)
        reached = term
        while reached <= uniform:
            k += 1
            term *= rate / k
            reached += term
        found[row] += k
    return found


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    first = stages["quality_rules"](spark, docs, SF_DIR)
    field = lines.sampled_field(docs, labels)
    passed = [
        r for r in docs.collect() if not lines.measure(r["text"]).base_failed and field.content_share(r["text"]) >= 0.5
    ]
    assert first.columns == columns and sorted(first.collect()) == sorted(passed)

    second = stages["toxicity"](spark, first, SF_DIR)
    model = toxicity.learn(first, _learnable(labels))
    machine = toxicity.Grammar(model.lexicon)
    clean = [r for r in passed if model.score(machine.evidence(r["text"])) < 0.7]
    assert second.columns == columns and sorted(second.collect()) == sorted(clean)

    third = stages["simhash_near_dedup"](spark, second, SF_DIR)
    assert third.columns == columns
    kept = set(brute_kept([(r["doc_id"], r["text"]) for r in clean]))
    distinct = [r for r in clean if r["doc_id"] in kept]
    assert sorted(third.collect()) == sorted(distinct)

    fourth = stages["mixing"](spark, third, SF_DIR)
    assert fourth.columns == columns
    assert Counter(fourth.collect()) == Counter({r: n for r, n in copies_by_hand(distinct).items() if n})

    last = stages["best_fit_packing"](spark, fourth, SF_DIR).collect()
    lengths = Counter()
    for r in fourth.collect():
        tokens = len(TOKENS.encode(r["text"] or "", add_special_tokens=False).ids) + 1
        lengths.update((r["doc_id"], i, min(2048, tokens - 2048 * i)) for i in range(-(-tokens // 2048)))
    assert Counter((r["doc_id"], r["piece"], r["length"]) for r in last) == lengths
    filled = {}
    for r in sorted(last, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(filled.values()) <= 2048
    run = corpus_pipeline.run(spark, SF_DIR).collect()
    plain = [(r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in last]
    assert sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in run) == sorted(plain)
