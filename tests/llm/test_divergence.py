"""The audit of sources against counting by hand."""

import random
import re
from collections import Counter, defaultdict

import pytest

from lectern.llm import divergence
from llm_fixtures import docs, rows, words  # noqa: F401

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def by_hand(documents, ranks=200):
    held, used = Counter(), defaultdict(Counter)
    for row in documents:
        lang, source, text = (row[c] or "" for c in ("lang", "source", "text"))
        found = Counter(lower(t) for t in TERM.findall(text))
        used[lang, source].update(found)
        held.update((lang, t) for t in found)
    out = []
    for lang in {lang for lang, _ in used}:
        kept = {t for (other, t), n in held.items() if other == lang and n >= 3}
        sources = [s for other, s in used if other == lang]

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // (total + len(kept)) for t in kept}

        p = {s: shares(used[lang, s]) for s in sources}
        q = shares(sum((used[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources if o != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if used[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, ranks)):
                found.sort(key=lambda f: (-f[1], f[0].encode()))
                out += [(lang, s, part, *f, i) for i, f in enumerate(found[:most], 1)]
    return sorted(out, key=repr)


def check(df):
    assert rows(divergence.audit(df), "lang", "source", "part", "item", "value", "rank") == by_hand(df.collect())


def test_nulls_blanks_and_empty_tables(docs):  # noqa: F811
    check(docs([]))
    check(docs([(1, None), (2, None), (None, "a")]))
    check(docs([(1, "", "en", "a"), (2, " \t", "en", "b"), (3, None, "de", "a")], clash=True))


def test_repeated_rows_are_documents(docs):  # noqa: F811
    check(docs([(1, "same words", "en", "a")] * 3 + [(1, "same", "en", "b")]))
    check(docs([(1, "same words", "en", "a")] * 2))


@pytest.mark.parametrize("seed", range(4))
def test_chunks_that_share_a_term_in_few_documents(docs, seed):  # noqa: F811
    rng = random.Random(seed)
    words = ["foo", "Foo", "foo,", "(FOO)", "foo-foo", "Bär", "BÄR", "a-b", "x1y", "é", "77", "日本", "a\x1cb", "u\x85v"]
    words += [f"r{chr(97 + i)}" for i in range(20)] + [f"(R{chr(97 + i)})" for i in range(20)]
    made = [
        (i, rng.choice(" \n\t").join(rng.choice(words) for _ in range(rng.randrange(5))), rng.choice(["en", "de", None]), rng.choice("abc"))
        for i in range(60)
    ]
    check(docs(made).repartition(4))


def test_counts_are_passed_on_in_parts(docs, words, monkeypatch):  # noqa: F811
    made = [(i, words(60, i), "en", f"s{i % 5}") for i in range(50)]
    monkeypatch.setattr(divergence, "HELD", 900)
    monkeypatch.setattr(divergence, "CELLS", 11)
    check(docs(made))


def test_a_very_long_text_and_one_hot_source(docs, words):  # noqa: F811
    made = [(0, words(300_000, 0), "en", "hot")] + [(i, words(9, i), "en", "hot" if i % 3 else "b") for i in range(1, 90)]
    check(docs(made))


def test_shares_are_exact_for_large_counts(spark):
    from pyspark.sql import functions as F

    n, total, v = 10**15, 10**17 + 3, 10**7
    p = divergence.share(*(F.lit(x).cast("long") for x in (n, total, v)))
    assert spark.range(1).select(p).first()[0] == 1 + 10**9 * (n + 1) // (total + v)


@pytest.mark.parametrize("n", [0, 9223372033, 9223372034, 9223372035, 9223372036, 10**12])
def test_shares_are_exact_where_64_bits_end(spark, n):
    from pyspark.sql import functions as F

    counts = spark.createDataFrame([(n, n + 7, 5)], "n long, total long, v long")
    assert counts.select(divergence.share(*map(F.col, ("n", "total", "v")))).first()[0] == 1 + 10**9 * (n + 1) // (n + 12)


def test_whole_terms_are_not_split_and_nothing_is_sorted_to_be_counted(docs, monkeypatch):  # noqa: F811
    plans, stored = [], []

    def kept(df, store):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        stored.append(store(df))
        return stored[-1]

    for name in ("stage", "staged_and_released"):
        monkeypatch.setattr(divergence, name, lambda df, store=getattr(divergence, name): kept(df, store))
    made = docs([(i, "plain words \x1c words é ü\x85 More: x-y", "en", f"s{i % 2}") for i in range(6)])
    check(made)
    assert plans and not [text for text in plans if "SortAggregate" in text]
    looked_up = stored[1].collect()
    assert {r["term"] for r in looked_up} == {"more", "x", "y"} and len(looked_up) == 6


def test_a_third_document_lies_between_two_in_one_source(docs):  # noqa: F811
    texts = ["foo bar", "Foo, (bar)", "foo BAR", "foo; none", "one (One) one;", "one"]
    check(docs([(i, t, lang, "a") for lang in ("en", "de") for i, t in enumerate(texts)] + [(9, "foo One", "fr", "b")]).repartition(3))
