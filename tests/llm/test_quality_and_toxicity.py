import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import docs, words  # noqa: F401
from lectern.llm import lines, queries, toxicity


def brute_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(8)}
    seen, duplicates = [], 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            duplicates += line in seen
            seen.append(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), duplicates, len(repeated)


def test_base_counts_equal_brute_force(spark, sf_dir):
    table = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = queries.op5_quality_rules(spark, sf_dir).collect()
    assert len(found) == len(table)
    for r in found:
        n, chars, symbols, dup, rep = brute_measures(table[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, rep)
        assert r["base_failed"] == (n < 20 or 100 * rep > 30 * n)
        assert not (r["base_failed"] and r["kept"])


@pytest.mark.parametrize(
    "text",
    ["", "a", "a a a a a a a a a", "a b\n\na b\n \n \na b\nc", "x\x1cy\u2028z \u00a0 \u3000", "b " * 3000, "#*$%&|<> é" * 9,
     "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8", "one two\r\none two\r\n"],
)
def test_measures_of_odd_texts(text):
    m = lines.measure(text)
    assert (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words) == brute_measures(text)


def test_viterbi_finds_the_best_of_all_labellings():
    rng = np.random.default_rng(0)
    width = len(lines.FEATURES)
    for _ in range(20):
        field = lines.LineField(rng.normal(size=(width + 1, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
        x = rng.random((6, width))
        scores = field.scores(x)

        def total(path):
            return field.start[path[0]] + scores[range(6), path].sum() + sum(field.transition[a, b] for a, b in zip(path, path[1:]))

        best = max(itertools.product((0, 1), repeat=6), key=lambda p: total(list(p)))
        assert tuple(field.decode(x)) == best


def test_quality_on_unseen_texts(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    field = lines.sampled_field(documents, labels.filter("doc_id % 2 = 0"))
    found = lines.judged(documents, field).join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("not verdict.base_failed")
    counts = {(r["quality"], r["kept"]): r["count"] for r in found.groupBy("quality", F.col("verdict.kept").alias("kept")).count().collect()}
    right = counts.get((1, True), 0) + counts.get((0, False), 0)
    assert right >= 0.97 * sum(counts.values())
    # Good texts are left alone.
    assert counts.get((1, False), 0) == 0


def test_quality_odd_rows(docs, words):
    field = lines.train_field([], [])
    table = docs([(1, None), (2, ""), (None, words(50, 1)), (3, words(40_000, 2)), (3, words(40_000, 2))], clash=True)
    found = lines.judged(table, field)
    assert "TEXT" in found.columns and found.columns.count("verdict") == 1
    assert sorted((r[0] or 0, r["verdict"]["n_words"], r["verdict"]["kept"]) for r in found.collect()) == [
        (0, 50, True), (1, 0, False), (2, 0, False), (3, 40_000, True), (3, 40_000, True),
    ]
    kept = lines.keep_content(table, field)
    assert kept.columns == table.columns and kept.count() == 3
    assert lines.keep_content(docs([]), field).count() == 0


def test_field_of_no_labels_keeps_content(spark, docs, words):
    labels = spark.createDataFrame([(None, None), (1, None), (None, 1)], "doc_id long, quality int")
    field = lines.sampled_field(docs([(1, words(30, 1)), (2, None)]), labels)
    assert field.content_share(words(30, 5)) == 1.0


def machine(words=None, stems=None):
    return toxicity.Grammar(toxicity.Lexicon(words or {"fool": 2.0}, stems or {"lowei": 3.0}))


@pytest.mark.parametrize(
    "text, kinds",
    [
        ("what a fool.", ["I"]),
        ("you are a Fool", ["I+"]),
        ("you. fool", ["I"]),
        ("that fool, you know", ["I+"]),
        ("he is a fool", ["I~"]),
        ("he is not a fool", ["I-"]),
        ("not one of the four, fool", ["I"]),
        ("he said that some fool came", ["I'"]),
        ("I will kill you", ["H+"]),
        ("I will find you and kill you", ["H+"]),
        ("ich werde dich töten", ["H+"]),
        ("kill yourself", ["H~"]),
        ("I will kill the process", ["H~"]),
        ("they kill time", ["H"]),
        ("I will not kill you", ["H-"]),
        ("she said that he will kill you", ["H'"]),
        ("you are not to kill", ["H-"]),
        ("ein loweischaft und lowei lowe", ["I", "I"]),
        ("foolish and clean", []),
        ("", []),
    ],
)
def test_grammar(text, kinds):
    assert [k for k, _ in machine().matches(text)] == kinds


def test_composition_is_one_machine_after_the_other():
    a = toxicity.within(2, "N", {"I": "I-"}, toxicity.SYMBOLS)
    b = toxicity.within(3, "T", {"I": "I+", "I-": "I0"}, (*toxicity.SYMBOLS, "I-"))
    both = toxicity.compose(a, b, toxicity.SYMBOLS)
    for word in itertools.product(toxicity.SYMBOLS, repeat=4):
        x = y = z = 0
        for symbol in word:
            x, middle = a.step(x, symbol)
            y, wanted = b.step(y, middle)
            z, found = both.step(z, symbol)
            assert found == wanted


def test_grammar_equals_its_transducers_in_turn(spark, sf_dir):
    """Whole texts, the transducers run one after the other over each clause."""
    grammar = machine({"fool": 2.0}, {"th": 1.0, "lowei": 3.0})
    texts = [r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    rng, given = random.Random(3), [*toxicity.TARGETS, *toxicity.INTENTS, *toxicity.THREATS, *toxicity.NEGATIONS, *toxicity.REPORTS]
    given += [*toxicity.COPULAS, *["fool", "word", "."] * 40]
    texts += [" ".join(rng.choices(given, k=60)) for _ in range(200)]
    seen = set()
    for text in texts:
        wanted = []
        for clause in toxicity._CLAUSE_END.split(text.lower()):
            looked = [grammar.lexicon.look_up(w) for w in toxicity.WORD.findall(clause)]
            line = [s for s, _ in looked][::-1]
            for one, turn in [(toxicity.target_behind(), True), *[(m, False) for m in toxicity.forward()]]:
                state, out = 0, []
                for symbol in line:
                    state, made = one.step(state, symbol)
                    out.append(made)
                line = out[::-1] if turn else out
            wanted += [(s, w) for s, (_, w) in zip(line, looked) if s[0] in "IH"]
        assert list(grammar.matches(text)) == wanted
        seen |= {k for k, _ in wanted}
    assert seen == set(toxicity.KINDS)


def test_unlabelled_threats(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = queries._learnable(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    model = toxicity.learn(docs, labels)
    reach = ["I will kill you.", "Wait there. I'll find you and stab you!", "Ich werde dich töten", "vous allez voir, je vais vous tuer"]
    below = ["I will not kill you.", "She said that he will kill you.", "we should kill the process", "kill time", "You will go."]
    grammar = toxicity.Grammar(model.lexicon)
    assert [t for t in reach if model.score(grammar.evidence(t)) < toxicity.THRESHOLD] == []
    assert [t for t in below if model.score(grammar.evidence(t)) >= toxicity.THRESHOLD] == []


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    found = queries.op4_toxicity(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    counts = {
        (r["toxic"], r["predicted"]): r["count"]
        for r in found.filter("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()
    }
    # Some texts are labelled by words that were overwritten since.
    assert counts[1, 1] >= 0.85 * (counts[1, 1] + counts.get((1, 0), 0))
    assert counts.get((0, 1), 0) <= 0.005 * counts[0, 0]


def test_held_out_labels_are_not_learned_from(spark):
    ids = [(i, 1) for i in range(300)]
    kept = queries._learnable(spark.createDataFrame(ids, "doc_id long, toxic int"))
    assert sorted(r[0] for r in kept.collect()) == [i for i, _ in ids if zlib.crc32(str(i).encode()) % 3 != 1]


def test_toxicity_odd_rows(spark, docs, words):
    labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    table = docs([(1, None), (2, ""), (None, words(30_000, 1)), (2, "")], clash=True)
    model = toxicity.learn(table, labels)
    scores = [r["score"] for r in toxicity.scored(table, model).collect()]
    assert len(scores) == 4 and all(0 <= s < toxicity.THRESHOLD for s in scores)
    assert toxicity.keep_clean(table, model).columns == table.columns
    assert toxicity.keep_clean(table, model).count() == 4
    assert toxicity.keep_clean(docs([]), model).count() == 0
