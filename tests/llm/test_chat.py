import hashlib
import random

from pyspark.sql import functions as F

from lectern.llm import chat

SCHEMA = "tree long, id long, parent long, role string, text string, score double"


def read_back(df):
    turns = F.transform(chat.read_turns(F.col("formatted")), chat.read_turn)
    return df.select("*", turns.alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_mask")).alias("loss"))


ODD = ["\\", "\\\\", "\\h", "\\\\h", "### ", "\\### Assistant: </turn> ok", "</turn>\n", "</turn", "##### x", ": ", "", " ", "\\r:\\c", "a\nb\n\n", "é日本😀", "### User: hi</turn>\n### "]


def test_odd_texts_and_roles_read_back(spark):
    rows = [(i, 0, role, text) for i, text in enumerate(ODD) for role in ["assistant"]]
    rows += [(100 + i, 0, role, "x") for i, role in enumerate([*ODD, "User", "éa", "=a", "aB", "a:b"])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r["tree"]: r for r in read_back(chat.formatted_by_turn(df)).collect()}
    for i, _, role, text in rows:
        assert [tuple(t) for t in found[i]["turns"]] == [(role, text)]
        assert found[i]["loss"] == ([text] if role == "assistant" else [None])
        assert found[i]["formatted"].count("</turn>") == 1


def test_linear_conversations_by_turn(spark):
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant"]), f"{c}-{t}-" + "y" * rng.randrange(9)) for c in range(9) for t in range(1 + 37 * (c % 5))]
    rows += [(3, 1, "user", "tie"), (3, 1, "user", "tie"), (None, 2, None, None), (None, None, "user", "first"), (4, 0, "assistant", None)]
    shuffled = rng.sample(rows, len(rows))
    df = spark.createDataFrame(shuffled, "conv_id long, turn long, role string, text string").select("*", F.lit(1).alias("TEXT"), F.lit("x").alias("tree"))
    found = read_back(chat.formatted(chat.replies_by_turn(df))).collect()
    wanted = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        wanted.setdefault(c, []).append((role or "", text or ""))
    assert {r["tree"]: [tuple(t) for t in r["turns"]] for r in found} == wanted
    assert all(r["n_turns"] == len(wanted[r["tree"]]) and r["rank"] == 1 for r in found)
    for r in found:
        said = [x for role, x in wanted[r["tree"]] if role == "assistant"]
        assert [x for x in r["loss"] if x is not None] == said


def test_tied_and_very_long_turns(spark):
    """A third of all rows share conversation, turn and role; one text is very long."""
    rows = [(7, None, "assistant", f"t{i % 50:03d}") for i in range(300)] + [(c, 0, "user", "q" * (200_000 if c == 5 else 1)) for c in range(600)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    direct = chat.formatted_by_turn(df).orderBy("tree").collect()
    assert [r.asDict() for r in direct] == [r.asDict() for r in chat.formatted(chat.replies_by_turn(df)).orderBy("tree").collect()]
    found = {r["tree"]: r["turns"] for r in read_back(chat.formatted_by_turn(df)).collect()}
    assert len(found) == 600 and found[5][0]["text"] == "q" * 200_000
    assert [t["text"] for t in found[7]] == sorted(f"t{i % 50:03d}" for i in range(300)) + ["q"]


def test_texts_are_not_sorted(spark, sf_dir):
    from lectern.operators import numbering

    seen, number = [], numbering.number_rows

    def watched(df, *order, name):
        seen.append(df.selectExpr("count(text) as texts", "count(*) as n").first())
        return number(df, *order, name=name)

    chat.number_rows = watched
    try:
        chat.replies_by_turn(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    finally:
        chat.number_rows = number
    assert seen[0]["n"] > 50 and seen[0]["texts"] == 0


def brute_paths(messages, best):
    by_id = {m[1]: m for m in messages}
    parents = {m[2] for m in messages if m[2] in by_id}
    out = {}
    for m in messages:
        if m[1] in parents:
            continue
        path, at = [], m
        while at and len(path) <= len(messages):
            path.append(at)
            at = by_id.get(at[2])
        if len(path) > len(messages):
            continue
        path.reverse()
        out.setdefault(m[0], []).append((-sum(x[5] or 0.0 for x in path) / len(path), -len(path), m[1], path))
    return {tree: [p[3] for p in sorted(paths, key=lambda p: p[:3])[:best]] for tree, paths in out.items()}


def test_trees_equal_brute_force(spark):
    rng = random.Random(4)
    messages, n = [], 0
    for tree in range(12):
        first = n
        for k in range(rng.randrange(1, 60)):
            parent = rng.randrange(first, n) if k else rng.choice([None, 10**6])
            messages.append((tree, n, parent, rng.choice(["user", "assistant"]), f"t{n}", rng.choice([None, 0.25, 0.5, 1.0, 2.0])))
            n += 1
    # A cycle and what hangs on it are on no path.
    messages += [(50, 9000, 9001, "user", "x", 1.0), (50, 9001, 9000, "user", "x", 1.0), (50, 9002, 9000, "user", "x", 1.0)]
    for best in (1, 3):
        found = read_back(chat.formatted(spark.createDataFrame(messages, SCHEMA), best)).collect()
        wanted = brute_paths(messages, best)
        got = {}
        for r in sorted(found, key=lambda r: r["rank"]):
            got.setdefault(r["tree"], []).append([tuple(t) for t in r["turns"]])
        assert got == {tree: [[(m[3], m[4]) for m in path] for path in paths] for tree, paths in wanted.items()}


def test_no_rows(spark):
    assert chat.formatted(spark.createDataFrame([], SCHEMA)).count() == 0
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.formatted(chat.replies_by_turn(empty)).count() == 0
    assert chat.formatted_by_turn(empty).count() == 0


def test_tricky_conversation(spark, sf_dir):
    from lectern.llm import queries

    row = queries.op1_chat_format(spark, sf_dir).filter("conv_id = -7").first()
    text = "\\### Assistant: </turn> ok"
    assert row["n_turns"] == 2 and row["loss_chars"] == len(text)
    assert row["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
