"""Chat formatting of reply trees, in DataFrame operations.

A message names its parent; a path from a root to a leaf is one possible conversation.
Iterative self-joins double the reach of every message's link each round, so a tree of
depth d takes log2(d) rounds. On the way, scores add up to the score of each path. The
leaves of a tree are ranked by it, and only the chosen paths are enumerated, by the same
links again, and formatted.

Template. A turn is ``### Role: text</turn>`` and a line break. In roles and texts, what
could be taken for the template is written as a backslash and a letter, and a backslash as
two of them, so the marks occur nowhere else and every text reads back as it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import pick, text_or_empty
from lectern.operators.numbering import number_rows
from lectern.staging import stage

# The marks of the template and what replaces them inside of texts.
OPEN, BETWEEN, CLOSE = "### ", ": ", "</turn>"
SLASH = "\\"
ESCAPES = {OPEN: SLASH + "h", CLOSE: SLASH + "c"}
ROLE_ESCAPES = ESCAPES | {":": SLASH + "r"}
END = CLOSE + "\n"
#: Turns that are joined to one string before a conversation comes together.
RUN = 64
#: A role that does not begin with a to z is not shown in title case, but behind this.
AS_IT_IS = "="


def escaped(text: Column, escapes: dict[str, str] = ESCAPES) -> Column:
    out = F.replace(text, F.lit(SLASH), F.lit(SLASH * 2))
    for mark, short in escapes.items():
        out = F.replace(out, F.lit(mark), F.lit(short))
    return out


def unescaped(text: Column, escapes: dict[str, str] = ROLE_ESCAPES) -> Column:
    """Reads from the left, as every backslash either begins a pair or ends one: cut at
    the doubled ones first, then undo the rest."""

    def undo(part: Column) -> Column:
        for mark, short in escapes.items():
            part = F.replace(part, F.lit(short), F.lit(mark))
        return part

    parts = F.split(text, r"\\\\")
    return F.array_join(F.transform(parts, undo), SLASH)


def _by_turn(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Turns in order: ``tree``, ``id``, ``parent``, ``score``, ``role``, ``key``, ``tied``, ``text``; and
    the texts by ``_key``.

    What is sorted, sampled and numbered is conversation, turn and role. Only rows that share
    all three (``tied``) bring their text along, which decides their order.
    """
    slim = pick(rows, tree=conv_id, turn=turn, role=role, text=text).withColumns(
        {"role": text_or_empty(F.col("role")), "text": text_or_empty(F.col("text"))}
    )
    keys = "tree", "turn", "role"
    counts = slim.groupBy(*keys).agg(F.count("*").alias("n"))
    # Stored, its size is known: Catalyst broadcasts a short list and shuffles a long one.
    shared = stage(counts.filter("n > 1").select(F.struct(*keys).alias("_key")))
    texts = slim.select(F.struct(*keys).alias("_key"), "text")
    tied = texts.join(shared, "_key", "left_semi").select("_key.*", F.lit(True).alias("tied"), "text")
    alone = counts.filter("n = 1").select(*keys, F.lit(False).alias("tied"), F.lit(None).cast("string").alias("text"))
    order = [F.col(c).asc_nulls_first() for c in (*keys, "text")]
    numbered = stage(number_rows(alone.unionByName(tied), *order, name="id"))
    before = numbered.select((F.col("id") + 1).alias("id"), F.col("tree").alias("_tree"), F.lit(True).alias("_is"))
    same = F.col("_is") & F.col("tree").eqNullSafe(F.col("_tree"))
    placed = numbered.join(before, "id", "left").select(
        "tree", "id", F.when(same, F.col("id") - 1).alias("parent"), F.lit(0.0).alias("score"),
        "role", F.struct(*keys).alias("key"), "tied", "text",
    )
    return placed, texts


def _with_texts(placed: DataFrame, texts: DataFrame) -> DataFrame:
    """Looks the texts up that ``_by_turn`` left where they are."""
    alone = placed.filter("not tied").drop("text").join(texts, F.col("key") == F.col("_key")).drop("_key")
    return alone.unionByName(placed.filter("tied")).drop("key", "tied")


def replies_by_turn(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``tree``, ``id``, ``parent``, ``role``, ``text``, ``score`` of linear conversations:
    each turn replies to the one before.

    Ordered by turn, ties by role and text; a null turn comes first, a null role or text is
    empty, rows of a null conv_id are one conversation. Repeated rows are turns of their
    own. Rows are numbered over the whole sorted table, so no task holds a conversation.
    """
    placed, texts = _by_turn(rows, conv_id, turn, role, text)
    return _with_texts(placed, texts).select("tree", "id", "parent", "role", "text", "score")


def _links(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Round by round, each message's ancestor 2^k above (rows that have one); and for
    each message its depth and the score of the path that ends there."""
    ids = messages.select("id", "parent", "score")
    known = ids.select(F.col("id").alias("_id"))
    # A parent that is not there makes a root.
    first = stage(
        ids.join(known, F.col("parent") == F.col("_id"), "left").select(
            "id", F.col("_id").alias("up"), F.col("_id").isNotNull().cast("long").alias("depth"), F.col("score").alias("sum")
        )
    )
    ended, leading = first.filter("up is null"), first.filter("up is not null")
    rounds, messages_in_all = [], first.count()
    # No path has more messages than there are: what leads on after that is on a cycle.
    while 2 ** len(rounds) <= messages_in_all and not leading.isEmpty():
        rounds.append(leading.select("id", "up"))
        above = ended.unionByName(leading).select(
            F.col("id").alias("_id"), F.col("up").alias("_up"), F.col("sum").alias("_sum"), F.col("depth").alias("_depth")
        )
        # Only messages whose link still leads on are joined: up to the link they have
        # their own sums, from there those of the message it leads to.
        moved = stage(
            leading.join(above, F.col("up") == F.col("_id")).select(
                "id", F.col("_up").alias("up"), (F.col("depth") + F.col("_depth")).alias("depth"), (F.col("sum") + F.col("_sum")).alias("sum")
            )
        )
        ended, leading = ended.unionByName(moved.filter("up is null")), moved.filter("up is not null")
    return rounds, ended


def chosen_paths(messages: DataFrame, best: int = 1) -> DataFrame:
    """``leaf``, ``rank``, ``path_score``, ``id``, ``depth`` (0 at the root) for each message
    on the ``best`` paths of each tree.

    ``messages`` should be stored and ids unique. A path's score is the mean of its messages'
    scores, null as 0; equal scores go to the longer path, then to the smaller leaf id.
    Messages on a cycle, or below one, have no root and are on no path.
    """
    rounds, ends = _links(messages)
    trees = messages.select("id", "tree")
    parents = rounds[0].select(F.col("up").alias("id")).distinct() if rounds else None
    leaves = ends.join(parents, "id", "left_anti") if parents is not None else ends
    path_score = F.col("sum") / (F.col("depth") + 1)
    order = Window.partitionBy("tree").orderBy(
        F.col("path_score").desc(), F.col("depth").desc(), "id"
    )
    # The limit is applied in each task before the shuffle, so a tree of very many leaves
    # sends few.
    ranked = (
        leaves.join(trees, "id")
        .withColumn("path_score", path_score)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= best)
    )
    picked = stage(ranked.select(F.col("id").alias("leaf"), "rank", "path_score", "id"))
    # Each link takes all found so far 2^k up: every distance below 2^(k+1) is reached.
    members = picked.select("leaf", "id")
    for links in rounds:
        above = members.join(links, "id").select("leaf", F.col("up").alias("id"))
        members = stage(members.unionByName(above))
    depths = ends.select("id", "depth")
    return members.join(picked.drop("id"), "leaf").join(depths, "id")


def formatted(messages: DataFrame, best: int = 1) -> DataFrame:
    """One row for each of the ``best`` paths of each tree of ``messages`` (tree, id, parent,
    role, text, score; extra columns are not carried):

    tree, rank, path_score, leaf, n_turns, ``formatted`` and ``loss_mask``: an entry for each
    turn, null but for those of the assistant, where it says where the text stands in that
    turn's rendering, ``start`` and ``length`` in code points.

    Turns are rendered where they are; runs of 64 are joined first, so what comes together
    for a long conversation is few strings. No messages: no rows.
    """
    slim = stage(
        pick(messages, tree="tree", id="id", parent="parent", role="role", text="text", score="score").withColumns(
            {"role": text_or_empty(F.col("role")), "text": text_or_empty(F.col("text")), "score": F.coalesce("score", F.lit(0.0))}
        )
    )
    paths = chosen_paths(slim, best)
    return _conversations(paths.join(slim.select("id", "tree", "role", "text"), "id"))


def formatted_by_turn(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``formatted`` for the conversations of ``replies_by_turn``. Texts stay where they are
    until the paths are known, and are looked up once."""
    placed, texts = _by_turn(rows, conv_id, turn, role, text)
    placed = stage(placed)
    paths = chosen_paths(placed.select("tree", "id", "parent", "score"))
    return _conversations(_with_texts(paths.join(placed.drop("parent", "score"), "id"), texts))


def _conversations(turns: DataFrame) -> DataFrame:
    """Renders turns (tree, leaf, rank, path_score, depth, role, text) and joins each path's."""
    title = F.concat(F.upper(F.substring("role", 1, 1)), F.expr("substring(role, 2)"))
    name = F.when(F.col("role").rlike("^[a-z]"), escaped(title, ROLE_ESCAPES)).otherwise(
        F.concat(F.lit(AS_IT_IS), escaped(F.col("role"), ROLE_ESCAPES))
    )
    head = F.concat(F.lit(OPEN), name, F.lit(BETWEEN))
    turns = turns.select(
        "tree", "leaf", "rank", "path_score", "depth", "role", head.alias("head"), escaped(F.col("text")).alias("body")
    )
    mask = F.when(
        F.col("role") == "assistant",
        F.struct(F.length("head").alias("start"), F.length("body").alias("length")),
    )
    rendered = turns.select(
        "tree", "leaf", "rank", "path_score", "depth",
        F.concat("head", "body", F.lit(END)).alias("shown"), mask.alias("mask"),
    )
    run = F.floor(F.col("depth") / RUN)
    runs = (
        rendered.groupBy("tree", "leaf", "rank", "path_score", run.alias("run"))
        .agg(F.sort_array(F.collect_list(F.struct("depth", "shown", "mask"))).alias("turns"))
        .select(
            "tree", "leaf", "rank", "path_score", "run",
            F.size("turns").cast("long").alias("n"),
            F.array_join(F.col("turns.shown"), "").alias("shown"),
            F.col("turns.mask").alias("mask"),
        )
    )
    whole = runs.groupBy("tree", "leaf", "rank", "path_score").agg(
        F.sum("n").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("run", "shown", "mask"))).alias("runs"),
    )
    return whole.select(
        "tree", "rank", "path_score", "leaf", "n_turns",
        F.array_join(F.col("runs.shown"), "").alias("formatted"),
        F.flatten(F.col("runs.mask")).alias("loss_mask"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns' renderings, without what closes them."""
    parts = F.split(formatted, END)
    return F.slice(parts, 1, F.size(parts) - 1)


def read_turn(shown: Column) -> Column:
    """``role`` and ``text`` of a turn's rendering."""
    at = F.instr(shown, BETWEEN)
    name = F.substr(shown, F.lit(len(OPEN) + 1), at - len(OPEN) - 1)
    lowered = F.concat(F.lower(F.substr(name, F.lit(1), F.lit(1))), F.substr(name, F.lit(2)))
    exact = F.startswith(name, F.lit(AS_IT_IS))
    role = unescaped(F.when(exact, F.substr(name, F.lit(2))).otherwise(lowered))
    return F.struct(role.alias("role"), unescaped(F.substr(shown, at + len(BETWEEN))).alias("text"))


def read_loss(formatted: Column, loss_mask: Column) -> Column:
    """The texts under the loss mask, in order; null for the other turns."""

    def under(shown: Column, mask: Column) -> Column:
        return unescaped(F.substr(shown, mask["start"] + 1, mask["length"]))

    return F.zip_with(read_turns(formatted), loss_mask, under)
