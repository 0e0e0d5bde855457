"""Merkle manifest of a dataset, with an inclusion proof for every row by pointer jumping.

A leaf is the digest of a row. Per tree (a language), every eight consecutive nodes of a
level become their parent, up to the subroot; the subroots are the leaves of one top tree.
Eight leaves and their parent form a *run*, and runs are the nodes that jump: each holds
the siblings on its way to an ancestor, at first only to its parent. A self-join looks up
that ancestor's own way and joins the two, so the distance doubles per round and a tree of
13 levels (5e11 rows) takes four. Leaves, seven eighths of all nodes, are never joined:
they are written out from their run once it holds its way to the root.

Nothing is gathered but runs of eight. A node at distance d above others has at most 8^d of
them below; from the third round on the joining rows are dealt over 8^(d-2) salts, so at
most 64 meet at one key, and the ancestors are repeated for each salt, a 64th of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import pick
from lectern.operators.numbering import number_rows
from lectern.staging import stage

FAN = 8
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The top tree's name; a language's tree is named by a letter and the language.
TOP = "top"


def _field(value: Column, text: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf_digest(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """SHA-256 of a row's fields, 32 bytes."""
    fields = [
        _field(doc_id, doc_id.cast("string")),
        _field(source, source),
        _field(lang, lang),
        _field(n_chars, n_chars.cast("string")),
        _field(text, text),
    ]
    return F.unhex(F.sha2(F.concat(*fields), 256))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _LETTERS, _LETTERS.lower())


def shown(digest: Column) -> Column:
    """A digest as lowercase hex text."""
    return F.lower(F.hex(digest))


def _joined(digests: Column) -> Column:
    return F.array_join(F.transform(digests, shown), "")


def _hash_of(digests: Column) -> Column:
    return F.unhex(F.sha2(_joined(digests), 256))


def _own_step(siblings: Column, place: Column) -> Column:
    """The siblings to the left and to the right of one of a run, each as one binary."""
    left = F.slice(siblings, F.lit(1), place)
    right = F.slice(siblings, place + 2, F.lit(FAN))
    return F.struct(
        F.aggregate(left, F.lit(b""), lambda a, d: F.concat(a, d)).alias("left"),
        F.aggregate(right, F.lit(b""), lambda a, d: F.concat(a, d)).alias("right"),
    )


def _level_up(nodes: DataFrame) -> DataFrame:
    """Runs of eight of a level (tree, index, n, digest), ``n`` nodes in the tree's level:
    (tree, up, n of the next level, digest of the run, members in order)."""
    runs = nodes.groupBy("tree", F.floor(F.col("index") / FAN).alias("up"), "n").agg(
        F.sort_array(F.collect_list(F.struct("index", "digest"))).alias("members")
    )
    return runs.select(
        "tree",
        "up",
        F.ceil(F.col("n") / FAN).alias("n"),
        "members",
        _hash_of(F.col("members.digest")).alias("digest"),
    )


def _steps(runs: DataFrame, level: int) -> DataFrame:
    """The nodes of a level, each with its pointer to its parent and its own step."""
    place = F.col("member.index") % FAN
    return runs.select(
        "tree", "up", F.col("members.digest").alias("_all"), F.explode("members").alias("member")
    ).select(
        "tree",
        F.lit(level).alias("level"),
        F.col("member.index").alias("index"),
        F.col("tree").alias("up_tree"),
        F.lit(level + 1).alias("up_level"),
        F.col("up").alias("up_index"),
        F.array(_own_step(F.col("_all"), place.cast("int"))).alias("way"),
    )


def _climb(nodes: DataFrame, level: int) -> tuple[list[DataFrame], DataFrame, int]:
    """All levels above ``nodes`` (tree, index, n, digest): the linked nodes of each level, the
    nodes without a parent (tree, level, digest), and the level that holds the last of them."""
    linked, ended = [], []
    while True:
        ended.append(nodes.filter("n = 1").select("tree", F.lit(level).alias("level"), "digest"))
        below = nodes.filter("n > 1")
        if below.isEmpty():
            break
        runs = stage(_level_up(below))
        linked.append(_steps(runs, level))
        nodes = runs.select("tree", F.col("up").alias("index"), "n", "digest")
        level += 1
    roots = ended[0]
    for more in ended[1:]:
        roots = roots.unionByName(more)
    return linked, roots, level


def _jump(nodes: DataFrame, distance: int) -> DataFrame:
    """Double the distance of every node's pointer. A node that points at a root keeps its way.

    ``nodes`` (tree, level, index, up_tree, up_level, up_index, way, subroot); a root is no
    row of its own, so a pointer at it finds nothing."""
    salts = FAN ** max(distance - 2, 0)
    above = nodes.filter(F.col("level") >= distance).select(
        F.col("tree").alias("up_tree"),
        F.col("level").alias("up_level"),
        F.col("index").alias("up_index"),
        F.struct("up_tree", "up_level", "up_index").alias("_further"),
        F.col("way").alias("_way"),
        F.col("subroot").alias("_subroot"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"),
    )
    key = ["up_tree", "up_level", "up_index", "_salt"]
    dealt = nodes.withColumn("_salt", (F.col("index") % salts).cast("int"))
    return dealt.join(above, key, "left").select(
        "tree",
        "level",
        "index",
        *[F.coalesce(f"_further.{c}", c).alias(c) for c in key[:-1]],
        F.when(F.col("_way").isNull(), F.col("way")).otherwise(F.concat("way", "_way")).alias("way"),
        F.coalesce("subroot", "_subroot").alias("subroot"),
    )


def _fold(leaf: Column, way: Column) -> Column:
    """The root that a leaf and the siblings on its way give."""
    return F.aggregate(
        way,
        leaf,
        lambda below, step: F.unhex(
            F.sha2(F.concat(shown(step["left"]), shown(below), shown(step["right"])), 256)
        ),
    )


def proofs(leaves: DataFrame) -> DataFrame:
    """``leaves`` (tree string, tree_order, doc_id, leaf binary, tampered binary or null): each
    with subroot, root, proof and the root folded from the tampered leaf, else the leaf.

    A tree orders its leaves by doc_id, null first, then by digest: rows with one id have a
    fixed place, and equal rows have equal digests. A tree of one leaf is that leaf. No rows
    give no rows. ``tree_order`` is the tree's place among all trees, ascending, null first.
    """
    # The order's own columns only: digests are short, texts are not read again.
    order = [F.col(c).asc_nulls_first() for c in ("tree_order", "doc_id", "leaf", "tampered")]
    placed = stage(number_rows(leaves, *order))
    firsts = placed.groupBy("tree").agg(
        F.min("position").alias("_first"), F.count("*").alias("n"), F.first("tree_order").alias("tree_order")
    )
    firsts = stage(firsts)
    # One row for each tree: joined by what its measured size allows, a hot tree's rows split.
    nodes = stage(
        placed.join(firsts.drop("tree_order"), "tree").select(
            "tree", (F.col("position") - F.col("_first")).alias("index"), "n", "doc_id", "leaf", "tampered"
        )
    )
    if nodes.isEmpty():
        return _empty(leaves)

    runs = nodes.groupBy("tree", F.floor(F.col("index") / FAN).alias("index"), "n").agg(
        F.sort_array(F.collect_list(F.struct("index", "doc_id", "leaf", "tampered"))).alias("members")
    )
    # A lone leaf has no parent: its run is the leaf itself.
    alone = F.col("n") == 1
    digest = F.when(alone, F.col("members")[0]["leaf"]).otherwise(_hash_of(F.col("members.leaf")))
    runs = stage(runs.select("tree", "index", F.ceil(F.col("n") / FAN).alias("n"), "members", alone.alias("alone"), digest.alias("digest")))

    linked, subroots, height = _climb(runs.select("tree", "index", "n", "digest"), 1)
    subroots = stage(subroots)
    ranked = number_rows(
        firsts.select("tree", "tree_order").join(subroots, "tree"), F.col("tree_order").asc_nulls_first()
    )
    tops = stage(ranked.select("tree", "level", "digest", (F.col("position") - 1).alias("index")))
    n_trees = tops.count()
    # The top tree's leaves take the level above all subroots, so levels never fall on a way.
    base = height + 1
    upper, top_root, _ = _climb(
        tops.select(F.lit(TOP).alias("tree"), "index", F.lit(n_trees).cast("long").alias("n"), "digest"), base
    )
    # A subroot is one with its leaf of the top tree: what pointed at it points there.
    ends = tops.select(
        "tree", F.col("level").alias("_level"), F.col("index").alias("_place"), F.col("digest").alias("_subroot")
    )
    ways = _no_links(nodes)
    for level in linked:
        ways = ways.unionByName(level)
    ways = ways.join(
        ends, (ways.up_tree == ends.tree) & (ways.up_level == ends._level), "left"
    ).select(
        ways.tree,
        "level",
        "index",
        F.when(F.col("_place").isNull(), F.col("up_tree")).otherwise(F.lit(TOP)).alias("up_tree"),
        F.when(F.col("_place").isNull(), F.col("up_level")).otherwise(F.lit(base)).alias("up_level"),
        F.coalesce("_place", "up_index").alias("up_index"),
        "way",
        F.col("_subroot").alias("subroot"),
    )
    for level in upper:
        ways = ways.unionByName(level.withColumn("subroot", F.lit(None).cast("binary")))
    # A run that is its tree's subroot starts in the top tree.
    starts = tops.filter("level = 1").select(
        "tree",
        F.lit(TOP).alias("_tree"),
        F.lit(base).alias("_level"),
        F.col("index").alias("_index"),
        F.col("digest").alias("_own"),
    )

    longest = (height - 1) + len(upper)
    ways, distance = stage(ways), 1
    while distance < longest:
        ways, distance = stage(_jump(ways, distance)), distance * 2

    found = runs.join(starts, "tree", "left").select(
        F.coalesce("_tree", "tree").alias("tree"),
        F.coalesce("_level", F.lit(1)).alias("level"),
        F.coalesce("_index", "index").alias("index"),
        "members",
        "alone",
        "_own",
    )
    found = found.join(ways.select("tree", "level", "index", "way", "subroot"), ["tree", "level", "index"], "left")
    empty = F.array().cast("array<struct<left:binary,right:binary>>")
    each = found.select(
        F.coalesce("way", empty).alias("_way"),
        F.coalesce("_own", "subroot").alias("subroot"),
        F.col("members.leaf").alias("_all"),
        "alone",
        F.explode("members").alias("_m"),
    )
    own = F.when(F.col("alone"), empty).otherwise(
        F.array(_own_step(F.col("_all"), (F.col("_m.index") % FAN).cast("int")))
    )
    whole = each.select(
        F.col("_m.doc_id").alias("doc_id"),
        F.col("_m.leaf").alias("leaf"),
        F.coalesce("_m.tampered", "_m.leaf").alias("_start"),
        "subroot",
        F.concat(own, "_way").alias("_way"),
    )
    folded = _fold(F.col("_start"), F.col("_way"))
    steps = F.transform("_way", lambda s: F.concat(shown(s["left"]), shown(s["right"])))
    return (
        whole.withColumn("_root", top_root.select("digest").scalar())
        .select(
            "doc_id",
            shown(F.col("leaf")).alias("leaf"),
            shown(F.col("subroot")).alias("subroot"),
            shown(F.col("_root")).alias("root"),
            F.sha2(F.array_join(steps, ""), 256).alias("proof_sha256"),
            shown(folded).alias("folded_root"),
        )
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )


def _no_links(nodes: DataFrame) -> DataFrame:
    """No rows, of the shape of linked nodes: all trees may have one run only."""
    empty = nodes.limit(0).select(
        "tree", "index", F.lit(1).alias("up"), F.array(F.struct("index", F.col("leaf").alias("digest"))).alias("members")
    )
    return _steps(empty, 1)


def _empty(leaves: DataFrame) -> DataFrame:
    names = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
    return leaves.limit(0).select(
        "doc_id", *[F.lit("").alias(n) for n in names], F.lit(True).alias("verified")
    )


def manifest(docs: DataFrame) -> DataFrame:
    """Leaf, subroot of the row's language, root and proof of every row, and whether the row
    still gives that root after tampering.

    Tampered are rows whose id's CRC-32 is divisible by 3 (never a null id): the text's A-Z
    are lower-cased. A null field hashes as ``-`` and differs from an empty one. A null
    language is a tree of its own and comes first; ids may be null (first) or repeat. Extra
    columns are not read. No rows give no rows.
    """
    rows = pick(docs, doc_id="doc_id", source="source", lang="lang", n_chars="n_chars", text="text")
    doc_id, source, lang, n_chars, text = (F.col(c) for c in rows.columns)
    changed = F.crc32(doc_id.cast("string")) % 3 == 0
    leaves = rows.select(
        "doc_id",
        F.concat(F.when(lang.isNull(), F.lit("-")).otherwise(F.lit("+")), F.coalesce(lang, F.lit(""))).alias("tree"),
        F.col("lang").alias("tree_order"),
        leaf_digest(doc_id, source, lang, n_chars, text).alias("leaf"),
        F.when(changed, leaf_digest(doc_id, source, lang, n_chars, lower_ascii(text))).alias("tampered"),
    )
    return proofs(stage(leaves))
