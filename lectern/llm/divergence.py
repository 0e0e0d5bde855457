"""How far the sources of a language differ in their words.

Chunk factorization: whitespace chunks are counted per document, and every globally
distinct chunk is split into terms once; its terms are joined back to the counts. A chunk
that is a lower-case term as it stands has nothing to split or to join. The counting of a
task's documents is combined before anything is shuffled, so a frequent word costs one row
for each task and group.

Distinct documents: a chunk's row carries its number of documents, which is exact, and the
first and last of them. A term that several chunks hold ("word" and "word,") may meet the
same document in each. Three documents are certain where one chunk has three, and where
sources have three together; a group whose chunks have at most two is described in full by
its first and last ones, and only where these leave the number open its rows are looked at
again, for a document between the two. No list of documents is ever gathered.

Pairs of sources: a task reads the terms of its share in order, lays a block of them out as
a matrix of terms by sources and adds up each pair's values; no pair is emitted for a term.
The list of sources is broadcast: the result has a row for every two sources of a language,
so it is the square root of that result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import pick, staged_and_released, text_or_empty
from lectern.staging import stage

SCALE = 1_000_000_000
#: SCALE times a count below this one fits 64 bits.
LONGEST = (1 << 63) // SCALE - 1
MIN_DOCUMENTS = 3
TERM_RANKS = 200
#: Terms: ASCII letters and everything beyond ASCII.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Chunks that are their own only term.
PLAIN = r"\A[^\x00-\x60\x7B-\x7F]+\z"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes of text that a task counts at a time, and cells of a block of terms.
HELD = 1 << 23
CELLS = 1 << 20

_PARTS = "lang string, source string, chunk string, n long, documents long, first long, last long"


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most HELD bytes of text each, or one longer text."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + HELD, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def _count_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of each chunk per (lang, source), its documents, the first and the last."""
    for batch in batches:
        for piece in _pieces(batch):
            yield from _counted(piece)


def _counted(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    split = pc.ascii_split_whitespace(rows.column("text").cast(pa.large_string()))
    words, document = pc.list_flatten(split), pc.list_parent_indices(split)
    filled = pc.greater(pc.binary_length(words), 0)
    words, document = words.filter(filled), document.filter(filled).to_numpy()
    if not len(words):
        return
    encoded = words.dictionary_encode()
    code, n_codes = encoded.indices.to_numpy(), len(encoded.dictionary)

    # Each document's distinct chunks with their counts, by document.
    pairs, times = np.unique(document * n_codes + code, return_counts=True)
    document, code = pairs // n_codes, pairs % n_codes
    langs, sources = (rows.column(c).dictionary_encode() for c in ("lang", "source"))
    group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()

    # The same per group; documents stay in ascending order.
    key = group[document] * n_codes + code
    order = np.argsort(key, kind="stable")
    key, document = key[order], document[order]
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    ends = np.append(starts[1:], len(key))
    held = ends - starts
    row = rows.column("row").to_numpy()
    few = held < MIN_DOCUMENTS
    group, code = key[starts] // n_codes, key[starts] % n_codes
    yield pa.RecordBatch.from_arrays(
        [
            langs.dictionary.take(pa.array(group // len(sources.dictionary))),
            sources.dictionary.take(pa.array(group % len(sources.dictionary))),
            encoded.dictionary.take(pa.array(code)).cast(pa.string()),
            pa.array(np.add.reduceat(times[order], starts)),
            pa.array(held),
            pa.array(row[document[starts]], mask=~few),
            pa.array(row[document[ends - 1]], mask=~few),
        ],
        ["lang", "source", "chunk", "n", "documents", "first", "last"],
    )


def _held_by_enough(counts: DataFrame, rows: DataFrame) -> DataFrame:
    """(lang, term) of at least MIN_DOCUMENTS documents and the term's occurrences ``n_lang``,
    from ``rows`` of a term per chunk and from ``counts`` of them per group. Groups part the
    documents, so their numbers add up."""
    certain = F.when(F.col("most") >= MIN_DOCUMENTS, MIN_DOCUMENTS).otherwise(
        F.when(F.col("low") == F.col("high"), 1).otherwise(2)
    )
    more_possible = (F.col("most") < MIN_DOCUMENTS) & (F.col("low") < F.col("high")) & (F.col("met") > 2)
    terms = counts.groupBy("lang", "term").agg(
        F.sum(certain).alias("documents"),
        F.bool_or(more_possible).alias("open"),
        F.sum("n").alias("n_lang"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )
    terms = stage(terms.filter("documents >= 3 or open"))
    # Two documents are certain, in one group, which met more than two times: its rows, the
    # only ones of the term, tell whether another document lies between them.
    between = [(F.col(c) > F.col("low")) & (F.col(c) < F.col("high")) for c in ("first", "last")]
    third = (
        rows.select("lang", "term", "first", "last")
        .filter("first is not null")
        .join(terms.filter("documents < 3").drop("documents", "open"), ["lang", "term"])
        .filter(between[0] | between[1])
        .select("lang", "term", "n_lang")
        .distinct()
    )
    return terms.filter("documents >= 3").select("lang", "term", "n_lang").unionByName(stage(third))


def term_counts(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Groups (lang, source) of the documents; the terms that at least MIN_DOCUMENTS documents
    of their language hold, with their occurrences: (lang, term, n_lang); and, stored, those
    of each group: (lang, source, term, n, n_lang).

    A row is a document, whatever its id. Null text, lang and source count as empty.
    """
    rows = pick(docs, lang="lang", source="source", text="text").select(
        *[text_or_empty(F.col(c)).alias(c) for c in ("lang", "source", "text")]
    )
    groups = rows.select("lang", "source").distinct()
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    parts = numbered.mapInArrow(_count_chunks, _PARTS)
    low, high = F.min("first"), F.max("last")
    enough = F.sum("documents") >= MIN_DOCUMENTS
    chunks = staged_and_released(
        parts.groupBy("lang", "source", "chunk").agg(
            F.sum("n").alias("n"),
            F.sum("documents").alias("documents"),
            F.when(~enough, low).alias("first"),
            F.when(~enough, high).alias("last"),
        ).withColumn("plain", F.col("chunk").rlike(PLAIN))
    )
    mixed = chunks.filter("not plain")
    found = F.regexp_extract_all("chunk", F.lit(TERM), F.lit(0))
    lowered = F.transform(found, lambda t: F.translate(t, _UPPER, _UPPER.lower()))
    terms = (
        mixed.select("chunk")
        .distinct()
        .select("chunk", F.explode(lowered).alias("term"))
        .groupBy("chunk", "term")
        .agg(F.count("*").alias("times"))
    )
    joined = staged_and_released(
        mixed.join(terms, "chunk").select(
            "lang", "source", "term", (F.col("n") * F.col("times")).alias("n"), "documents", "first", "last"
        )
    )
    split = chunks.filter("plain").withColumnRenamed("chunk", "term").select(*joined.columns).unionByName(joined)
    counts = staged_and_released(
        split.groupBy("lang", "source", "term").agg(
            F.sum("n").alias("n"),
            F.max("documents").alias("most"),
            F.min("first").alias("low"),
            F.max("last").alias("high"),
            F.sum(F.when(F.col("first").isNotNull(), F.col("documents"))).alias("met"),
        )
    )
    kept = _held_by_enough(counts, split)
    # A term of very many sources is one key; the adaptive skew join splits it.
    used = counts.select("lang", "source", "term", "n").join(kept, ["lang", "term"])
    return groups, kept, staged_and_released(used)


def share(count: Column, total: Column, terms: Column) -> Column:
    """p: a smoothed share in billionths, exact at any size of the counts; 64 bits do for most."""
    scaled = F.lit(SCALE).cast("decimal(38,0)") * (count + 1).cast("decimal(38,0)")
    exact = F.call_function("div", scaled, (total + terms).cast("decimal(38,0)"))
    short = F.call_function("div", F.lit(SCALE).cast("long") * (count + 1), total + terms)
    return F.when(count < LONGEST, short).otherwise(exact) + 1


def _divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


class _Pairs:
    """Values of all pairs of sources of each language, over this task's terms."""

    def __init__(self, sources: dict[str, list[tuple[str, int]]]):
        #: lang -> (source, share of a term that it lacks), in the order of the matrix.
        self.sources = sources

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (lang, term, source, p), those of a term together."""
        lang, term, at = None, None, -1
        names, absent, matrix, total = [], None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            langs, terms, sources = (batch.column(c) for c in ("lang", "term", "source"))
            shares = batch.column("p").to_numpy()
            other_lang, other_term = (
                pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False) for c in (langs, terms)
            )
            runs = [0, *(np.flatnonzero(other_lang) + 1), len(shares)]
            for start, stop in zip(runs, runs[1:]):
                if langs[start].as_py() != lang:
                    yield from self._out(lang, matrix, at, total)
                    lang, term, at = langs[start].as_py(), None, -1
                    names = self.sources[lang]
                    absent = np.array([q for _, q in names], dtype=np.int64)
                    matrix = np.tile(absent, (max(1, CELLS // len(names)), 1))
                    total = np.zeros((len(names), len(names)), dtype=np.int64)
                new = np.append(terms[start].as_py() != term, other_term[start : stop - 1])
                place = pc.index_in(sources.slice(start, stop - start), pa.array([n for n, _ in names], pa.string()))
                at = self._lay(matrix, total, absent, at + np.cumsum(new), place.to_numpy(), shares[start:stop])
                term = terms[stop - 1].as_py()
        yield from self._out(lang, matrix, at, total)

    def _lay(self, matrix, total, absent, at, place, shares) -> int:
        """Lay shares out at their terms' lines; a full block is added up and begun anew."""
        start = 0
        while start < len(at):
            stop = int(np.searchsorted(at, len(matrix)))
            matrix[at[start:stop], place[start:stop]] = shares[start:stop]
            if stop < len(at):
                self._add(matrix, total)
                matrix[:] = absent
                at = at - len(matrix)
            start = stop
        return int(at[-1])

    @staticmethod
    def _add(matrix: np.ndarray, total: np.ndarray) -> None:
        for i in range(total.shape[0]):
            apart = matrix[:, i : i + 1] - matrix
            total[i] += (apart * apart // matrix).sum(axis=0)

    def _out(self, lang, matrix, at, total) -> Iterator[pa.RecordBatch]:
        if lang is None:
            return
        self._add(matrix[: at + 1], total)
        names = [name for name, _ in self.sources[lang]]
        for i, name in enumerate(names):
            others = [j for j in range(len(names)) if j != i]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(others), pa.string()),
                    pa.array([name] * len(others), pa.string()),
                    pa.array([names[j] for j in others], pa.string()),
                    pa.array(total[i, others]),
                ],
                ["lang", "source", "item", "value"],
            )


def _ranked(found: DataFrame, part: str, ranks: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = found.withColumn("rank", F.row_number().over(order))
    if ranks is not None:
        # Each task keeps its own first ranks of a group before the shuffle.
        ranked = ranked.filter(F.col("rank") <= ranks)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def audit(docs: DataFrame, term_ranks: int = TERM_RANKS) -> DataFrame:
    """Part ``pair``: for each source of a language every other one, by the divergence over all
    kept terms; part ``term``: a source's first ``term_ranks`` terms that it uses more than
    its language.

    A group without terms (empty, null or blank texts, or none that three documents hold)
    still has its pairs, by the shares of absent terms; a language without kept terms gives
    0 for each pair. A lone source has no pair. Rows that repeat are documents of their own.
    No rows give no rows; extra columns are not read.
    """
    groups, terms, kept = term_counts(docs)
    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n_lang").alias("total_lang"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = stage(
        groups.join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select(
            "lang",
            "source",
            *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("total", "v", "total_lang")],
        )
    )
    sized = kept.join(sizes, ["lang", "source"])
    p, q = (share(F.col(n), F.col(total), F.col("v")) for n, total in (("n", "total"), ("n_lang", "total_lang")))
    used = sized.select("lang", "term", "source", p.alias("p"))
    above = (
        sized.select("lang", "source", "term", p.alias("p"), q.alias("q"))
        .filter("p > q")
        .select("lang", "source", F.col("term").alias("item"), _divergence(F.col("p"), F.col("q")).alias("value"))
    )

    # One entry for each source: the result has a row for every two of a language.
    listed: dict[str, list[tuple[str, int]]] = {}
    absent = share(F.lit(0).cast("long"), F.col("total"), F.col("v"))
    for row in sizes.filter("v > 0").select("lang", "source", absent.alias("p")).orderBy("lang", "source").toLocalIterator():
        listed.setdefault(row["lang"], []).append((row["source"], row["p"]))
    together = used.repartition("lang", "term").sortWithinPartitions("lang", "term")
    sums = together.mapInArrow(_Pairs(listed), "lang string, source string, item string, value long")
    other = sizes.select("lang", F.col("source").alias("item"))
    pairs = (
        sizes.select("lang", "source")
        .join(other, "lang")
        .filter("source != item")
        .withColumn("value", F.lit(0).cast("long"))
        .unionByName(sums)
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
    )
    return _ranked(pairs, "pair").unionByName(_ranked(above, "term", term_ranks))
