"""Licence scans: cosine of TF-IDF vectors to templates, then inheritance by directory.

Every line of every text is a possible header. Lines, whole texts and windows of words,
which may begin and end inside lines, are compared with short templates, at every length. The weights of the templates' words follow from all texts; a word that no
template has counts as the rarest there is, so foreign words only lower a cosine. A file
without a header takes the licence of the nearest directory above it that has a licence
file.

Whole licences and the longer headers are ``Form``s: where the words that tell a licence
from its relatives stand in a text, the run of words around them, and the whole text, are
compared with the form. An SPDX identifier is read as it is.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import cached_property
from importlib import resources

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import once, pick, text_or_empty, texts
from lectern.staging import stage

#: A line or a text is a licence from this cosine on.
THRESHOLD = 0.8
#: Words of a window, times the template's. Lines and the whole text have no limit. Where no
#: word of the template comes twice in it, no longer window reaches THRESHOLD: of m words in
#: the template and more than 3m in the window, more than 2m are others, none of them weighs
#: less than a template's, so the squared cosine is below m / (m + 2m).
WINDOW_SPAN = 3

# How a header or a short licence file names its licence.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",
}

_TOKEN = re.compile(r"[^\W_]+")


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


@dataclass(frozen=True)
class Form:
    """A long way to name a licence. ``mark`` is a run of words that its relatives (AGPL, LGPL,
    other Creative Commons licences, two-clause BSD) lack, ``own`` the mark in ``text`` if
    that is the text of a relative."""

    licence: str
    text: str
    mark: str
    own: str | None = None

    @cached_property
    def counts(self) -> Counter:
        return Counter(tokens(self.text))

    @cached_property
    def place(self) -> tuple[int, int]:
        """Words before the mark, and all words."""
        words = f" {' '.join(tokens(self.text))} "
        at = words.index(f" {' '.join(tokens(self.own or self.mark))} ")
        return words[:at].count(" "), len(words.split())


def forms() -> list[Form]:
    """Full texts and the usual longer headers, read on the driver."""
    folder = resources.files("lectern.llm") / "licence_texts"

    def full(name: str) -> str:
        return (folder / f"{name}.txt").read_text("utf-8")

    cc, share = full("CC-BY-SA-4.0"), "Attribution-ShareAlike 4.0 International"
    gpl = (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    )
    return [
        Form("MIT", full("MIT"), "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
        Form("Apache-2.0", full("Apache-2.0"), "Apache License Version 2.0"),
        Form("GPL-3.0", full("GPL-3.0"), "GNU General Public License Version 3, 29 June 2007"),
        Form("GPL-3.0", gpl, "GNU General Public License as published by the Free Software Foundation, either version 3"),
        Form("MPL-2.0", full("MPL-2.0"), "Mozilla Public License Version 2.0"),
        Form("BSD-3-Clause", full("BSD-3-Clause"), "endorse or promote products derived from this software"),
        Form("CC-BY-SA-4.0", cc, share),
        Form("CC-BY-4.0", cc, "Attribution 4.0 International", share),
        Form("CC-BY-NC-4.0", cc, "Attribution-NonCommercial 4.0 International", share),
    ]


_SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*\(?([A-Za-z0-9.+-]+)")
#: What an SPDX identifier may add to a licence's name.
_SPDX_TAIL = re.compile(r"(?:-only|-or-later|\+)$")


def spdx(text: str, names: Mapping[str, str]) -> tuple[int, str] | None:
    """Line and licence of the first identifier that is one of ``names``."""
    for found in _SPDX.finditer(text):
        name = _SPDX_TAIL.sub("", found[1])
        if name in names:
            return text.count("\n", 0, found.start()), name
    return None


class Forms:
    """Cosines of runs of words to forms. A word's rarity is that among the forms."""

    def __init__(self, found: list[Form]):
        having = Counter(w for f in found for w in f.counts)
        self.unknown = math.log(1 + len(found)) + 1
        self.idf = {w: math.log((1 + len(found)) / (1 + n)) + 1 for w, n in having.items()}
        self.rows = []
        for f in found:
            vector = {w: n * self.idf[w] for w, n in f.counts.items()}
            length = math.sqrt(math.fsum(x * x for x in vector.values()))
            mark = tokens(f.mark)
            self.rows.append((f.licence, {w: x / length for w, x in vector.items()}, f" {' '.join(mark)} ", set(mark), *f.place))

    def cosine(self, words: list[str], vector: Mapping[str, float]) -> float:
        own = {w: n * self.idf.get(w, self.unknown) for w, n in Counter(words).items()}
        length = math.sqrt(math.fsum(x * x for x in own.values()))
        return math.fsum(x * vector.get(w, 0.0) for w, x in own.items()) / length if length else 0.0

    def matches(self, words: list[str], distinct: set[str], threshold: float) -> Iterator[tuple[float, int, int, str]]:
        """Score, begin, end and licence of each form found, once per form at its best."""
        joined = None
        for licence, vector, mark, needed, before, size in self.rows:
            if not needed <= distinct:
                continue
            joined = joined or f" {' '.join(words)} "
            best = (0.0, 0, 0)
            at = joined.find(mark)
            runs = {(0, len(words))} if at >= 0 else set()
            place = counted = 0
            while at >= 0:
                place += joined.count(" ", counted, at)
                counted = at
                start = max(0, place - before)
                runs.add((start, min(len(words), start + size)))
                at = joined.find(mark, at + 1)
            for start, stop in sorted(runs):
                best = max(best, (self.cosine(words[start:stop], vector), start, stop))
            if best[0] >= threshold:
                yield min(1.0, best[0]), best[1], best[2], licence


class Weights:
    """TF-IDF vectors from the number of texts that have each of the templates' words."""

    def __init__(self, templates: Mapping[str, str], having: Mapping[str, int], n_texts: int):
        def rarity(df: int) -> float:
            return math.log((1 + n_texts) / (1 + df)) + 1

        self.unknown = rarity(0)
        self.idf = {w: rarity(having.get(w, 0)) for t in templates.values() for w in tokens(t)}
        self.vectors = {}
        self.sizes = {name: len(tokens(t)) for name, t in templates.items()}
        for name in sorted(templates):
            vector = {w: n * self.idf[w] for w, n in Counter(tokens(templates[name])).items()}
            length = math.sqrt(math.fsum(x * x for x in vector.values()))
            if length:
                self.vectors[name] = {w: x / length for w, x in vector.items()}

    def best(self, words: list[str]) -> tuple[str | None, float]:
        """The nearest template and its cosine; of equal ones the first by name."""
        counts = Counter(words)
        own = {w: n * self.idf.get(w, self.unknown) for w, n in counts.items()}
        length = math.sqrt(math.fsum(x * x for x in own.values()))
        name, score = None, 0.0
        for template, vector in self.vectors.items():
            cosine = math.fsum(own[w] * x for w, x in vector.items() if w in own) / length if length else 0.0
            if cosine > score + 1e-12:
                name, score = template, cosine
        return name, min(1.0, score)

    def reachable(self, words: set[str], threshold: float) -> list[str]:
        """The templates that words of this set can match: no cosine exceeds the root of the
        squared weights that the words have in the template."""
        return [
            name
            for name, vector in self.vectors.items()
            if sum(x * x for w, x in vector.items() if w in words) >= threshold**2 * (1 - 1e-9)
        ]

    def windows(self, words: list[str], name: str) -> tuple[float, int, int]:
        """The best cosine of a run of words to a template, and where the run begins and ends.

        A best run begins and ends with a word of the template: other words at its ends
        only lower the cosine. It has at most ``WINDOW_SPAN`` times the template's words.
        """
        vector = self.vectors[name]
        places = [i for i, w in enumerate(words) if w in vector]
        most = WINDOW_SPAN * self.sizes[name]
        best = (0.0, 0, 0)
        for start in places:
            counts: dict[str, int] = {}
            dot = square = 0.0
            for i in range(start, min(len(words), start + most)):
                w = words[i]
                n = counts.get(w, 0)
                counts[w] = n + 1
                weight = self.idf.get(w, self.unknown)
                square += (2 * n + 1) * weight * weight
                x = vector.get(w)
                if x is not None:
                    dot += weight * x
                    if dot * dot > best[0] * best[0] * square * (1 + 1e-9):
                        best = (dot / math.sqrt(square), start, i + 1)
        return best

    def can_match(self, words: list[str], threshold: float) -> bool:
        """False only if no cosine can reach the threshold c: then less than c² of the squared
        length lies on words of templates. Other words are taken to differ, which can only
        make their share smaller."""
        known = Counter(w for w in words if w in self.idf)
        own = sum((n * self.idf[w]) ** 2 for w, n in known.items())
        other = (len(words) - known.total()) * self.unknown**2
        return own * (1 + 1e-9) >= threshold**2 * (own + other) and own > 0


def corpus_weights(files: DataFrame, templates: Mapping[str, str] = TEMPLATES, text: str = "text") -> Weights:
    """Weights by the counts of all texts. The templates' words alone are counted: a row for
    each of them reaches the driver."""
    words = sorted({w for t in templates.values() for w in tokens(t)})

    @once
    @F.arrow_udf("array<int>")
    def present(column: pa.Array) -> pa.Array:
        wanted = {w: i for i, w in enumerate(words)}
        found = [sorted({wanted[w] for w in set(tokens(t)) if w in wanted}) for t in texts(column)]
        return pa.array(found, pa.list_(pa.int32()))

    slim = pick(files, text=text).select(present("text").alias("p"))
    counts = slim.select(F.explode(F.concat("p", F.array(F.lit(-1)))).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    having = {r["w"]: r["n"] for r in counts.collect()}
    return Weights(templates, {words[w]: n for w, n in having.items() if w >= 0}, having.get(-1, 0))


def directory(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def ancestors(path: Column) -> Column:
    """The directories above a path, the root (an empty name) first."""
    parts = F.split(path, "/")
    depth = F.size(parts) - 1
    return F.transform(F.sequence(F.lit(0), depth), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def matched(files: DataFrame, weights: Weights, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``files`` (its columns kept) and ``match``: licence, score and ``line`` of the best
    line or of the window inside a line, -1 for the whole text or a window over several lines; an SPDX
    identifier goes before forms, forms before templates; null where none reaches the threshold."""

    # Forms of licences that are not asked for are none.
    long = Forms([f for f in forms() if f.licence in weights.sizes])

    @once
    @F.arrow_udf("struct<licence:string,score:double,line:int>")
    def match(column: pa.Array) -> pa.Array:
        rows = []
        for t in texts(column):
            best: tuple[float, int, str] | None = None
            lines = [(i, tokens(line)) for i, line in enumerate(t.split("\n"))]
            lines = [(i, words) for i, words in lines if words]
            distinct = {w for _, words in lines for w in words}
            whole = [w for _, words in lines for w in words]
            at = [i for i, words in lines for _ in words]
            if "spdx" in distinct and (named := spdx(t, weights.sizes)):
                best = (1.0, named[0], named[1])
            for score, start, stop, name in long.matches(whole, distinct, threshold):
                if best is None or score > best[0] + 1e-12:
                    best = (score, at[start] if at[start] == at[stop - 1] else -1, name)
            able = weights.reachable(distinct, threshold) if best is None else []
            if not able:
                rows.append({"licence": best[2], "score": best[0], "line": best[1]} if best else None)
                continue
            if 1 < len(lines):
                lines.append((-1, whole))
            for i, words in lines:
                if not weights.can_match(words, threshold):
                    continue
                name, score = weights.best(words)
                if name and score >= threshold and (best is None or score > best[0]):
                    best = (score, i, name)
            for name in able:
                score, start, stop = weights.windows(whole, name)
                if score >= threshold and (best is None or score > best[0] + 1e-12):
                    best = (min(1.0, score), at[start] if at[start] == at[stop - 1] else -1, name)
            rows.append({"licence": best[2], "score": best[0], "line": best[1]} if best else None)
        return pa.array(rows, pa.struct([("licence", pa.string()), ("score", pa.float64()), ("line", pa.int32())]))

    return files.withColumn("match", match(text))


def scan(
    files: DataFrame, templates: Mapping[str, str] = TEMPLATES, file_id: str = "doc_id", path: str = "path",
    text: str = "text", is_licence_file: str = "is_licence_file", threshold: float = THRESHOLD,
) -> DataFrame:
    """file_id, path, licence, ``found_in`` (header, directory or none), ``directory`` (that
    the licence is inherited from), score and line of the file's own match.

    Files with ``is_licence_file`` give their licence to their directory; of several there the
    commonest, of equally common ones the first by name. A null text is empty, a null path lies
    in no directory and inherits nothing, a null flag is false. Repeated rows stay. No rows:
    none. Extra columns are not carried.
    """
    slim = pick(files, file_id=file_id, path=path, text=text, flag=is_licence_file)
    weights = corpus_weights(slim, templates)
    found = stage(
        matched(slim, weights, "text", threshold).select(
            "file_id", "path", F.coalesce("flag", F.lit(False)).alias("flag"), "match.*"
        )
    )
    votes = (
        found.filter("flag and licence is not null and path is not null")
        .groupBy(directory(F.col("path")).alias("dir"), "licence")
        .agg(F.count("*").alias("n"))
    )
    first = Window.partitionBy("dir").orderBy(F.col("n").desc(), "licence")
    owners = stage(
        votes.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").select("dir", F.col("licence").alias("given"))
    )
    # Directories find their nearest licensed ancestor, once each however many files they
    # have; then files look up their directory.
    folders = found.filter("path is not null").select(directory(F.col("path")).alias("folder")).distinct()
    above = folders.select("folder", F.posexplode(ancestors(F.concat("folder", F.lit("/")))).alias("depth", "up"))
    nearest = (
        above.join(owners, F.col("up") == F.col("dir"))
        .groupBy("folder")
        .agg(F.max(F.struct("depth", "up", "given")).alias("x"))
        .select(F.col("folder").alias("_folder"), F.col("x.up").alias("up"), F.col("x.given").alias("given"))
    )
    nearest = stage(nearest)
    placed = found.withColumn("folder", directory(F.col("path")))
    own = F.col("licence").isNotNull()
    return placed.join(nearest, F.col("folder") == F.col("_folder"), "left").select(
        "file_id",
        "path",
        F.coalesce("licence", "given").alias("licence"),
        F.when(own, "header").when(F.col("given").isNotNull(), "directory").otherwise("none").alias("found_in"),
        F.when(~own, F.col("up")).alias("directory"),
        "score",
        "line",
    )


def closing_notice(text: Column) -> Column:
    """True where the last line that holds anything speaks of a licence."""
    last = F.substring_index(F.rtrim(text_or_empty(text), F.lit(" \n\r\t")), "\n", -1)
    return F.lower(last).rlike("licen[sc]e")
