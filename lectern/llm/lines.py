"""Quality rules by line labelling.

A linear-chain conditional random field over the lines of a text marks each one as content
or boilerplate; Viterbi decoding finds the best labelling as a whole, so that a line's
neighbours count. The share of a text's words on content lines decides whether it stays.
The field is trained here, by likelihood, on a bounded sample of labelled texts: the lines
of a good text as content, those of a bad one as boilerplate.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import extend, once, pick, texts

#: Labelled texts of each class that the field is trained on, at most, and the length and
#: lines of such a text, at most. Together they bound what reaches the driver.
SAMPLE_TEXTS = 800
SAMPLE_CHARS = 20_000
SAMPLE_LINES = 40
#: A text stays if at least this share of its words is on content lines.
CONTENT_SHARE = 0.5

SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
#: In percent.
MOST_REPEATED = 30
_SPACES = " \t\n\v\f\r"

FEATURES = (
    "symbols", "bars", "capitals", "exclamations", "digits", "same word before", "repeated words",
    "line seen before", "long words", "few words", "sentence end", "letters",
)


@dataclass(frozen=True)
class Measures:
    """Counts of a whole text that the base rules use."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int

    @property
    def base_failed(self) -> bool:
        return self.n_words < LEAST_WORDS or 100 * self.n_repeat_words > MOST_REPEATED * self.n_words


def _repeated(words: list[bytes]) -> int:
    """Words in a window of 8 words that stands in the text twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int32)
    # Without a word that occurs twice no window does.
    if len(number) == len(words):
        return 0
    raw = ids.tobytes()
    windows = [raw[i : i + 4 * WINDOW] for i in range(0, 4 * n, 4)]
    if len(set(windows)) == n:
        return 0
    times = Counter(windows)
    starts = np.fromiter((times[w] > 1 for w in windows), bool, n)
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(starts)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def measure(text: str) -> Measures:
    words = text.encode("utf-8", "surrogatepass").split()
    seen: set[str] = set()
    duplicates = 0
    for line in text.split("\n"):
        if line.strip(_SPACES):
            duplicates += line in seen
            seen.add(line)
    return Measures(
        len(words),
        len(text) - sum(text.count(c) for c in _SPACES),
        sum(text.count(c) for c in SYMBOLS),
        duplicates,
        _repeated(words),
    )


_BARE = re.compile(r"[\W_]+")


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """For each line with a word: its features, each from 0 to 1, and its words."""
    rows, weights, seen = [], [], set()
    for line in text.split("\n"):
        words = line.split()
        n = len(words)
        if not n:
            continue
        chars = len(line)
        low = line.lower()
        counted = len(set(low.split()))
        same = sum(map(str.__eq__, words, words[1:]))
        symbols = sum(line.count(c) for c in SYMBOLS)
        upper = sum(map(str.isupper, words))
        letters = sum(map(len, words))
        rows.append(
            (
                min(1.0, symbols / n),
                min(1.0, 2 * line.count("|") / n),
                upper / n if n > 2 or upper < n else 0.5,
                min(1.0, line.count("!") / n),
                min(1.0, sum(map(str.isdigit, words)) * 2 / n),
                same / max(1, n - 1),
                1 - counted / n if n > 3 else 0.0,
                float(line in seen),
                max(0.0, min(1.0, (letters / n - 4) / 8)),
                1.0 if n < 4 else 0.0,
                float(line.rstrip()[-1:] in ".?!:;\"'”"),
                1 - (n - 1) / max(1, chars),
            )
        )
        seen.add(line)
        weights.append(n)
    return np.array(rows, np.float64).reshape(len(rows), len(FEATURES)), np.array(weights, np.int64)


@dataclass(frozen=True)
class LineField:
    """Weights of a two-label chain; label 1 is content."""

    emission: np.ndarray  # (features + 1, 2), the last row a constant
    transition: np.ndarray  # (2, 2), from, to
    start: np.ndarray  # (2,)

    def scores(self, features: np.ndarray) -> np.ndarray:
        return features @ self.emission[:-1] + self.emission[-1]

    def decode(self, features: np.ndarray) -> np.ndarray:
        """The best labelling (Viterbi); of equal ones, content."""
        scores = self.scores(features).tolist()
        if not scores:
            return np.zeros(0, np.int64)
        (a, b), (c, d) = self.transition.tolist()
        bad, good = (s + e for s, e in zip(self.start.tolist(), scores[0]))
        back = []
        for x, y in scores[1:]:
            back.append((int(good + c >= bad + a), int(good + d >= bad + b)))
            bad, good = max(bad + a, good + c) + x, max(bad + b, good + d) + y
        label = int(good >= bad)
        path = [label]
        for step in reversed(back):
            label = step[label]
            path.append(label)
        return np.array(path[::-1])

    def content_share(self, text: str) -> float:
        """Share of the words on content lines; 0 for a text without words."""
        features, weights = line_features(text)
        if not len(weights):
            return 0.0
        return float((self.decode(features) * weights).sum() / weights.sum())


def train_field(
    sequences: list[np.ndarray], labels: list[int], steps: int = 200, rate: float = 0.1, ridge: float = 1e-3
) -> LineField:
    """Maximum likelihood by gradient (Adam), all sequences at once, padded by length.

    No sequence: a field that calls every line content.
    """
    width = len(FEATURES)
    if not sequences:
        emission = np.zeros((width + 1, 2))
        emission[-1] = (-1.0, 1.0)
        return LineField(emission, np.zeros((2, 2)), np.zeros(2))
    longest = max(map(len, sequences))
    x = np.zeros((len(sequences), longest, width + 1))
    mask = np.zeros((len(sequences), longest), bool)
    for i, s in enumerate(sequences):
        x[i, : len(s), :width], x[i, : len(s), width], mask[i, : len(s)] = s, 1.0, True
    y = np.array(labels)
    # Both classes weigh the same, whatever the sample holds of them.
    weight = np.where(y == 1, 1 / max(1, (y == 1).sum()), 1 / max(1, (y == 0).sum()))
    weight = weight[:, None, None] / mask.sum(1)[:, None, None]
    gold = np.eye(2)[y][:, None, :] * mask[..., None]
    theta = [np.zeros((width + 1, 2)), np.zeros((2, 2)), np.zeros(2)]
    first = [np.zeros_like(t) for t in theta]
    second = [np.zeros_like(t) for t in theta]

    def log_sum(a: np.ndarray, axis: int) -> np.ndarray:
        top = a.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    for step in range(1, steps + 1):
        emission, transition, start = theta
        e = x @ emission
        forward, backward = np.zeros_like(e), np.zeros_like(e)
        forward[:, 0] = e[:, 0] + start
        for t in range(1, longest):
            new = log_sum(forward[:, t - 1, :, None] + transition, 1) + e[:, t]
            forward[:, t] = np.where(mask[:, t, None], new, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            new = log_sum(transition + (e[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(mask[:, t + 1, None], new, backward[:, t])
        total = log_sum(forward[:, -1], 1)[:, None, None]
        node = np.exp(forward + backward - total) * mask[..., None]
        pair = np.exp(
            forward[:, :-1, :, None] + transition + (e + backward)[:, 1:, None, :] - total[..., None]
        ) * mask[:, 1:, None, None]
        same = (gold[:, :-1, :, None] * gold[:, 1:, None, :])
        grads = [
            np.einsum("ntf,ntl->fl", x, (node - gold) * weight),
            ((pair - same) * weight[..., None]).sum((0, 1)),
            ((node - gold) * weight)[:, 0].sum(0),
        ]
        for i, g in enumerate(grads):
            g = g + ridge * theta[i]
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            theta[i] = theta[i] - rate * (first[i] / (1 - 0.9**step)) / (
                np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8
            )
    return LineField(*theta)


def sampled_field(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality"
) -> LineField:
    """A field trained on at most ``SAMPLE_TEXTS`` labelled texts of each class.

    The ids of least hash are the sample, whatever the size of the corpus; texts above
    ``SAMPLE_CHARS`` are left out of it. Rows with a null id or label do not count.
    """
    marked = pick(labels, doc_id=doc_id, quality=quality).filter("doc_id is not null")
    known = pick(docs, doc_id=doc_id, text=text).filter(F.length("text") <= SAMPLE_CHARS)
    ids = [
        marked.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_TEXTS)
        for q in (0, 1)
    ]
    # At most twice SAMPLE_TEXTS ids are broadcast.
    sample = ids[0].unionByName(ids[1]).groupBy("doc_id").agg(F.min("quality").alias("quality"))

    @once
    @F.arrow_udf("struct<values:array<double>,lines:int>")
    def measured(column: pa.Array) -> pa.Array:
        found = [line_features(t)[0] for t in texts(column)]
        return pa.StructArray.from_arrays(
            [
                pa.array([f.ravel().tolist() for f in found], pa.list_(pa.float64())),
                pa.array(list(map(len, found)), pa.int32()),
            ],
            names=["values", "lines"],
        )

    rows = (
        known.join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id", "quality")
        .agg(F.min("text").alias("text"))
        .select("doc_id", "quality", measured("text").alias("m"))
        .filter(F.col("m.lines") <= SAMPLE_LINES)
        .collect()
    )
    rows = sorted((r["doc_id"], r["quality"], r["m"]["lines"], r["m"]["values"]) for r in rows)
    kept = [(q, np.array(v).reshape(n, len(FEATURES))) for _, q, n, v in rows if n]
    return train_field([f for _, f in kept], [q for q, _ in kept])


VERDICT = (
    "n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,"
    "base_failed:boolean,content_share:double,kept:boolean"
)


def judged(docs: DataFrame, field: LineField, text: str = "text", name: str = "verdict") -> DataFrame:
    """``docs`` and a struct ``verdict`` of what the rules found in each whole text.

    A text that fails the base rules is not kept: fewer than 20 words, or over 30 % of its
    words in repeated windows of 8. A null text has no words. Columns are kept, but one
    that is named like the new one gives way. Rows that repeat get the same verdict each; no
    rows give no rows.
    """

    @once
    @F.arrow_udf(f"struct<{VERDICT}>")
    def judge(column: pa.Array) -> pa.Array:
        rows = []
        for t in texts(column):
            m = measure(t)
            share = field.content_share(t)
            failed = m.base_failed
            rows.append(
                {
                    "n_words": m.n_words, "word_chars": m.word_chars, "n_symbols": m.n_symbols,
                    "n_dup_lines": m.n_dup_lines, "n_repeat_words": m.n_repeat_words,
                    "base_failed": failed, "content_share": share,
                    "kept": not failed and share >= CONTENT_SHARE,
                }
            )
        kinds = {"bigint": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
        kind = pa.struct([(n, kinds[k]) for n, k in (f.split(":") for f in VERDICT.split(","))])
        return pa.array(rows, kind)

    return extend(docs, {"text": text}, **{name: lambda c: judge(c["text"])})


def keep_content(docs: DataFrame, field: LineField, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    found = judged(plain, field, f"c{names.index(text)}", "verdict")
    return found.filter("verdict.kept").drop("verdict").toDF(*names)
