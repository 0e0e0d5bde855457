"""Toxicity by a weighted finite-state grammar over clauses.

A lexicon turns each word of a clause into a symbol: insult, threat verb, target, intent,
copula, negation, report, or other. Small transducers read the symbols one after the other
and rewrite them:

* read from the end, a target marks the insults and threat verbs shortly before it;
* negation and reported speech mark what is in their reach;
* a threat is intent, threat verb and target, the target on either side of the verb
  ("I will kill you", "ich werde dich töten"); any two of them are part of one;
* an insult is aimed with a target on either side ("you are a fool", "fool that you are"),
  stated behind a copula ("he is a fool"), or a bare word.

Those that read forward are composed into one deterministic table. A text's evidence is what
its matched clauses add up to; a logistic curve, fitted to labelled texts, turns it into a score.

Function words (targets, intent, copulas, negations, reporting verbs) and threat verbs are given
below. Insults are learned: words, or beginnings of words where a language inflects or compounds
them, that labelled texts bind to the label beyond chance. What no labelled text of the sample
shows is worth what is stated here: an aimed threat reaches the threshold by itself.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import extend, once, pick, texts
from lectern.staging import stage

#: Labelled texts of each class that the lexicon and the curve are learned from, at most,
#: and the length of such a text.
SAMPLE_TEXTS = 3000
SAMPLE_CHARS = 20_000
THRESHOLD = 0.7
#: Lengths of the beginnings of words that may be learned.
STEMS = range(3, 9)
#: Behind a feature that is a whole word.
WHOLE = "$"

# Closed classes of words in the four languages of the corpus.
TARGETS = "you you're your yours yourself u they them du dich dir dein ihr euch tu toi vous vos ton tú ti usted ustedes vosotros".split()
NEGATIONS = "not no never none nobody isn't aren't wasn't don't nicht kein keine nie niemals ne pas jamais aucun nunca jamás ningún".split()
REPORTS = "said says say called calls quoted wrote claimed alleged reported sagte sagt nannte schrieb dit disait appelé écrit dijo dice llamó escribió".split()
INTENTS = "will i'll we'll gonna going shall must should want wanna werde werden wirst müsst soll vais va allons veux voy vamos quiero".split()
COPULAS = "am are is was were be being bin bist ist sind seid war suis es est sommes êtes sont soy eres son sois".split()
THREATS = "kill murder destroy strangle stab shoot töten umbringen erschießen tuer égorger massacrer matar asesinar".split()

INSULT, THREAT, TARGET, INTENT, COPULA, NEGATION, REPORT, OTHER = "I", "H", "T", "M", "C", "N", "R", "."
SYMBOLS = (INSULT, THREAT, TARGET, INTENT, COPULA, NEGATION, REPORT, OTHER)
#: What the grammar can find: an insult or a threat that is whole, partly there, bare, negated
#: or reported.
KINDS = tuple(a + b for a in (INSULT, THREAT) for b in ("+", "~", "", "-", "'"))
#: A kind's evidence counts up to here; what is beyond adds nothing to a clear case.
MOST_EVIDENCE = 25.0
#: A match says less in a longer text: what the size takes off is fixed.
SIZE_WEIGHT = -0.5
#: What a kind is worth before the labels are seen, times the weight of its word.
PRIOR = {
    "I+": 1.3, "I~": 1.1, "I": 0.9, "I-": 0.4, "I'": 0.6,
    "H+": 4.7, "H~": 0.8, "H": 0.4, "H-": 0.1, "H'": 0.2,
}
#: Where one whole threat alone puts a text, on the scale of the curve, if no label speaks of any.
THREAT_LOGIT = 2.2


@dataclass(frozen=True)
class Transducer:
    """Deterministic; ``arcs[state, symbol]`` = (state, symbol). A pair without an arc
    leads back to state 0 and passes the symbol on."""

    states: int
    arcs: dict[tuple[int, str], tuple[int, str]]

    def step(self, state: int, symbol: str) -> tuple[int, str]:
        return self.arcs.get((state, symbol), (0, symbol))


def within(
    reach: int, opens: str, marks: dict[str, str], inputs: Iterable[str], passes: bool = False
) -> Transducer:
    """Rewrites by ``marks`` the symbols that follow ``opens`` within ``reach`` words. The opener
    itself is read off, or passed on to the next transducer."""
    arcs: dict[tuple[int, str], tuple[int, str]] = {}
    for state, symbol in product(range(reach + 1), inputs):
        if symbol == opens:
            arcs[state, symbol] = (reach, symbol if passes else OTHER)
        elif state:
            arcs[state, symbol] = (state - 1, marks.get(symbol, symbol))
    return Transducer(reach + 1, arcs)


def compose(first: Transducer, second: Transducer, inputs: Iterable[str]) -> Transducer:
    """One machine that does what ``second`` does with the output of ``first``; of the pairs of
    states, those that can be reached."""
    numbers, open_ = {(0, 0): 0}, [(0, 0)]
    arcs = {}
    while open_:
        a, b = state = open_.pop()
        for symbol in inputs:
            a_next, middle = first.step(a, symbol)
            b_next, out = second.step(b, middle)
            if (a_next, b_next) not in numbers:
                numbers[a_next, b_next] = len(numbers)
                open_.append((a_next, b_next))
            arcs[numbers[state], symbol] = (numbers[a_next, b_next], out)
    return Transducer(len(numbers), arcs)


#: An insult or threat verb with a target shortly behind it.
INSULT_AT, THREAT_AT = "I>", "H>"
MARKED = (*SYMBOLS, INSULT_AT, THREAT_AT)


def target_behind() -> Transducer:
    """Reads a clause from its end."""
    return within(3, TARGET, {INSULT: INSULT_AT, THREAT: THREAT_AT}, SYMBOLS, passes=True)


def threat(reach: int = 6) -> Transducer:
    """Intent, threat verb, target. States: none; so many words left since an intent; the same
    once a target came behind the intent."""
    arcs: dict[tuple[int, str], tuple[int, str]] = {}
    for state, symbol in product(range(2 * reach + 1), (*MARKED, "I-", "H-", "I'", "H'")):
        left, aimed = (state - reach, True) if state > reach else (state, False)
        after = 0 if left <= 1 else left - 1 + (reach if aimed else 0)
        out = symbol
        if symbol == INTENT:
            after, out = reach, OTHER
        elif symbol == TARGET and left > 1:
            after = left - 1 + reach
        elif symbol in (THREAT, THREAT_AT):
            parts = 1 + bool(left) + (aimed or symbol == THREAT_AT)
            out = {1: THREAT, 2: "H~", 3: "H+"}[parts]
        arcs[state, symbol] = (after, out)
    return Transducer(2 * reach + 1, arcs)


def forward() -> list[Transducer]:
    """Negation, reported speech, threat, stated insult, aimed insult; a clause is read from state 0."""
    core = (INSULT, THREAT, INSULT_AT, THREAT_AT)
    negated = (*MARKED, "I-", "H-")
    reported = (*negated, "I'", "H'")
    threats = (*reported, "H~", "H+")
    stated = (*threats, "I~")
    aimed = within(4, TARGET, dict.fromkeys((INSULT, INSULT_AT, "I~"), "I+"), stated)
    # Outside the reach of a target before it, the one behind decides.
    aimed.arcs.update({(0, INSULT_AT): (0, "I+")})
    return [
        within(3, NEGATION, {s: s[0] + "-" for s in core}, MARKED),
        within(12, REPORT, {s: s[0] + "'" for s in core}, negated),
        threat(),
        within(4, COPULA, {INSULT: "I~"}, threats),
        aimed,
    ]


@lru_cache(maxsize=1)
def grammar() -> tuple[Transducer, Transducer]:
    """What reads a clause from its end, and what then reads it from its beginning."""
    composed, *more = forward()
    for machine in more:
        composed = compose(composed, machine, MARKED)
    return target_behind(), composed


@dataclass
class Lexicon:
    """Weights of whole words and of beginnings of words that insult; ``classes`` has the
    given words. A weight is the log of how much oftener the label comes with it."""

    words: dict[str, float]
    stems: dict[str, float]
    classes: dict[str, str] = field(
        default_factory=lambda: {
            w: s
            for s, ws in (
                (COPULA, COPULAS), (INTENT, INTENTS), (TARGET, TARGETS),
                (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS),
            )
            for w in ws
        }
    )

    def look_up(self, word: str) -> tuple[str, float]:
        if word in self.words:
            return INSULT, self.words[word]
        for n in STEMS:
            if (weight := self.stems.get(word[:n])) is not None and len(word) >= n:
                return INSULT, weight
        return self.classes.get(word, OTHER), 1.0


WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_CLAUSE_END = re.compile(r"[.!?;:\n]")
_WORDS_KEPT = 300_000


class Grammar:
    """Runs the grammar over the clauses of a text."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.backward, self.machine = grammar()
        self.found: dict[str, tuple[str, float] | None] = {}

    def _symbol(self, word: str) -> tuple[str, float] | None:
        if len(self.found) >= _WORDS_KEPT:
            self.found.clear()
        symbol = self.lexicon.look_up(word)
        self.found[word] = symbol if symbol[0] != OTHER else None
        return self.found[word]

    def matches(self, text: str) -> Iterator[tuple[str, float]]:
        """The kind and the word's weight of each match, clause by clause."""
        low = text.lower()
        known, look = self.found, self._symbol
        core = (INSULT, THREAT)
        hit = False
        for w in set(WORD.findall(low)):
            s = known[w] if w in known else look(w)
            hit = hit or (s is not None and s[0] in core)
        if not hit:
            return
        for clause in _CLAUSE_END.split(low):
            symbols = [look(w) if w not in known else known[w] for w in WORD.findall(clause)]
            if not any(s and s[0] in core for s in symbols):
                continue
            state, marked = 0, []
            for s in reversed(symbols):
                state, out = self.backward.step(state, s[0] if s else OTHER)
                marked.append(out)
            state = 0
            for s, symbol in zip(symbols, reversed(marked)):
                state, out = self.machine.step(state, symbol)
                if out[0] in core:
                    yield out, s[1]

    def evidence(self, text: str) -> np.ndarray:
        """The summed weights of each kind, and the size of a text that has any match: chance
        has more room in a long one."""
        sums = dict.fromkeys(KINDS, 0.0)
        for kind, weight in self.matches(text):
            sums[kind] = min(MOST_EVIDENCE, sums[kind] + weight)
        size = math.log1p(len(text) / 1000) if any(sums.values()) else 0.0
        return np.array([*[sums[k] for k in KINDS], size])


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: Lexicon
    weights: tuple[float, ...]  # one for each kind, at least 0, and for size
    bias: float

    def score(self, evidence: np.ndarray) -> float:
        z = self.bias + float(evidence @ np.array(self.weights))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _with_threats(w: np.ndarray, b: float, evidence: np.ndarray) -> np.ndarray:
    """The weights; that of a whole threat as stated above where no text of the sample has one."""
    whole = KINDS.index("H+")
    if not len(evidence) or not evidence[:, whole].any():
        w[whole] = max(w[whole], THREAT_LOGIT - b)
    return w


def _fit(
    evidence: np.ndarray, toxic: np.ndarray, share: float, steps: int = 500
) -> tuple[tuple[float, ...], float]:
    """Logistic regression drawn toward the priors. ``share`` is that of toxic texts among
    all labelled ones; the sample is weighed accordingly."""
    prior = np.array([PRIOR[k] for k in KINDS] + [SIZE_WEIGHT])
    lower = np.array([0.0] * len(KINDS) + [SIZE_WEIGHT])
    upper = np.array([np.inf] * len(KINDS) + [SIZE_WEIGHT])
    w, b = prior.copy(), -2.5
    if not len(toxic) or toxic.all() or not toxic.any():
        return tuple(_with_threats(w, b, evidence).tolist()), b
    c = np.where(toxic, share / toxic.sum(), (1 - share) / (~toxic).sum())
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(evidence @ w + b, -30, 30)))
        g = c * (p - toxic)
        # Newton's step for each weight by itself is enough for so few.
        h = c * p * (1 - p)
        step = (evidence.T @ g + 1e-3 * (w - prior)) / (h @ (evidence * evidence) + 1e-2)
        w = np.clip(w - 0.3 * step, lower, upper)
        b -= 0.3 * g.sum() / (h.sum() + 1e-3)
    return tuple(_with_threats(w, b, evidence).tolist()), float(b)


def _strength(toxic: Column, clean: Column, n_toxic: int, n_clean: int) -> Column:
    """Likelihood ratio (G squared) of a feature's counts against those of all texts."""
    n = toxic + clean
    rate = n_toxic / (n_toxic + n_clean)

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    return 2 * (part(toxic, n * rate) + part(clean, n * (1 - rate)))


def _learned(features: DataFrame, n_toxic: int, n_clean: int) -> DataFrame:
    """feature, toxic, clean, strength and the least strength asked for, of those that the label comes with beyond chance:
    such a strength one of all the features would reach in a hundredth of such corpora.
    At least nine in ten of their texts are toxic, classes weighed alike."""
    counts = stage(
        features.groupBy("feature").agg(
            F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")
        )
    )
    tried = max(1, counts.count())
    strength = _strength(F.col("toxic"), F.col("clean"), n_toxic, n_clean)
    pure = F.col("toxic") / n_toxic > 9 * F.col("clean") / n_clean
    least = 2 * math.log(100 * tried)
    found = counts.withColumn("strength", strength).filter(pure & (F.col("strength") > least))
    return found.withColumn("least", F.lit(least))


def _chosen(found: list, texts_of: dict[str, list[int]], n_toxic: int, n_clean: int) -> Lexicon:
    """The features that stand on their own, of which none continues another.

    Step by step the strongest is taken. A toxic text that has k features taken before
    counts as (1 + k) ** -0.5 for the others: words that only accompany an insult, as in the
    copies of one text, lose what made them strong. A whole word goes before its
    beginnings, and a longer one before a shorter, if about as strong.
    """
    if not found:
        return Lexicon({}, {})
    names = [r["feature"] for r in found]
    clean = np.array([float(r["clean"]) for r in found])
    least = found[0]["least"]
    # The texts of all features behind each other; each has one at least.
    ends = np.cumsum([len(texts_of[name]) for name in names])
    starts = np.r_[0, ends[:-1]]
    inside = np.concatenate([texts_of[name] for name in names])
    rate = n_toxic / (n_toxic + n_clean)
    bonus = 1 + 0.01 * np.array([len(n) for n in names])
    open_ = np.ones(len(names), bool)
    taken_in = np.zeros(n_toxic)
    words, stems, begun = {}, {}, set()
    while True:
        toxic = np.add.reduceat(((1 + taken_in) ** -0.5)[inside], starts)
        n = toxic + clean
        strength = 2 * toxic * np.log(np.maximum(toxic, 1e-9) / (n * rate))
        strength += 2 * np.where(clean > 0, clean * np.log(np.maximum(clean, 1e-9) / (n * (1 - rate))), 0)
        pure = toxic / n_toxic > 9 * clean / n_clean
        able = np.where(open_ & pure & (strength > least), strength * bonus, 0)
        best = int(able.argmax())
        if not able[best]:
            return Lexicon(words, stems)
        open_[best] = False
        bare = names[best].rstrip(WHOLE)
        begins = {bare[:k] for k in range(1, len(bare) + 1)}
        if begins & stems.keys() or bare in begun:
            continue
        begun |= begins
        own = inside[starts[best] : ends[best]]
        taken_in[own] += 1
        weight = math.log((len(own) + 0.5) / (n_toxic + 1)) - math.log((clean[best] + 0.5) / (n_clean + 1))
        (words if names[best].endswith(WHOLE) else stems)[bare] = float(weight)


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> ToxicityModel:
    """A model from at most ``SAMPLE_TEXTS`` labelled texts of each class.

    The ids of least hash are the sample, whatever the size of the corpus; texts above
    ``SAMPLE_CHARS`` are left out of it. Copies count once. Rows with a null id or label
    do not count. Without labelled texts of both classes nothing is learned, and only the
    given threats can match.
    """
    marked = pick(labels, doc_id=doc_id, toxic=toxic).filter("doc_id is not null")
    known = pick(docs, doc_id=doc_id, text=text).filter(F.length("text") <= SAMPLE_CHARS)
    ids = [
        marked.filter(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_TEXTS)
        for t in (0, 1)
    ]
    # At most twice SAMPLE_TEXTS ids are broadcast.
    sample = ids[0].unionByName(ids[1]).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    distinct = known.join(F.broadcast(sample), "doc_id").groupBy("text").agg(F.max("toxic").alias("toxic"))
    rows = stage(distinct.withColumn("text_id", F.monotonically_increasing_id()))
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    lexicon = Lexicon({}, {})
    if n_toxic and n_clean:
        words = F.array_distinct(F.expr(r"regexp_extract_all(lower(text), '\\p{L}+', 0)"))
        lengths = F.array(*map(F.lit, STEMS))
        begins = F.transform(
            "words", lambda w: F.transform(lengths, lambda n: F.when(F.length(w) > n, F.substring(w, F.lit(1), n)))
        )
        whole = F.transform("words", lambda w: F.concat(w, F.lit(WHOLE)))
        features = F.array_distinct(F.concat(whole, F.flatten(begins)))
        spread = (
            rows.select("toxic", "text_id", words.alias("words"))
            .select("toxic", "text_id", F.explode(features).alias("feature"))
            .filter("feature is not null")
        )
        candidates = stage(_learned(spread, n_toxic, n_clean))
        # The features are those of the sample's texts, whose number and lengths are bounded.
        having = (
            spread.filter("toxic = 1")
            .join(candidates.select("feature"), "feature")
            .groupBy("feature")
            .agg(F.collect_list("text_id").alias("texts"))
        )
        ids = [r["text_id"] for r in rows.filter("toxic = 1").select("text_id").collect()]
        place = {text_id: i for i, text_id in enumerate(ids)}
        texts_of = {r["feature"]: [place[t] for t in r["texts"]] for r in having.collect()}
        found = candidates.orderBy(F.col("strength").desc(), "feature").collect()
        lexicon = _chosen(found, texts_of, n_toxic, n_clean)

    @once
    @F.arrow_udf("array<double>")
    def measured(column: pa.Array) -> pa.Array:
        machine = Grammar(lexicon)
        return pa.array([machine.evidence(t).tolist() for t in texts(column)], pa.list_(pa.float64()))

    found = rows.select("toxic", measured("text").alias("e")).collect()
    evidence = np.array([r["e"] for r in found]).reshape(len(found), len(KINDS) + 1)
    marks = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = marks.get(1, 0) / max(1, marks.get(1, 0) + marks.get(0, 0))
    weights, bias = _fit(evidence, np.array([r["toxic"] == 1 for r in found], bool), share)
    return ToxicityModel(lexicon, weights, bias)


def scored(docs: DataFrame, model: ToxicityModel, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` and the score of each whole text, 0 to 1. A null text counts as empty. Columns
    are kept, but one that is named like the new one gives way. Rows that repeat get the same
    score each; no rows give no rows."""

    @once
    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        machine = Grammar(model.lexicon)
        return pa.array([model.score(machine.evidence(t)) for t in texts(column)], pa.float64())

    return extend(docs, {"text": text}, **{name: lambda c: score(c["text"])})


def keep_clean(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with their columns."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    found = scored(plain, model, f"c{names.index(text)}", "score")
    return found.filter(F.col("score") < THRESHOLD).drop("score").toDF(*names)
