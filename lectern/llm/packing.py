"""Token pieces packed into sequences of a fixed length by exact complements.

Only the histogram of piece lengths is planned on the driver: at most ``capacity`` rows,
however many pieces there are. A plan line is a combination of lengths that is used a
number of times; each line exhausts a length or is one of the few of that gap, so the
plan stays short as well. Spark numbers the pieces of each length and looks up, by
length and number, the line that uses them.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lectern.llm.common import once, pick, texts
from lectern.staging import stage

CAPACITY = 2048
#: A worker remembers the ids of so many words, twice: those in use and the generation
#: before. It bounds memory, not results.
WORDS_KEPT = 500_000
PIECE = "piece int, start long, length long, ids_crc32 long"


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE uses for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordEncoder:
    """Ids of the words of a text, remembered by word.

    For tokenizers that drop white space and never join across it (``word_bpe_49k``). A
    word of Latin letters, with or without punctuation behind it, goes to the tokenizer's
    model directly, its letters and its punctuation each as the one unit that the
    tokenizer makes of them; any other word goes through the whole tokenizer.
    """

    _PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-/:-@\[-`{-~]*)").fullmatch

    def __init__(self, definition: str):
        self._whole = Tokenizer.from_str(definition)
        self._model = self._whole.model
        self._letters = _byte_letters()
        self._words: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def _unit(self, unit: str) -> bytes:
        known = self._words.get(unit) or self._older.get(unit)
        if known is None:
            shown = unit if unit.isascii() else unit.encode().decode("latin1").translate(self._letters)
            known = array("I", [token.id for token in self._model.tokenize(shown)]).tobytes()
            self._words[unit] = known
        return known

    def _word(self, word: str) -> bytes:
        if len(self._words) >= WORDS_KEPT:
            self._older, self._words = self._words, {}
        if known := self._older.get(word):
            self._words[word] = known
            return known
        if plain := self._PLAIN(word):
            letters, marks = plain.groups()
            ids = self._unit(letters.lower()) if letters else b""
            ids += self._unit(marks) if marks else b""
        else:
            ids = array("I", self._whole.encode(word, add_special_tokens=False).ids).tobytes()
        self._words[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        # str.split() also cuts at the four separators, which are no white space here.
        words = _ASCII_WORDS(text) if _SEPARATORS(text) else text.split()
        missing = self._word
        # A generation may end on the way, so the table is looked up for each text.
        get = self._words.get
        return b"".join([get(w) or missing(w) for w in words])


_SEPARATORS = re.compile("[\x1c-\x1f]").search
_ASCII_WORDS = re.compile("[^ \t\n\v\f\r]+").findall


@lru_cache(maxsize=2)
def _encoder(definition: str) -> WordEncoder:
    return WordEncoder(definition)


def token_pieces(
    docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = 0,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id and, for each piece of a document, piece, start, length and ids_crc32.

    A document is its ids and ``end_id``. Only one of more than ``capacity`` ids is cut,
    into full pieces and a last one. A null text is empty: one piece of one id. Columns of
    ``docs`` besides the two are not carried. The tokenizer's file is read by the driver.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        definition = f.read()
    end = np.array([end_id], "<u4").tobytes()
    step = 4 * capacity

    @once
    @F.arrow_udf(f"array<struct<{PIECE.replace(' ', ':')}>>".replace(",:", ","))
    def cut(column: pa.Array) -> pa.Array:
        encoder, piece, start, length, crc, offsets = _encoder(definition), [], [], [], [], [0]
        for t in texts(column):
            ids = encoder.encode(t) + end
            for i in range(0, len(ids), step):
                own = ids[i : i + step]
                piece.append(i // step)
                start.append(i // 4)
                length.append(len(own) // 4)
                crc.append(zlib.crc32(own))
            offsets.append(len(piece))
        values = pa.StructArray.from_arrays(
            [pa.array(piece, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, length, crc)]],
            names=["piece", "start", "length", "ids_crc32"],
        )
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)

    slim = pick(docs, doc_id=doc_id, text=text)
    return slim.withColumn("p", cut("text")).select("doc_id", F.inline("p"))


class _Lengths:
    """How many pieces of each length are left, and which lengths those are, in order."""

    def __init__(self, counts: Mapping[int, int]):
        self.left = {n: c for n, c in counts.items() if c > 0}
        self.order = sorted(self.left)

    def take(self, lengths: tuple[int, ...], times: int) -> None:
        for n in lengths:
            self.left[n] -= times
            if not self.left[n]:
                del self.left[n]
                self.order.pop(bisect_left(self.order, n))

    def times(self, lengths: tuple[int, ...]) -> int:
        """How often the combination is there, a length that it repeats counted so."""
        return min(self.left.get(n, 0) // lengths.count(n) for n in set(lengths))


def _complements(lengths: _Lengths, first: int, gap: int) -> Iterator[tuple[int, ...]]:
    """Available singles, then pairs, then triples of a length sum of exactly ``gap``.

    A combination is given while it lasts; the sums are found through the availability
    counts, which are an index of the lengths by value.
    """
    has = lengths.left.get

    def rest(*used: int) -> bool:
        return lengths.times((first, *used)) > 0

    if rest(gap):
        yield (gap,)
    for a in [n for n in reversed(lengths.order) if 2 * n >= gap and n < gap]:
        if has(a) and has(gap - a) and rest(a, gap - a):
            yield a, gap - a
    if not has(first):
        return
    pairs = [n for n in reversed(lengths.order) if 3 * n >= gap and n < gap - 1]
    for a in pairs:
        for b in lengths.order[bisect_left(lengths.order, (gap - a + 1) // 2) : bisect_right(lengths.order, a)]:
            c = gap - a - b
            if c > 0 and has(c) and rest(a, b, c):
                yield a, b, c
                if not has(first) or not has(a):
                    break
        if not has(first):
            return


def plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, times): the combinations of lengths and how often each is used.

    From the longest length down, whatever fills its gap exactly is consumed: one piece,
    else two, else three. What is left then goes best-fit, longest first: into the open
    sequence with the least room that takes it. Exact gaps may use up short lengths that
    many long ones need; where best fit alone takes fewer sequences, its plan is given.
    """
    exact, plain = _exact_first(counts, capacity), _best_fit(counts, capacity)
    return min(exact, plain, key=lambda lines: sum(times for _, times in lines))


def _exact_first(counts: Mapping[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    lengths, lines, rest = _Lengths(counts), [], {}
    while lengths.order:
        first = lengths.order[-1]
        gap = capacity - first
        if gap == 0:
            lines.append(((first,), lengths.left[first]))
            lengths.take((first,), lengths.left[first])
            continue
        for others in _complements(lengths, first, gap):
            own = (first, *others)
            times = lengths.times(own)
            if times:
                lines.append((own, times))
                lengths.take(own, times)
        if left := lengths.left.get(first):
            rest[first] = left
            lengths.take((first,), left)
    return lines + _best_fit(rest, capacity)


def _best_fit(counts: Mapping[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over a histogram. Sequences of equal contents are one entry."""
    open_by_room: dict[int, list[list]] = {}
    rooms: list[int] = []

    def put(lengths: tuple[int, ...], times: int) -> None:
        room = capacity - sum(lengths)
        if room not in open_by_room:
            open_by_room[room] = []
            insort(rooms, room)
        open_by_room[room].append([lengths, times])

    for n in sorted(counts, reverse=True):
        left = counts[n]
        while left:
            at = bisect_left(rooms, n)
            if at == len(rooms):
                # New sequences, each as full of this length as it gets.
                each = min(capacity // n, left)
                put((n,) * each, left // each)
                left %= each
                continue
            room = rooms[at]
            lengths, times = open_by_room[room].pop()
            if not open_by_room[room]:
                del open_by_room[room]
                rooms.pop(at)
            each = min(room // n, left)
            used = min(times, left // each)
            if used < times:
                put(lengths, times - used)
            put(lengths + (n,) * each, used)
            left -= used * each
    return [(tuple(x), times) for same in open_by_room.values() for x, times in same]


def _line_uses(lines: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """For each length that a line uses: length, first and last number among the pieces
    of that length, how many of them a sequence has, first sequence id, offset there."""
    taken: dict[int, int] = {}
    uses, sequence = [], 0
    for lengths, times in lines:
        offset = 0
        for n in dict.fromkeys(lengths):
            each = lengths.count(n)
            begin = taken.get(n, 0)
            taken[n] = begin + each * times
            uses.append((n, begin, taken[n], each, sequence, offset))
            offset += n * each
        sequence += times
    return uses


def pack(pieces: DataFrame, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """``pieces``, which should be stored, with ``sequence_id`` and ``offset``.

    Every row is placed once; repeated rows are pieces of their own. ``length`` must be 1
    to ``capacity``. No rows: none.

    Pieces are numbered by length without a task that holds a whole length: counted by
    input split, the counts are summed up over the splits, and each split numbers its own.
    """
    rows = stage(
        pieces.withColumns(
            {"_split": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}
        )
    )
    counts = stage(rows.groupBy(F.col(length).alias("_n"), "_split").agg(F.count("*").alias("_count")))
    # At most ``capacity`` rows reach the driver.
    histogram = {r["_n"]: r["n"] for r in counts.groupBy("_n").agg(F.sum("_count").alias("n")).collect()}
    if wrong := [n for n in histogram if n is None or not 0 < n <= capacity]:
        raise ValueError(f"lengths that are not 1 to {capacity}: {wrong[:5]}")
    uses = _line_uses(plan(histogram, capacity))
    spark = pieces.sparkSession
    table = spark.createDataFrame(
        uses, "_n long, _begin long, _end long, _each long, _sequence long, _at long"
    )
    earlier = Window.partitionBy("_n").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.coalesce(F.sum("_count").over(earlier), F.lit(0)))
    own = Window.partitionBy("_split", length).orderBy("_row")
    numbered = (
        rows.withColumn("_own", F.row_number().over(own) - 1)
        .join(starts.drop("_count").withColumnRenamed("_split", "_s"),
              (F.col("_s") == F.col("_split")) & (F.col("_n") == F.col(length)))
        .withColumn("_number", F.col("_start") + F.col("_own"))
        .drop("_n", "_s")
    )
    # The table has at most a few lines for each of the ``capacity`` lengths.
    inside = (
        (F.col("_n") == F.col(length))
        & (F.col("_number") >= F.col("_begin"))
        & (F.col("_number") < F.col("_end"))
    )
    rank = F.col("_number") - F.col("_begin")
    sequence = F.col("_sequence") + F.expr("(_number - _begin) div _each")
    return (
        numbered.join(F.broadcast(table), inside)
        .withColumn("sequence_id", sequence)
        .withColumn("offset", F.col("_at") + rank % F.col("_each") * F.col(length))
        .select(*pieces.columns, "sequence_id", "offset")
    )


def packed_documents(
    docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Each document's pieces with their places; see ``token_pieces`` and ``pack``."""
    return pack(token_pieces(docs, tokenizer_file, capacity, doc_id=doc_id, text=text), capacity)
