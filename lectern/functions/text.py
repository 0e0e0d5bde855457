"""Text: whitespace, null tokens, literal lookups."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters that count as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same as ranges: the JVM tests every part of a class, so few parts are fast.
_RUNS = r"[\t-\r\x1C- \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]+"
_DOUBTFUL_ENDS = r"\A[^!-~]|[^!-~]\z"
_PLAIN_TEXT_ENDS = r"[^ -~]"


def squeeze(text: Column) -> Column:
    """Strip both ends. Looking for each of many characters is slow, so text whose ends are
    plain characters, the usual case, is left as it is."""
    return F.when(text.rlike(_DOUBTFUL_ENDS), F.trim(text, F.lit(WHITE_SPACE))).otherwise(text)


def tidy(text: Column) -> Column:
    """Strip both ends and collapse inner white space to one space. Plain text
    without double spaces, the usual case, only needs the ends looked at."""
    doubtful = F.contains(text, F.lit("  ")) | text.rlike(_PLAIN_TEXT_ENDS)
    single = F.when(doubtful, F.regexp_replace(text, _RUNS, " ")).otherwise(text)
    return F.trim(single)


def null_tokens(text: Column, tokens: Iterable[str]) -> Column:
    """NULL where the text equals one of the tokens exactly."""
    return F.when(~text.isin(*tokens), text)


def lookup(key: Column, mapping: Mapping[str, object]) -> Column:
    """Value of a literal mapping, NULL for any other key."""
    pairs = [F.lit(item) for pair in mapping.items() for item in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def category(text: Column, mapping: Mapping[str, str], default: str) -> Column:
    """Canonical spelling of a category, ``default`` when it is not known."""
    return F.coalesce(lookup(F.lower(text), mapping), F.lit(default))


def first_text(*candidates: Column, default: str) -> Column:
    """First candidate that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates], F.lit(default))
