"""Percentages, flags and dates written in several ways."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.numeric import to_number
from lectern.functions.text import lookup, squeeze


def parse_percentage(text: Column) -> Column:
    """``80%``, ``80`` and ``0.8`` all give 80. Without a percent sign, 0 to 1
    inclusive counts as a fraction. Space of any kind around it is dropped."""
    signed = F.contains(text, F.lit("%"))
    plain = squeeze(text)
    number = to_number(F.when(signed, F.replace(plain, F.lit("%"), F.lit(""))).otherwise(plain))
    # The number stands outside of the choice, so that it is computed once.
    return number * F.when(~signed & number.between(0, 1), F.lit(100.0)).otherwise(F.lit(1.0))


def parse_flag(text: Column, spellings: Mapping[str, int]) -> Column:
    """1 or 0 for a known spelling, otherwise the number itself, otherwise NULL."""
    known = lookup(F.lower(squeeze(text)), spellings).cast("double")
    return F.coalesce(known, to_number(text))


ISO_DAY = "yyyy-MM-dd"
_ISO_PATTERN = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T].*)?$"
# Other spellings of a day that occur in files: slashes or points, no leading zeros.
DAY_FORMATS = (ISO_DAY, "y/M/d", "y.M.d")


def _could_fit(text: Column, pattern: str) -> Column:
    """Whether a text has the digits and separators of a day format: a formatter raises inside
    on any other text, which is slow. Formats with more than years, months and days are
    not looked at."""
    if not re.fullmatch(r"[yMd]+(?:[-/. ][yMd]+)*", pattern):
        return F.lit(True)
    return text.rlike("^" + re.sub("[yMd]+", "[+-]?[0-9]+", pattern.replace(".", r"\.")) + "$")


def parse_date(text: Column, formats: tuple[str, ...] = (ISO_DAY,)) -> Column:
    """Date by the first format that fits, NULL when none does. The ISO form, whose time
    part is dropped, has a cast of its own, which is faster than a formatter that raises
    on bad text."""
    trimmed = squeeze(text)
    return F.coalesce(
        *[
            F.when(trimmed.rlike(_ISO_PATTERN), trimmed.try_cast("date"))
            if pattern == ISO_DAY
            else F.when(_could_fit(trimmed, pattern), F.try_to_date(trimmed, pattern))
            for pattern in formats
        ]
    )


def week_label(year: Column, week: Column) -> Column:
    """``2024-W07``"""
    return F.concat_ws("-W", year.cast("string"), F.lpad(week.cast("string"), 2, "0"))
