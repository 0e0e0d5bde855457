"""Numbers: tolerant parsing, the two rounding rules, rates and shares."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the spellings that count as a number, with ASCII space around.
NUMBER_PATTERN = (
    r"^[\s\x1C-\x1F]*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?[\s\x1C-\x1F]*$"
)


def to_number(text: Column) -> Column:
    """Text to double; anything that is not a plain number becomes NULL."""
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def to_int(text: Column) -> Column:
    """Text to int, dropping a fraction; bad or overflowing text becomes NULL. The
    pattern comes first, because a failing cast of text raises inside and is slow."""
    return to_number(text).try_cast("int")


def half_up(value: Column, digits: int = 2) -> Column:
    return F.round(value, digits)


def half_even(value: Column, digits: int = 2) -> Column:
    """Round on the binary value, ties to even, the way array libraries do."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def whole(value: Column) -> Column:
    """Nearest whole number, ties to even."""
    return F.rint(value).cast("bigint")


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def percent_of(part: Column, total: Column, digits: int | None = 2) -> Column:
    """``part`` in percent of ``total``; 0 when the total is 0."""
    share = zero_if_null(F.try_divide(part, total)) * 100.0
    return share if digits is None else half_up(share, digits)


def rate_to_percent(value: Column) -> Column:
    """A rate up to 1 is scaled to percent; larger values already are percents."""
    number = zero_if_null(value).cast("double")
    return F.when(number <= 1, number * 100).otherwise(number)


def submission_rate(submitted: Column, missed: Column) -> Column:
    """Submitted work in percent of all work, 0 where there was none."""
    total = submitted + missed
    return half_even(
        F.when(total > 0, F.try_divide(submitted, total) * 100.0).otherwise(0.0)
    )


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda left, right: left | right, conditions)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda left, right: left & right, conditions)
