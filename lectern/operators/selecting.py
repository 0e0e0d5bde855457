"""Filters, sorts, top-k and pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.numeric import all_of, zero_if_null
from lectern.operators.numbering import number_rows
from lectern.staging import stage


def filter_equals(df: DataFrame, **wanted: str | None) -> DataFrame:
    """Equality on each given column; an empty argument does not filter."""
    rules = [F.col(c) == v for c, v in wanted.items() if v not in (None, "")]
    return df.filter(all_of(rules)) if rules else df


def filter_contains(df: DataFrame, columns: Sequence[str], part: str) -> DataFrame:
    """Rows whose columns, joined without a separator, contain ``part``."""
    if not part:
        return df
    joined = F.concat(*[F.coalesce(F.col(c), F.lit("")) for c in columns])
    return df.filter(F.contains(joined, F.lit(part)))


def filter_search(
    df: DataFrame,
    student: str = "",
    course: str = "",
    level: str = "",
    course_id: str = "",
) -> DataFrame:
    """The list search: id part, course part, level and course, all optional."""
    found = filter_contains(df, ["student_id"], student.strip())
    found = filter_contains(found, ["course_id", "course_name"], course.strip())
    return filter_equals(found, warning_level=level, course_id=course_id)


def filter_selected(df: DataFrame, chosen: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the chosen set."""
    return df.join(chosen.select(key), key, "left_semi")


def descending(measure: str, *ties: str) -> list[Column]:
    """Greatest first, NULL as 0, ties in ascending order of the given columns."""
    return [zero_if_null(F.col(measure)).desc(), *[F.col(t).asc() for t in ties]]


def rank_by_measure(
    df: DataFrame, measure: str, *ties: str, name: str = "position"
) -> DataFrame:
    """Rows with their place in a descending sort by a chosen measure."""
    return number_rows(df, *descending(measure, *ties), name=name)


def pinned_first(
    df: DataFrame, key: str, value: str, measure: str, name: str = "position"
) -> DataFrame:
    """As ``rank_by_measure``, with one chosen row in front."""
    front = (F.col(key).eqNullSafe(F.lit(value))).desc()
    return number_rows(df, front, *descending(measure, key), name=name)


def top(df: DataFrame, n: int, measure: str, *ties: str) -> DataFrame:
    """The n rows with the greatest measure."""
    return df.orderBy(*descending(measure, *ties)).limit(n)


def latest(df: DataFrame, n: int, *period: str) -> DataFrame:
    """The last n periods, in ascending order."""
    newest = df.orderBy(*[F.col(p).desc() for p in period]).limit(n)
    return newest.orderBy(*period)


def page_count(rows: int, size: int) -> int:
    return max(1, -(-rows // size))


def page_rows(
    df: DataFrame, page: int, size: int, order: Sequence[Column | str]
) -> DataFrame:
    """One page of a list in a total order; the page number is clamped to 1..last.

    A sort with a limit would make each task keep everything before a deep page, so the
    rows are numbered across partitions, whatever the page. The sorted rows are stored
    while the plan is built; their number and the page come from what is stored.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    numbered = number_rows(df, *order, name="_position")
    page = min(max(page, 1), page_count(numbered.count(), size))
    before = (page - 1) * size
    return (
        numbered.filter(F.col("_position").between(before + 1, before + size))
        .orderBy("_position")
        .drop("_position")
    )


class StoredPages:
    """A list sorted once and stored with the places of its rows; any of its pages is a filter on
    them, which the files' statistics narrow down to the one or two files that hold it."""

    def __init__(self, df: DataFrame, order: Sequence[Column | str]):
        by = [F.col(o) if isinstance(o, str) else o for o in order]
        placed = number_rows(df, *by, name="_position")
        # The sort's partitions are files with places that do not overlap.
        self._rows = stage(placed)
        self.count = self._rows.count()

    def page(self, page: int, size: int) -> DataFrame:
        """Rows of a page in order; the page number is clamped to 1..last."""
        before = (min(max(page, 1), page_count(self.count, size)) - 1) * size
        return (
            self._rows.filter(F.col("_position").between(before + 1, before + size))
            .orderBy("_position")
            .drop("_position")
        )
