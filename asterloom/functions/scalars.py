"""Scalar column functions.

Every function returns a built-in ``Column`` expression, so the calls stay inside
whole-stage code generation and Catalyst can push, fold and prune them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(column: str, qualifier: str | None = None) -> Column:
    """Reference a column by its exact name, even if the name has dots or blanks."""
    quoted = "`" + column.replace("`", "``") + "`"
    return F.col(f"{qualifier}.{quoted}" if qualifier else quoted)


def trimmed(column: Column) -> Column:
    """Strip leading and trailing spaces; tabs and newlines stay, null stays null."""
    return F.trim(column)


def prefixed(prefix: str, column: Column) -> Column:
    """Put a constant in front of a path; a null path gives null, not the bare prefix."""
    return F.concat(F.lit(prefix), column)


def parse_date(column: Column) -> Column:
    """Date text to DATE; text that is no date gives null instead of failing the job.

    Short forms (``2024``, ``2024-05``, ``2024-5-3``) are accepted, as Spark's own
    string-to-date cast does.
    """
    return F.try_to_date(column)


def calendar_parts(date: Column) -> dict[str, Column]:
    """Year, month and day of a DATE as unpadded text."""
    return {
        "year": F.year(date).cast("string"),
        "month": F.month(date).cast("string"),
        "day": F.dayofmonth(date).cast("string"),
    }


def to_double(column: Column) -> Column:
    return column.cast("double")


def to_int(column: Column, overflow: str = "raise") -> Column:
    """Narrow to INT. ``overflow="raise"`` fails on values outside the range (ANSI),
    ``overflow="null"`` turns them into null."""
    if overflow == "raise":
        return column.cast("int")
    if overflow == "null":
        return column.try_cast("int")
    raise ValueError(f"overflow must be 'raise' or 'null', not {overflow!r}")
