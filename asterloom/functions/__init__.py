"""Column functions used by the cleaning and modelling operators."""

from asterloom.functions.scalars import (
    calendar_parts,
    named,
    parse_date,
    prefixed,
    to_double,
    to_int,
    trimmed,
)

__all__ = [
    "calendar_parts",
    "named",
    "parse_date",
    "prefixed",
    "to_double",
    "to_int",
    "trimmed",
]
