"""Column functions; all of them are built from Spark's own expressions."""

from odflow.functions.parsing import (
    between,
    field_count,
    is_blank,
    is_finite,
    is_number,
    month_of,
    not_above_zero,
    parse_number,
    parse_timestamp,
    well_formed,
)

__all__ = [
    "between",
    "field_count",
    "is_blank",
    "is_finite",
    "is_number",
    "month_of",
    "not_above_zero",
    "parse_number",
    "parse_timestamp",
    "well_formed",
]
