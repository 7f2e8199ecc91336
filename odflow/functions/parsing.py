r"""Text-to-value column functions with the grammar of Python's ``float`` and
``strptime('%Y-%m-%d %H:%M:%S')``, evaluated in the JVM.

A plain Spark cast is not enough: it reads ``15d`` as 15.0, refuses ``1_5`` and
accepts dates without a time. Each parser therefore has a regular expression
that decides whether the text is allowed, and a ``try_cast`` that converts it.
The common spelling is tried first, so that clean data costs one match per cell.

Only the ASCII digits count as digits.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Python's str.strip and re see it: Unicode white space and 1C to
# 1F. Python's float strips the former only.
_WS = r"\s\x1c-\x1f"
_BLANK = rf"(?U)^[{_WS}]*\z"

_DATE_PLAIN = r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"
_DATE_LOOSE = (
    r"(?U)^(?!0000)[0-9]{4}-[0-9]{1,2}-(?: [1-9]|[0-9]{1,2})"
    rf"[{_WS}]+[0-9]{{1,2}}:[0-9]{{1,2}}:[0-9]{{1,2}}\z"
)

_DIGITS = r"[0-9](?:_?[0-9])*"
_NUMBER_PLAIN = r"^[+-]?[0-9]+(?:\.[0-9]*)?\z"
_NUMBER_LOOSE = (
    rf"(?U)^\s*[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})"
    rf"(?:[eE][+-]?{_DIGITS})?\s*\z"
)
_NON_FINITE = r"(?U)^\s*[+-]?(?i-uU:nan|inf(?:inity)?)\s*\z"
_NEGATIVE_INF = r"(?U)^\s*-(?i-uU:inf(?:inity)?)\s*\z"


def is_blank(text: Column) -> Column:
    """True for text that is empty or only white space."""
    return text.rlike(_BLANK)


def well_formed(line: Column, n_fields: int) -> Column:
    """True when the comma-separated line has ``n_fields`` fields, none blank.

    One linear match over the line; no array is built for malformed lines.
    """
    field = rf"[{_WS}]*+[^,{_WS}][^,]*+"
    return line.rlike(rf"(?U)^(?:{field},){{{n_fields - 1}}}{field}\z")


def field_count(line: Column) -> Column:
    """Number of comma-separated fields; counts commas and builds no array."""
    return F.length(line) - F.length(F.replace(line, F.lit(","), F.lit(""))) + 1


def parse_timestamp(text: Column) -> Column:
    """Timestamp without time zone, or null.

    Parts may be unpadded and several blanks may stand between date and time.
    """
    squeezed = F.regexp_replace(
        F.regexp_replace(text, "- ", "-"), rf"(?U)[{_WS}]+", " "
    )
    return F.when(text.rlike(_DATE_PLAIN), text.try_cast("timestamp_ntz")).when(
        text.rlike(_DATE_LOOSE), squeezed.try_cast("timestamp_ntz")
    )


def parse_number(text: Column) -> Column:
    """Double, or null for text that is no number; also null for ``nan`` and
    ``inf``. A number too large for a double becomes infinite, as in Python.
    """
    digits_only = F.regexp_replace(text, "[^0-9eE.+-]", "")
    return F.when(text.rlike(_NUMBER_PLAIN), text.try_cast("double")).when(
        text.rlike(_NUMBER_LOOSE), digits_only.try_cast("double")
    )


def is_finite(value: Column) -> Column:
    """True for a number that is neither NaN nor infinite; null for null."""
    return ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def is_number(text: Column) -> Column:
    """True when Python's ``float`` would accept the text, ``nan`` included."""
    return text.rlike(_NUMBER_LOOSE) | text.rlike(_NON_FINITE)


def not_above_zero(text: Column) -> Column:
    """True when the text is no number or a number of at most zero.

    ``nan`` and ``inf`` are numbers and are not at most zero; ``-inf`` is.
    """
    return (
        ~is_number(text)
        | F.coalesce(parse_number(text) <= 0, F.lit(False))
        | text.rlike(_NEGATIVE_INF)
    )


def month_of(ts: Column) -> Column:
    """Calendar month as ``yyyy-MM`` text, the partition key of the layer.

    By way of the date, so that no clock change of the session's zone matters.
    """
    return F.date_format(F.to_date(ts), "yyyy-MM")


def between(ts: Column, start: datetime, end: datetime) -> Column:
    """``start <= ts < end`` with typed literals, so that it reaches the scan."""

    def literal(moment: datetime) -> Column:
        return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")

    return (ts >= literal(start)) & (ts < literal(end))
