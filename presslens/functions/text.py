"""SQL text for generated columns.

Feature frames have hundreds of generated columns.  As SQL text each costs one call to build,
while chains of column methods cost a dozen, so wide projections are written as text.
"""

from __future__ import annotations


def name(column: str) -> str:
    """Quoted column name."""
    return "`" + column.replace("`", "``") + "`"


def text(value: str) -> str:
    """Quoted string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def number(value: float) -> str:
    """Double literal."""
    return f"{float(value)!r}D"


def ratio(numerator: str, denominator: str) -> str:
    """Ratio of two columns, 0 where it is undefined."""
    top, bottom = (f"CAST({name(c)} AS DOUBLE)" for c in (numerator, denominator))
    return f"coalesce(try_divide({top}, {bottom}), 0D)"


def relative_change(later: str, earlier: str) -> str:
    """Growth factor between two columns with fixed ends.

    ``later = 0`` is -1, ``earlier = 0`` is 1, else the ratio.  The first test wins when both are
    zero; a null on either side stays null.
    """
    top, bottom = name(later), name(earlier)
    return (
        f"CASE WHEN {top} = 0 THEN -1D WHEN {bottom} = 0 THEN 1D "
        f"ELSE try_divide(CAST({top} AS DOUBLE), CAST({bottom} AS DOUBLE)) END"
    )


def weekdays_between(first: str, last: str, index: int, base: int = 1) -> str:
    """How many days of weekday ``index`` lie between two day-number expressions, ends included.

    Day number 0 is a Thursday, so the Sunday-based weekday of day ``u`` is ``(u + 4) mod 7`` and
    the days of one weekday up to ``u`` are counted by ``floor((u + 4 - weekday) / 7)``.
    ``base=1`` makes index 0 Sunday; ``base=0`` shifts by one, so index 0 never matches.
    """
    weekday = index + base - 1
    if not 0 <= weekday <= 6:
        return "0"
    shift = 4 - weekday
    return f"(floor(({last} + {shift}) / 7) - floor(({first} - 1 + {shift}) / 7))"


def scaled(column: str, low: float, high: float, present: bool = True) -> str:
    """Min-max scaling by fitted limits; a constant column becomes its distance from the constant.

    Nulls, and a column that is not ``present``, count as 0 before scaling.
    """
    width = (high - low) or 1.0
    value = filled(column) if present else "0D"
    return f"(({value} - {number(low)}) / {number(width)})"


def indicator(column: str, value: str) -> str:
    """1 where the column has this text, else 0 (also for null)."""
    return f"CASE WHEN CAST({name(column)} AS STRING) = {text(value)} THEN 1 ELSE 0 END"


def filled(column: str, fill: float = 0.0) -> str:
    return f"coalesce(CAST({name(column)} AS DOUBLE), {number(fill)})"
