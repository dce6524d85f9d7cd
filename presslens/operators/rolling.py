"""Moving-window features over daily rows.

Frames (window length ``n``, half ``h = round(n / 2)`` with halves to even):

=====================  ==================  ==========================================
variant                days relative to t  remark
=====================  ==================  ==========================================
full window            -n ... 0            n + 1 days
``_first_window_half``  -h ... 0           the *recent* part
``_last_window_half``   -n ... -(h - odd)  the *older* part; odd is 1 for an odd n
=====================  ==================  ==========================================

The halves overlap at the boundary and are named against the order of time.

On a gap-free spine these are row frames.  Aggregates skip the nulls of gap days, so the same
numbers come out of *day-range* frames over the active rows alone.  That is what is used here: no
spine has to be built, shuffled or sorted.  Weekday indicators are the one input that is non-null
on gap days; they depend on the calendar only and have a closed form.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.functions.calendar import day_number
from presslens.functions.text import name, weekdays_between
from presslens.spec import FULL, OLDER_HALF, RECENT_HALF, WEEKDAYS


@dataclass(frozen=True)
class Rolled:
    """An aggregate of a frame as SQL, and its value for a weekday flag.

    ``column`` is a template over ``{value}``.  ``flag`` gives the same aggregate of a 0/1 column
    that has ``{hits}`` ones in ``{days}`` days.
    """

    column: str
    flag: str


# The alias ``count`` is a sum by definition of the feature names.
AGGREGATES: Mapping[str, Rolled] = {
    "count": Rolled("sum({value})", "{hits}"),
    "avg": Rolled("avg({value})", "try_divide(CAST({hits} AS DOUBLE), {days})"),
    "min": Rolled("min({value})", "IF({hits} >= {days}, 1, 0)"),
    "max": Rolled("max({value})", "IF({hits} > 0, 1, 0)"),
}
DEFAULT_AGGREGATES: Mapping[str, Rolled] = {"avg": AGGREGATES["avg"]}


def frames(n: int) -> dict[str, tuple[int, int]]:
    """Suffix -> first and last day of the frame, relative to the row's day."""
    if n < 2:
        raise ValueError("the moving window needs at least 2 days")
    half = round(n / 2)
    return {RECENT_HALF: (-half, 0), OLDER_HALF: (-n, -(half - n % 2)), FULL: (-n, 0)}


#: ``(aggregate template, value, window suffix) -> SQL`` of the aggregate over that frame.
Over = Callable[[str, str, str], str]


def _day_ordinal(date: dt.date | str) -> int:
    return (dt.date.fromisoformat(str(date)) - dt.date(1970, 1, 1)).days


def _feature_texts(
    day: str,
    n: int,
    sources: Mapping[str, str],
    aggs: Mapping[str, Rolled],
    over: Over,
    sums: Mapping[str, str],
    dow_base: int,
    spine_start: dt.date | str | None,
) -> list[str]:
    """All rolled columns as SQL; ``day`` is the day number of the row, ``__active`` its marker."""

    def column(value: str, alias: str, kind: str = "DOUBLE") -> str:
        return f"CAST({value} AS {kind}) AS {name(alias)}"

    spans = frames(n)
    out = [
        column(over(rolled.column, name(source), suffix), f"{stem}_{alias}{suffix}")
        for stem, source in sources.items()
        for alias, rolled in aggs.items()
        for suffix in spans
    ]
    for suffix, (low, high) in spans.items():
        first, last = f"({day} + {low})", f"({day} + {high})"
        if spine_start is not None:
            first = f"greatest({first}, {_day_ordinal(spine_start)})"
        days = f"({last} - {first} + 1)"
        active = f"coalesce({over('sum({value})', 'IF(__active, 1, 0)', suffix)}, 0)"
        out.append(column(f"IF({days} > 0, {active}, NULL)", f"days_active_count{suffix}"))
        for index in WEEKDAYS:
            hits = weekdays_between(first, last, index, dow_base)
            for alias, rolled in aggs.items():
                value = rolled.flag.format(hits=hits, days=days)
                out.append(column(f"IF({days} > 0, {value}, NULL)", f"dow_{index}_{alias}{suffix}"))
    out += [column(over("sum({value})", name(c), FULL), alias) for alias, c in sums.items()]
    last_active = over("max({value})", "IF(__active, unix_date(date), NULL)", FULL)
    out.append(column(f"{day} - {last_active}", "days_since_last_active", "INT"))
    return out


def _marked(df: DataFrame, active: Column | None) -> DataFrame:
    return df.withColumns(
        {
            "__day": day_number(F.col("date")),
            "__active": F.lit(True) if active is None else F.coalesce(active, F.lit(False)),
        }
    )


def rolling_features(
    df: DataFrame,
    id_col: str,
    n: int,
    sources: Mapping[str, str],
    aggs: Mapping[str, Rolled] = DEFAULT_AGGREGATES,
    sums: Mapping[str, str] | None = None,
    active: Column | None = None,
    dow_base: int = 1,
    spine_start: dt.date | str | None = None,
) -> DataFrame:
    """Add every rolled column to each row of ``df`` (unique per id and date).

    ``sources`` maps feature stems to columns, ``sums`` maps output names to columns summed over
    the full window only.  ``active`` marks rows that carry activity (all by default); other rows
    are points to evaluate or device-only days.  All frames share one partitioning and one order,
    so there is a single sort, and none of the shuffles is repeated when ``df`` is already
    partitioned by ``id_col``.
    """

    def bound(day: int) -> str:
        return "CURRENT ROW" if day == 0 else f"{-day} PRECEDING"

    ranges = {
        suffix: f"(PARTITION BY {name(id_col)} ORDER BY __day "
        f"RANGE BETWEEN {bound(low)} AND {bound(high)})"
        for suffix, (low, high) in frames(n).items()
    }
    features = _feature_texts(
        "__day", n, sources, aggs,
        lambda agg, value, suffix: f"{agg.format(value=value)} OVER {ranges[suffix]}",
        sums or {}, dow_base, spine_start,
    )
    return _marked(df, active).selectExpr(*[name(c) for c in df.columns], *features)


def point_features(
    df: DataFrame,
    id_col: str,
    date: dt.date | str,
    n: int,
    sources: Mapping[str, str],
    aggs: Mapping[str, Rolled] = DEFAULT_AGGREGATES,
    sums: Mapping[str, str] | None = None,
    active: Column | None = None,
    dow_base: int = 1,
    spine_start: dt.date | str | None = None,
    today: Sequence[str] = (),
) -> DataFrame:
    """The rolled columns of one single day, one row per id.

    For one day a frame is a condition, so the windows turn into one conditional aggregate: no
    sort, and partial sums are combined before the only shuffle.  ``today`` carries columns of
    the day's own row along.
    """
    target = _day_ordinal(date)
    spans = frames(n)

    def over(agg: str, value: str, suffix: str) -> str:
        low, high = (target + d for d in spans[suffix])
        if suffix != FULL:
            value = f"CASE WHEN __day BETWEEN {low} AND {high} THEN {value} END"
        return agg.format(value=value)

    features = _feature_texts(str(target), n, sources, aggs, over, sums or {}, dow_base, spine_start)
    own = [f"max(IF(__day = {target}, {name(c)}, NULL)) AS {name(c)}" for c in today]
    rows = _marked(df, active).where(F.col("__day").between(target - n, target))
    result = rows.groupBy(id_col).agg(*[F.expr(text) for text in (*features, *own)])
    return result.withColumn("date", F.lit(str(date)).cast("date"))
