"""Column expressions shared by the operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(28,2)"


def ratio(num: Column, den: Column, digits: int, scale: int = 0) -> Column:
    """``num / den`` rounded half up, NULL when ``den`` is 0.

    The quotient is taken in decimals, so it does not depend on the order in
    which rows were summed.  ``scale`` is the number of decimals of the inputs.
    Meant for aggregated rows: decimals this wide are slow per input row.
    """
    top = num.cast(f"decimal(24,{scale})")
    bottom = F.nullif(den.cast(f"decimal(22,{scale})"), F.lit(0).cast(f"decimal(22,{scale})"))
    return F.round(top / bottom, digits).cast("double")


def pct(num: Column, den: Column, digits: int = 1, scale: int = 0) -> Column:
    return ratio(num * 100, den, digits, scale)


def count_if(condition: Column) -> Column:
    """Rows for which ``condition`` is true (NULL does not count)."""
    return F.count(F.when(condition, 1))


def money_sum(column: Column) -> Column:
    return F.sum(column).cast(MONEY)


def contains_ci(column: str | Column, term: str) -> Column:
    """Case-insensitive "contains"; ``%`` and ``_`` in the term are plain characters."""
    return F.contains(F.lower(column), F.lower(F.lit(term)))


def starts_ci(column: str | Column, term: str) -> Column:
    return F.startswith(F.lower(column), F.lower(F.lit(term)))


def is_blank(column: str | Column) -> Column:
    return F.length(F.trim(column)) == 0


def window_open(as_of: dt.date, start: str, end: str, closed: bool = False) -> Column:
    """Whether ``as_of`` lies in ``[start, end)``; a NULL end never closes.

    ``closed=True`` counts the last day itself as inside.
    """
    day = F.lit(as_of)
    last = F.col(end)
    before_end = (day <= last) if closed else (day < last)
    return (F.col(start) <= day) & (last.isNull() | before_end)


def month_of(column: str | Column) -> Column:
    """First day of the month, as a date."""
    return F.date_trunc("month", column).cast("date")


def at(moment: dt.date | dt.datetime) -> Column:
    """A literal without time zone; a date stands for its midnight."""
    if not isinstance(moment, dt.datetime):
        moment = dt.datetime(moment.year, moment.month, moment.day)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def between(column: str, start: dt.date | dt.datetime, end: dt.date | dt.datetime) -> Column:
    """Both ends included; plain dates stand for midnight."""
    return F.col(column).between(at(start), at(end))


def on_level(season: str = "season_id", episode: str = "episode_id", part: str = "part_id") -> Column:
    """Ratings given to the title as a whole."""
    return F.col(season).isNull() & F.col(episode).isNull() & F.col(part).isNull()


def micros(column: str | Column) -> Column:
    """Microseconds since 1970 of a timestamp without time zone.

    Built from its calendar parts, so the session's time zone plays no role.
    """
    moment = F.col(column) if isinstance(column, str) else column
    days = F.date_diff(moment.cast("date"), F.lit(dt.date(1970, 1, 1))).cast("bigint")
    minutes = (days * 24 + F.hour(moment)) * 60 + F.minute(moment)
    return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), moment) * 1_000_000).cast("bigint")
