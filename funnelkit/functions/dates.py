"""Calendar helpers: week starts, inclusive date ranges, window tags."""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rules import _q


def monday_week(d: Column) -> Column:
    """Monday on or before ``d`` as a DATE (``trunc`` keeps the DATE type)."""
    return F.trunc(d, "week")


def sunday_week(d: Column) -> Column:
    """Sunday on or before ``d``."""
    return F.date_sub(F.trunc(F.date_add(d, 1), "week"), 1)


def _date_sql(x: date) -> str:
    return f"DATE'{x.isoformat()}'"


def in_ranges_sql(col: str, ranges: list[tuple[date, date]]) -> str:
    return "(" + " OR ".join(f"{col} BETWEEN {_date_sql(s)} AND {_date_sql(e)}" for s, e in ranges) + ")"


def in_ranges(d: Column | str, ranges: list[tuple[date, date]]) -> Column:
    """OR of inclusive BETWENs with literal bounds, so the filter reaches the
    parquet scan and prunes ``event_date`` partitions.  A column name is
    rendered as one SQL expression (one JVM call)."""
    if isinstance(d, str):
        return F.expr(in_ranges_sql(d, ranges))
    return reduce(or_, [d.between(F.lit(s), F.lit(e)) for s, e in ranges])


def period_tags(d: str, windows) -> Column:
    """Array of the window names containing column ``d`` (0..n entries, no
    NULLs).  A per-row expression: tagging overlapping windows needs no join.
    """
    arms = ", ".join(f"CASE WHEN {d} BETWEEN {_date_sql(w.start)} AND {_date_sql(w.end)} THEN {_q(w.period)} END"
                     for w in windows)
    return F.expr(f"filter(array({arms}), t -> t IS NOT NULL)")
