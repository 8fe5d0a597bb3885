"""J7 with the windows as a table: a binned interval join.

``functions.dates.period_tags`` splices the windows into the plan as literals,
which suits a handful.  A table of windows, thousands of them and overlapping,
meets the rows through date bins: a window is copied to each bin of
``bin_days`` days that it touches, a row lies in one bin, the bins join by
equality (a hash or sort-merge join), and the exact bounds are checked after.
Rows are summed per day before the join, so a day that holds a third of all
rows reaches it as one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BIN_DAYS = 28


def _bin(day: str, days: int) -> Column:
    return F.floor(F.unix_date(day) / days).cast("long")


def tag_window_table(rows: DataFrame, day: str, windows: DataFrame, bin_days: int = BIN_DAYS) -> DataFrame:
    """``rows`` once for each window (period, start, end; inclusive) that holds
    their date ``day``, with the column ``period``.  NULL dates and windows with
    a NULL or reversed bound match nothing."""
    spans = windows.filter(F.col("start") <= F.col("end")).select(
        "period", F.col("start").alias("__start"), F.col("end").alias("__end"),
        F.explode(F.sequence(_bin("start", bin_days), _bin("end", bin_days))).alias("__bin"))
    binned = rows.withColumn("__bin", _bin(day, bin_days))
    return binned.join(spans, "__bin").filter(F.col(day).between(F.col("__start"), F.col("__end"))).drop(
        "__bin", "__start", "__end")


def sums_by_window(rows: DataFrame, day: str, windows: DataFrame, keys: Sequence[str], sums: dict[str, Column],
                   bin_days: int = BIN_DAYS) -> DataFrame:
    """(period, keys) -> the sums over each window's rows, summed per day first."""
    daily = rows.groupBy(day, *keys).agg(*[F.sum(v.cast("long")).alias(k) for k, v in sums.items()])
    return tag_window_table(daily, day, windows, bin_days).groupBy("period", *keys).agg(
        *[F.sum(k).alias(k) for k in sums])


def rolling_windows(days: DataFrame, lengths: int) -> DataFrame:
    """A table of windows: for each date of ``days`` (one DATE column) those of
    1 to ``lengths`` days that end on it; ``period`` is ``<last day>/<days>``."""
    day = days.columns[0]
    each = days.filter(F.col(day).isNotNull()).distinct().select(
        F.col(day).alias("end"), F.explode(F.sequence(F.lit(1), F.lit(lengths))).alias("n"))
    return each.select(F.concat(F.col("end").cast("string"), F.lit("/"), F.col("n").cast("string")).alias("period"),
                       F.date_sub("end", F.col("n") - 1).alias("start"), "end")
