"""A9 and A14 over many windows: exact distinct users from mergeable bitmaps.

Users are not additive over periods, so counting them in overlapping windows
takes one Expand row per window, or a distinct per window.  Here each day keeps
a bitmap of its users, and any window is the OR of its days: users get dense
numbers (places in one range-partitioned sort), a number is a bit of a bucket
of 32,768, ``bitmap_construct_agg`` sets a day's bits and ``bitmap_or_agg``
merges them.  A bitmap has 4 KB, dense numbers keep few of them empty, and both
aggregates combine map-side, so a window's cost is its days x buckets, whatever
the number of events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import numbered
from .windows import tag_window_table


def user_numbers(users: DataFrame) -> DataFrame:
    """(user, user_no): the distinct non-NULL users numbered from 1."""
    user = users.columns[0]
    each = users.filter(F.col(user).isNotNull()).distinct()
    return numbered(each, [], [F.col(user).asc()], "user_numbers", into="user_no").withColumn(
        "user_no", F.col("user_no") + 1)


def daily_bitmaps(rows: DataFrame, user: str, day: str, keys: Sequence[str] = ()) -> DataFrame:
    """(day, keys, bucket, bits): the users of each day; NULL users count nowhere."""
    each = rows.select(user, day, *keys).filter(F.col(user).isNotNull() & F.col(day).isNotNull()).distinct()
    numbers = user_numbers(each.select(user))
    return each.join(numbers, user).groupBy(day, *keys, F.bitmap_bucket_number("user_no").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("user_no")).alias("bits"))


def users_by_window(bitmaps: DataFrame, day: str, windows: DataFrame, keys: Sequence[str] = (), into: str = "users") -> DataFrame:
    """(period, keys) -> distinct users over each window of the table ``windows``
    (period, start, end), from daily bitmaps."""
    merged = tag_window_table(bitmaps, day, windows).groupBy("period", *keys, "bucket").agg(
        F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy("period", *keys).agg(F.sum(F.bitmap_count("bits")).alias(into))
