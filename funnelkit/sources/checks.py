"""S2 / S3 with calendar checks.

A weekly table whose week is not a Sunday, or that repeats a (week, group) key,
shifts totals silently: the week is moved by one day to meet the Monday weeks,
and measures are summed.  ``checked_weekly`` makes both an error inside the
plan, raised by the row that breaks the rule and naming its value; it costs one
aggregate by the key (map-side combined) and no job.  ``weekly_violations``
counts them instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ("week", "country_group", "agg_key")
SUNDAY = 1  # dayofweek


def _keys(df: DataFrame) -> list[str]:
    return [k for k in KEYS if k in df.columns]


def _not_sunday(week: str = "week") -> Column:
    return F.col(week).isNull() | (F.dayofweek(week) != SUNDAY)


def _key_text(keys: list[str]) -> Column:
    return F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])


def checked_weekly(df: DataFrame) -> DataFrame:
    """``df`` unchanged, or an error that names a week which is no Sunday (or
    NULL) or a key (week, country_group and, where present, agg_key) that is
    there twice.  The check sits in ``week``, which every reader of a weekly
    table uses, so column pruning cannot drop it."""
    keys = _keys(df)
    others = [c for c in df.columns if c not in keys]
    each = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(c) for c in others])
    wrong = F.raise_error(F.concat(F.lit("weekly table: week is not a Sunday: "), F.coalesce(F.col("week").cast("string"), F.lit("NULL"))))
    twice = F.raise_error(F.concat(F.lit("weekly table: repeated key: "), _key_text(keys)))
    week = F.when(_not_sunday(), wrong).when(F.col("__n") > 1, twice).otherwise(F.col("week")).cast(df.schema["week"].dataType)
    return each.select(*[week.alias("week") if c == "week" else F.col(c) for c in df.columns])


def weekly_violations(df: DataFrame) -> DataFrame:
    """(check, violations, example): rows whose week is not a Sunday and keys
    that are there more than once; the example is the first one in order."""
    keys = _keys(df)
    each = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).select(
        _not_sunday().alias("shifted"), (F.col("n") > 1).alias("twice"), "n", _key_text(keys).alias("key"),
        F.coalesce(F.col("week").cast("string"), F.lit("NULL")).alias("week"))
    found = each.agg(
        F.coalesce(F.sum(F.when(F.col("shifted"), F.col("n"))), F.lit(0)).alias("shifted"),
        F.min(F.when(F.col("shifted"), F.col("week"))).alias("shifted_example"),
        F.count_if("twice").alias("twice"), F.min(F.when(F.col("twice"), F.col("key"))).alias("twice_example"))
    return found.select(F.explode(F.array(
        F.struct(F.lit("week is a Sunday").alias("check"), F.col("shifted").alias("violations"), F.col("shifted_example").alias("example")),
        F.struct(F.lit("key is unique").alias("check"), F.col("twice").alias("violations"), F.col("twice_example").alias("example"))
    )).alias("r")).select("r.*")
