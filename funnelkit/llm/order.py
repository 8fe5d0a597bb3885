"""Ranks and running sums over a whole table without one task that sees it.

Rows are spread over buckets; a bucket's total is a small pre-aggregated row,
the totals' running sum gives each bucket its base, and a window inside one
bucket does the rest.  The number of buckets follows the number of rows, so a
hot group is split like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 1024
MOST_BUCKETS = 1 << 16


def bucket_count(rows: int) -> int:
    """A power of two with about ROWS_PER_BUCKET rows in each bucket."""
    n = 1
    while n * ROWS_PER_BUCKET < rows and n < MOST_BUCKETS:
        n *= 2
    return n


def running_sums(df: DataFrame, sums: dict[str, Column], bucket: Column, order: list[Column],
                 groups: list[str] | None = None) -> DataFrame:
    """``df`` with columns of exclusive running sums (BIGINT) in the order
    (bucket, order) within ``groups``, and each sum's total over the group as
    ``<name>_total``.  ``order`` must order the rows of a
    bucket up to rows that are equal in every used column."""
    groups = groups or []
    values = {f"__v_{name}": value.cast("long") for name, value in sums.items()}
    rows = df.withColumn("__bucket", bucket.cast("long")).withColumns(values)
    totals = rows.groupBy(*groups, "__bucket").agg(*[F.sum(v).alias(f"__t_{v}") for v in values])
    before = W.partitionBy(*groups).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*groups)
    bases = totals.select(
        *[F.col(g).alias(f"__g_{g}") for g in groups], F.col("__bucket").alias("__b"),
        *[F.coalesce(F.sum(f"__t_{v}").over(before), F.lit(0)).alias(f"__base_{v}") for v in values],
        *[F.sum(f"__t_{v}").over(whole).alias(f"__all_{v}") for v in values])
    match = F.col("__bucket") == F.col("__b")
    for g in groups:
        match = match & F.col(g).eqNullSafe(F.col(f"__g_{g}"))
    own = W.partitionBy(*groups, "__bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    inside = rows.join(bases, match).drop("__b", *[f"__g_{g}" for g in groups])
    return inside.withColumns({
        name: F.col(f"__base___v_{name}") + F.coalesce(F.sum(f"__v_{name}").over(own), F.lit(0)) for name in sums
    }).withColumnsRenamed({f"__all___v_{name}": f"{name}_total" for name in sums}).drop(
        "__bucket", *values, *[f"__base_{v}" for v in values])
