"""Places of rows in groups of any size (the windows of M3, M4, M6 and M8
without a window over a whole group).

A window partitioned by a group sorts the group in one task.  Here the rows are
range-partitioned by (group, order), so a group that holds most rows is spread
over as many tasks as its share asks for; a row's place is its position in its
partition plus a base, the number of rows of its group in earlier partitions.
The bases have one row per partition and group, so the window over them sorts
as many rows per group as there are partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..storage import written


def numbered(rows: DataFrame, group: Sequence[str], order: Sequence[Column], name: str,
             sums: dict[str, str] | None = None, into: str = "place") -> DataFrame:
    """``rows`` with their 0-based place (column ``into``) in ``group`` by
    ``order``, and group totals: ``<column>`` for each ``sums`` item (name ->
    column to add up).  Rows equal in ``order`` get places in some order.

    The sorted rows are written to the shared folder: partition bounds are
    sampled, so places and bases must come from one partitioning.  Equal rows
    are spread by a row number.
    """
    keys = [*[F.col(g).asc_nulls_first() for g in group], *order, F.col("__row").asc()]
    sorted_rows = (rows.withColumn("__row", F.monotonically_increasing_id())
                   .repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__row"))
    # partition number in the high bits, position in the partition in the low 33
    kept = written(sorted_rows.withColumn("__at", F.monotonically_increasing_id()), name)
    part = F.shiftright("__at", 33)
    sums = sums or {}
    runs = kept.groupBy(*[F.col(g).alias(f"__{g}") for g in group], part.alias("__part")).agg(
        F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"),
        *[F.sum(c).alias(f"__sum_{k}") for k, c in sums.items()])
    whole = W.partitionBy(*[f"__{g}" for g in group])
    before = whole.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    bases = runs.select(
        *[f"__{g}" for g in group], "__part",
        (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"),
        *[F.sum(f"__sum_{k}").over(whole).alias(f"__sum_{k}") for k in sums])
    match = part == F.col("__part")
    for g in group:
        match = match & F.col(g).eqNullSafe(F.col(f"__{g}"))
    return kept.join(bases, match).select(
        *rows.columns, (F.col("__at") + F.col("__shift")).alias(into), *[F.col(f"__sum_{k}").alias(k) for k in sums])


def salted_join(rows: DataFrame, groups: DataFrame, keys: Sequence[str], salts: int = 16, how: str = "inner") -> DataFrame:
    """``rows`` joined with one row per group; a group that holds most rows is
    dealt over ``salts`` tasks, each with its copy of the group's row.  The
    planner may still broadcast the groups where it finds them small."""
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).alias("__salt")
    spread = groups.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return rows.select("*", salt).join(spread, [*keys, "__salt"], how).drop("__salt")


def _score_bucket(score: str) -> Column:
    """An order-preserving bucket of a BIGINT: its sign, bit length and leading
    11 bits, so at most 2 x 56 x 1024 buckets whatever the scores."""
    size = f"abs({score})"
    shift = f"greatest(length(bin({size})) - 11, 0)"
    bucket = f"{shift} * 1024 + shiftright({size}, cast({shift} as int))"
    return F.expr(f"CASE WHEN {score} < 0 THEN -1 - ({bucket}) ELSE {bucket} END").cast("long")


def top_per_group_exact(rows: DataFrame, n: int, score: Column, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """M8 / O3 for any n: the n rows of each group with the largest score, ties
    by ``order``.

    Phase one counts scores by bucket (map-side sums; the buckets are bounded)
    and finds the bucket where the n-th row of each group lies: rows above it
    are in, rows below are out.  Phase two ranks only the rows of that bucket,
    over all tasks, and cuts them exactly.
    """
    base = written(rows.withColumn("__score", score.cast("long")), "top_input")
    base = base.withColumn("__bucket", _score_bucket("__score"))
    counts = base.groupBy(*group, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    above = W.partitionBy(*group).orderBy(F.col("__bucket").desc()).rowsBetween(W.unboundedPreceding, -1)
    cuts = counts.select(*group, "__bucket", "__n", F.coalesce(F.sum("__n").over(above), F.lit(0)).alias("__above"))
    # one row per group: the bucket to cut and how many of its rows are in
    cuts = cuts.filter((F.col("__above") < n) & (F.col("__above") + F.col("__n") >= n)).select(
        *group, F.col("__bucket").alias("__cut"), (F.lit(n) - F.col("__above")).alias("__take"))
    # a group with fewer than n rows has no bucket to cut
    met = salted_join(base, cuts, group, how="left")
    inside = met.filter(F.col("__cut").isNull() | (F.col("__bucket") > F.col("__cut"))).select(*rows.columns)
    tied = met.filter(F.col("__bucket") == F.col("__cut"))
    ranked = numbered(tied, group, [F.col("__score").desc(), *[F.col(c).asc() for c in order]], "top_ties")
    return inside.unionByName(ranked.filter(F.col("place") < F.col("__take")).select(*rows.columns))
