"""Apportionment of period x country totals over the visit cells (M1-M8).

Trials and paid come without landing page or channel, so each
(period, country) total is spread over that group's cells in proportion to
visits, with a largest-remainder rounding that keeps every group total exact.
All arithmetic is on BIGINT: floor = visits*total div group_visits and the
remainder = visits*total % group_visits order the leftover units exactly
(float shares would let rounding noise break ties).

Scale: the cells are the output of a group-by on closed dimension domains,
so one (period, country) group holds at most the product of the other four
dimension domains (756 cells with the reference rules) plus one placeholder,
whatever the event volume; the per-group windows below therefore never pull
an unbounded group into one task.  The join with the totals is left to the
planner, which broadcasts them when it finds them small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import FunnelConfig

GROUP = ("period", "geo_country")
ORDER_DIMS = ("landing_family", "channel", "device", "new_returning")
MEASURES = ("trials", "paid")


def cell_visit_totals(cells: DataFrame) -> DataFrame:
    """Visits per (period, country) next to each cell."""
    return cells.withColumn("group_visits", F.sum("visits").over(Window.partitionBy(*GROUP)))


def _placeholder_candidates(totals: DataFrame, cfg: FunnelConfig) -> DataFrame:
    """M1 candidates: one placeholder per (period, country) with trials or paid."""
    dims = dict(cfg.placeholder_dims)
    return totals.filter((F.col("trials") > 0) | (F.col("paid") > 0)).select(
        "period", F.lit(dims["landing_family"]).alias("landing_family"), F.lit(dims["channel"]).alias("channel"),
        F.col("country").alias("geo_country"), F.lit(dims["device"]).alias("device"),
        F.lit(dims["new_returning"]).alias("new_returning"),
        F.lit(0).cast("long").alias("visits"), F.lit(0).cast("long").alias("activations"),
        F.lit(True).alias("is_placeholder"))


def with_placeholders(cells: DataFrame, totals: DataFrame, cfg: FunnelConfig) -> DataFrame:
    """J10 + M1: the cells plus a placeholder row for every (period, country)
    that has trials or paid but no (or only zero) visits in the cube.

    A candidate is added for every group with totals and dropped again where
    the group's visit sum (a window over the group) is positive.  This reads
    the cube once; an anti join back to the cube would make Spark compute the
    whole cube twice, since the two branches prune to different plans.
    A placeholder may share its key with an activation-only row; both stay.
    """
    base = cells if "is_placeholder" in cells.columns else cells.select("*", F.lit(False).alias("is_placeholder"))
    rows = base.unionByName(_placeholder_candidates(totals, cfg))
    gv = F.sum("visits").over(Window.partitionBy(*GROUP))
    return (rows.select("*", gv.alias("_gv"))
            .filter(~(F.col("is_placeholder") & (F.col("_gv") > 0)))
            .drop("_gv"))


def missing_cells(cells: DataFrame, totals: DataFrame, cfg: FunnelConfig) -> DataFrame:
    """J10 + M1 alone: the placeholder rows."""
    return with_placeholders(cells, totals, cfg).filter(F.col("is_placeholder"))


def allocate(cells: DataFrame, totals: DataFrame, cfg: FunnelConfig) -> DataFrame:
    """M1-M7: cells + placeholders with ``trials`` and ``paid`` allocated.

    Per group and stage with total T, group visits V and n rows:
      * no totals at all (both 0 or missing)      -> 0           (M2)
      * V > 0 and T <= 0                           -> 0           (M5)
      * V > 0: floor(visits*T/V), plus one unit for the T - sum(floor)
        rows with the largest remainders; ties by the dimensions    (M3, M4)
      * V = 0: floor(T/n), plus one for the first T mod n rows ordered by
        (placeholder last, dimensions) -- activation-only rows included (M6)
    """
    rows = with_placeholders(cells, totals, cfg)
    tot = totals.select("period", F.col("country").alias("geo_country"),
                        F.coalesce("trials", F.lit(0)).cast("long").alias("t_trials"),
                        F.coalesce("paid", F.lit(0)).cast("long").alias("t_paid"))
    grp = Window.partitionBy(*GROUP)
    order = [F.col("is_placeholder"), *[F.col(c) for c in ORDER_DIMS]]
    # A missing totals row means 0 for both stages.
    x = rows.join(tot, list(GROUP), "left").select(
        *rows.columns,
        F.coalesce("t_trials", F.lit(0)).alias("t_trials"),
        F.coalesce("t_paid", F.lit(0)).alias("t_paid"),
        F.sum("visits").over(grp).alias("gv"),
        F.count(F.lit(1)).over(grp).alias("gn"),
        F.row_number().over(grp.orderBy(*order)).alias("pos"))
    # Floors and exact remainders (NULL in groups without visits).
    x = x.select("*", *[e for m in MEASURES for e in (
        F.expr(f"visits * t_{m} div nullif(gv, 0)").alias(f"fl_{m}"),
        F.expr(f"visits * t_{m} % nullif(gv, 0)").alias(f"rem_{m}"))])
    # Units left after the floors, and each row's rank by remainder.
    x = x.select("*", *[e for m in MEASURES for e in (
        (F.col(f"t_{m}") - F.sum(f"fl_{m}").over(grp)).alias(f"left_{m}"),
        F.row_number().over(grp.orderBy(F.col(f"rem_{m}").desc(), *order)).alias(f"rk_{m}"))])
    no_totals = (F.col("t_trials") == 0) & (F.col("t_paid") == 0)
    out = {}
    for m in MEASURES:
        t = F.col(f"t_{m}")
        weighted = F.when(t <= 0, F.lit(0)).otherwise(
            F.col(f"fl_{m}") + F.when(F.col(f"rk_{m}") <= F.col(f"left_{m}"), 1).otherwise(0))
        even = (F.expr(f"(t_{m} - pmod(t_{m}, gn)) div gn")
                + F.when(F.col("pos") <= F.pmod(t, F.col("gn")), 1).otherwise(0))
        out[m] = F.when(no_totals, F.lit(0)).when(F.col("gv") > 0, weighted).otherwise(even).cast("long")
    x = x.select(*[c for c in x.columns if c not in out], *[v.alias(k) for k, v in out.items()])
    return x.select("period", "landing_family", "channel", "geo_country", "device", "new_returning",
                    "visits", "activations", "trials", "paid", "is_placeholder")


def top_per_group(df: DataFrame, n: int, group=("period",)) -> DataFrame:
    """M8: keep the n rows per period with the largest visits+trials+paid
    (activations excluded); ties by the dimensions.  For n up to
    ``spark.sql.optimizer.windowGroupLimitThreshold`` Catalyst plans a
    WindowGroupLimit (each task keeps n rows per period); above it the
    window sorts the period's rows, which the closed cell domain bounds."""
    score = F.col("visits") + F.col("trials") + F.col("paid")
    w = Window.partitionBy(*group).orderBy(score.desc(), *[F.col(c) for c in
                                           ("landing_family", "channel", "geo_country", "device",
                                            "new_returning", "is_placeholder")])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")
