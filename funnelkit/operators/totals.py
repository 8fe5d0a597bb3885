"""Weekly aggregate totals per window and country bucket."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import FunnelConfig
from ..functions.dates import in_ranges
from ..sources.tables import bridge_df
from .cube import tag_periods

TRIALS_COL = "free_trial_users"
PAID_COL = "total_bookings_users"


def union_measures(trials: DataFrame, paid: DataFrame, extra=()) -> DataFrame:
    """One frame of (week, country_group, trials, paid) with NULL padding,
    so all windows are served by a single pass over each table."""
    t = trials.select("week", "country_group", *extra, F.col(TRIALS_COL).alias("trials"))
    p = paid.select("week", "country_group", *extra, F.col(PAID_COL).alias("paid"))
    return t.unionByName(p, allowMissingColumns=True)


def bridge_buckets(df: DataFrame, cfg: FunnelConfig, col: str = "country_group", out: str = "country") -> DataFrame:
    """Map a country group to its cube bucket; unknown or NULL -> Other.

    The bridge is a literal table of the configuration (a dozen rows), so
    broadcasting it is bounded by construction.
    """
    bridge = bridge_df(df.sparkSession, cfg).withColumnRenamed("country_group", "bridge_group")
    joined = df.join(F.broadcast(bridge), df[col] == bridge.bridge_group, "left")
    return joined.withColumn(out, F.coalesce(F.col("bucket"), F.lit("Other"))).drop("bridge_group", "bucket")


def window_totals(trials: DataFrame, paid: DataFrame, cfg: FunnelConfig) -> DataFrame:
    """A10: (period, country_group) -> trials, paid as integers, NULL -> 0.

    A weekly row belongs to a window when its week start does.
    """
    u = union_measures(trials, paid).filter(in_ranges("week", [(w.start, w.end) for w in cfg.windows]))
    return (tag_periods(u, "week", cfg.windows)
            .groupBy("period", "country_group")
            .agg(*[F.coalesce(F.sum(m).cast("long"), F.lit(0)).alias(m) for m in ("trials", "paid")]))


def aggregate_totals(trials: DataFrame, paid: DataFrame, cfg: FunnelConfig) -> DataFrame:
    """(period, country) -> trials, paid: the window totals rolled up to
    the bridge's buckets (A11)."""
    return (bridge_buckets(window_totals(trials, paid, cfg), cfg).groupBy("period", "country")
            .agg(F.sum("trials").alias("trials"), F.sum("paid").alias("paid")))
