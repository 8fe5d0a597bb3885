"""Window tagging and the visits / activations cube.

All group-bys here are on a closed dimension domain (a few thousand cells
per period), so after map-side partial aggregation each shuffle carries at
most (#map tasks x #cells) rows whatever the event volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DIMENSIONS, FunnelConfig
from ..functions.dates import period_tags
from .sessions import is_visit, picked_attrs, session_pick, signup_dimensions

CELL_KEYS = ("period",) + DIMENSIONS


def tag_periods(df: DataFrame, date_col: str, windows) -> DataFrame:
    """One row per window containing ``date_col`` (0..n rows per input).

    Windows overlap (30d lies inside 90d), so this is a per-row explode of an
    array of matching window names rather than a range join.
    """
    return df.select("*", F.explode(period_tags(date_col, windows)).alias("period"))


def visits_by_period(dims: DataFrame, cfg: FunnelConfig, windows=None, keys=CELL_KEYS) -> DataFrame:
    """A5: acquisition sessions per (period, 5 dims)."""
    tagged = tag_periods(dims.filter(is_visit(F.col("is_acq") == 1, cfg)), "session_date", windows or cfg.windows)
    return tagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("visits"))


def activations_by_period(users: DataFrame, cfg: FunnelConfig, windows=None, keys=CELL_KEYS) -> DataFrame:
    """Sign-up users per (period, 5 dims).

    ``users`` has one row per user, so ``count(user)`` equals COUNT(DISTINCT)
    without the distinct's extra shuffle; NULL users count 0 as in SQL.
    """
    tagged = tag_periods(users, "signup_date", windows or cfg.windows)
    return tagged.groupBy(*keys).agg(F.count("user_pseudo_id").alias("activations"))


def cube_cells(dims: DataFrame, cfg: FunnelConfig, windows=None) -> DataFrame:
    """A5 + A6/A8/J5 + A9 + J1 in one pass over the session rows.

    Visits are counted per (period, 5 dims) and sign-up users are reduced per
    user from the SAME session rows, through one GROUPING SETS aggregate
    (Spark's Expand + a single partial/final aggregate): the events are
    scanned and shuffled by session once.  Two separate aggregates over the
    session rows would each re-run the scan and the session shuffle, since
    column pruning gives them different partial aggregates that Spark cannot
    reuse.  Every buffer is fixed-width (counts, a date, and the packed
    ``session_pick``), so Spark runs it as a hash aggregate.  The user rows
    are then tagged with the windows of their first sign-up and folded into
    the same cells as the visits (union + sum).
    """
    windows = windows or cfg.windows
    visit = is_visit(F.col("is_acq") == 1, cfg) & F.col("period").isNotNull()
    tagged = dims.select("*", F.explode_outer(period_tags("session_date", windows)).alias("period"))
    keys = ["period", *DIMENSIONS, "user_pseudo_id"]
    g = (tagged.groupingSets([["period", *DIMENSIONS], ["user_pseudo_id"]], *keys)
         .agg(F.count(F.when(visit, 1)).alias("visits"),
              F.min("signup_date").alias("signup_date"),
              session_pick(dims, cfg).alias("pick"),
              F.grouping_id().alias("gid")))
    is_user = F.col("gid") != 1  # gid 1: only user_pseudo_id aggregated away
    keep = (~is_user & (F.col("visits") > 0)) | (is_user & F.col("signup_date").isNotNull())
    sd = signup_dimensions("attrs", "user_pseudo_id", cfg)
    rows = g.filter(keep).select("*", picked_attrs("pick", cfg).alias("attrs")).select(
        F.explode(F.when(is_user, period_tags("signup_date", windows))
                  .otherwise(F.array(F.col("period")))).alias("period"),
        *[F.when(is_user, sd[d]).otherwise(F.col(d)).alias(d) for d in DIMENSIONS],
        F.when(is_user, F.lit(0)).otherwise(F.col("visits")).cast("long").alias("visits"),
        F.when(is_user & F.col("user_pseudo_id").isNotNull(), 1).otherwise(0).cast("long").alias("activations"))
    return rows.groupBy(*CELL_KEYS).agg(F.sum("visits").alias("visits"), F.sum("activations").alias("activations"))


def suppress_small(cells: DataFrame, min_visits: int) -> DataFrame:
    """keep a cell with enough visits or any activation."""
    return cells.filter((F.col("visits") >= min_visits) | (F.col("activations") > 0))
