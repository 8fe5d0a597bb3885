"""P8 calibration against published stage totals, P9 period totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import STAGES, FunnelConfig
from ..functions.rules import in_list
from ..operators.sessions import host_filter, session_facts, signup_in_scope
from ..sources.tables import targets_df, windows_df


def fiscal_slice(weekly: DataFrame, cfg: FunnelConfig) -> DataFrame:
    """rows of the configured fiscal year and week range."""
    a, b = cfg.fiscal_weeks
    return weekly.filter((F.col("fy_text") == cfg.fiscal_year) & F.col("fw_number").between(a, b))


def fiscal_bounds(trials: DataFrame, cfg: FunnelConfig) -> DataFrame:
    """First and last fiscal week; the window ends 6 days after the last."""
    return (fiscal_slice(trials, cfg)
            .agg(F.min("week").alias("first_wk"), F.max("week").alias("last_wk"))
            .withColumn("end_date", F.date_add("last_wk", 6)))


def calibration_measures(events: DataFrame, trials: DataFrame, paid: DataFrame, cfg: FunnelConfig,
                         scope_country: str | None = None) -> DataFrame:
    """A18-A20 + J8: one row with the four measured stage values.

    One aggregate of the trials gives the fiscal bounds and the scoped sum.
    The bounds reach the event scan as scalar subqueries, which Spark runs
    first and prunes ``event_date`` partitions with; nothing runs while the
    plan is built.  An empty fiscal slice has NULL bounds and so no events.
    """
    scope = cfg.scope_country if scope_country is None else scope_country

    def scoped(col):
        return F.coalesce(F.sum(F.when(F.col("country_group") == scope, F.col(col))), F.lit(0)).cast("long").alias("v")

    # one struct, so that Spark plans one subquery for its three uses
    quarter = fiscal_slice(trials, cfg).agg(F.struct(
        F.min("week").alias("first_wk"), F.date_add(F.max("week"), 6).alias("end_date"), scoped("free_trial_users"))).scalar()
    booked = fiscal_slice(paid, cfg).agg(scoped("total_bookings_users"))
    ev = events.filter(F.col("event_date").between(quarter.getField("first_wk"), quarter.getField("end_date")) & host_filter(cfg))
    facts = session_facts(ev, cfg, fields=("page_group", "geo_country"), signup_geo=True)
    # Visits (a global count of sessions) and activations (users, each with
    # the geo of their earliest sign-up) from one GROUPING SETS pass, so the
    # events are scanned and shuffled once.
    visit = (F.col("entry").isNotNull() & (F.col("entry.geo_country") == scope)
             & in_list("entry.page_group", cfg.acq))
    g = (facts.groupingSets([[], ["user_pseudo_id"]], "user_pseudo_id")
         .agg(F.count(F.when(visit, 1)).alias("visits"),
              F.min("signup_date").alias("signup_date"),
              signup_in_scope(facts, scope).alias("in_scope"),
              F.grouping_id().alias("gid")))
    is_user = F.col("gid") == 0
    web = g.agg(
        F.coalesce(F.sum(F.when(~is_user, F.col("visits"))), F.lit(0)).cast("long").alias("visits"),
        F.count(F.when(is_user & F.col("signup_date").isNotNull() & (F.col("in_scope") == 1),
                       F.col("user_pseudo_id"))).alias("activations"))
    # The other sides are one-row aggregates, added as scalars
    return web.select("visits", "activations", quarter.getField("v").alias("trials"),
                      booked.select("v").scalar().alias("paid"))


def calibrate(events: DataFrame, trials: DataFrame, paid: DataFrame, cfg: FunnelConfig,
              scope_country: str | None = None) -> DataFrame:
    """Stage, measured, reference, delta_pct (6 places), flag OK/OVER.

    OVER means outside the tolerance in either direction, as in the
    reference; a zero reference gives delta 0.
    """
    m = calibration_measures(events, trials, paid, cfg, scope_country)
    stack = F.explode(F.array(*[F.struct(F.lit(s).alias("stage"), F.col(s).cast("long").alias("measured"))
                                for s in STAGES])).alias("x")
    return score_calibration(m.select(stack).select("x.stage", "x.measured"), cfg)


def score_calibration(measured: DataFrame, cfg: FunnelConfig) -> DataFrame:
    """(stage, measured) -> + reference, delta_pct, flag against the targets."""
    t = targets_df(measured.sparkSession, cfg)
    j = measured.join(F.broadcast(t), "stage", "left")
    delta = F.when(F.col("reference") != 0,
                   (F.col("measured") - F.col("reference")) / F.col("reference") * 100).otherwise(F.lit(0.0))
    # Flag on the exact delta; only the reported value is rounded.
    return j.select("stage", "measured", "reference", F.round(delta.cast("double"), 6).alias("delta_pct"),
                    F.when(F.abs(delta) <= cfg.tolerance_pct, F.lit("OK")).otherwise(F.lit("OVER")).alias("flag"))


def period_totals(cube: DataFrame, cfg: FunnelConfig, country: str | None = None) -> DataFrame:
    """Per period, each stage globally and for one country; periods
    without rows show 0.  The cube column may be ``country`` or ``geo_country``."""
    scope = cfg.scope_country if country is None else country
    ccol = "country" if "country" in cube.columns else "geo_country"
    aggs = []
    for s in STAGES:
        aggs.append(F.sum(s).alias(f"{s}_global"))
        aggs.append(F.sum(F.when(F.col(ccol) == scope, F.col(s)).otherwise(0)).alias(f"{s}_scoped"))
    # One row per period after the aggregate: bounded by the window count.
    per = cube.groupBy("period").agg(*aggs)
    w = windows_df(cube.sparkSession, cfg).select("period")
    out = w.join(F.broadcast(per), "period", "left")
    return out.select("period", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
                                  for c in per.columns if c != "period"])
