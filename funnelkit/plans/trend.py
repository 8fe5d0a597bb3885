"""The weekly trend with its weekday-aligned prior-year overlay.

Two calendars meet here: web weeks start on Monday (``trunc(d, 'week')``),
aggregate weeks on Sunday and are moved one day forward to line up.  The
prior year is 364 days back, which keeps weekdays aligned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FunnelConfig
from ..functions.dates import in_ranges
from ..functions.rules import in_list
from ..operators.sessions import filter_events, is_visit, session_facts, signup_in_scope, with_week
from ..operators.totals import union_measures
from ..sources.tables import week_grid

TREND_KEYS = ("wk", "user_pseudo_id", "session_id")


def by_week(df: DataFrame) -> DataFrame:
    """O1: order a weekly series by week.  The series are bounded by the
    week grid (at most 2 x trend_weeks rows), so one partition sorted
    locally gives the total order without the sampling job and range
    shuffle of a global ``orderBy``."""
    return df.coalesce(1).sortWithinPartitions("wk")


TREND_FIELDS = ("page_group", "geo_country")
MEASURES = ("visits", "activations", "trials", "paid")


def weekly_facts(events: DataFrame, cfg: FunnelConfig, ranges=None, signup_geo: bool = True) -> DataFrame:
    """(wk, user, session) facts over both trend ranges in one scan.

    The week is part of the session key: a session spanning Sunday midnight
    is counted in both weeks, as in the source job.  ``signup_geo`` adds the
    earliest sign-up geo, needed only for a country scope.
    """
    ev = with_week(filter_events(events, cfg, ranges or cfg.trend_ranges))
    return session_facts(ev, cfg, keys=TREND_KEYS, fields=TREND_FIELDS, signup_geo=signup_geo)


def _is_visit(cfg: FunnelConfig, scope_country: str | None) -> Column:
    """A session that counts as a visit: an acquisition entry, anonymous only
    if asked for (F8), within the country scope (F9)."""
    visit = is_visit(F.col("entry").isNotNull() & in_list("entry.page_group", cfg.acq), cfg)
    if scope_country is not None:
        visit = visit & (F.col("entry.geo_country") == scope_country)
    return visit


def weekly_visits(facts: DataFrame, cfg: FunnelConfig, scope_country: str | None = None) -> DataFrame:
    """Acquisition sessions per week (F9 scope on the entry geo)."""
    return facts.filter(_is_visit(cfg, scope_country)).groupBy("wk").agg(F.count(F.lit(1)).alias("visits"))


def weekly_signup_users(facts: DataFrame, scope_country: str | None = None) -> DataFrame:
    """One row per (wk, user) with a sign-up; with a scope, those whose
    earliest sign-up event with a geo in the week is in that country."""
    signed = facts.filter(F.col("signup_date").isNotNull())
    if scope_country is None:
        return signed.select("wk", "user_pseudo_id").distinct()
    inside = signup_in_scope(signed, scope_country).alias("in_scope")
    return signed.groupBy("wk", "user_pseudo_id").agg(inside).filter("in_scope = 1").drop("in_scope")


def weekly_activations(facts: DataFrame, scope_country: str | None = None) -> DataFrame:
    """Distinct sign-up users per week; a user counts in every week
    with a sign-up.  ``count(user)`` on the (wk, user) grain = COUNT(DISTINCT)."""
    return weekly_signup_users(facts, scope_country).groupBy("wk").agg(F.count("user_pseudo_id").alias("activations"))


def weekly_web_trend(events: DataFrame, cfg: FunnelConfig, scope_country: str | None = None,
                     ranges=None) -> DataFrame:
    """P5: wk -> visits, activations (A12-A14, J3, F9), ordered by week, over
    the two trend ranges or any given ``ranges`` [(start, end)]."""
    return by_week(_web_series(events, cfg, scope_country, ranges))


def _web_series(events: DataFrame, cfg: FunnelConfig, scope_country: str | None, ranges=None) -> DataFrame:
    """The weekly web series in one pass.

    Visits per week and sign-up users per (week, user) come out of one
    GROUPING SETS aggregate over the session facts, so the events are
    scanned and shuffled once (two aggregates would each redo both).
    A week is present when it has a visit or a (scoped) sign-up user, as
    with the reference's FULL OUTER JOIN of the two weekly series.
    """
    facts = weekly_facts(events, cfg, ranges, signup_geo=scope_country is not None)
    aggs = [F.count(F.when(_is_visit(cfg, scope_country), 1)).alias("visits"), F.min("signup_date").alias("signup_date")]
    if scope_country is not None:
        aggs.append(signup_in_scope(facts, scope_country).alias("in_scope"))
    g = (facts.groupingSets([["wk"], ["wk", "user_pseudo_id"]], "wk", "user_pseudo_id")
         .agg(*aggs, F.grouping_id().alias("gid")))
    is_user = F.col("gid") == 0
    signed = is_user & F.col("signup_date").isNotNull()
    if scope_country is not None:
        signed = signed & (F.col("in_scope") == 1)
    rows = g.filter((~is_user & (F.col("visits") > 0)) | signed).select(
        "wk",
        F.when(is_user, F.lit(0)).otherwise(F.col("visits")).cast("long").alias("visits"),
        F.when(is_user & F.col("user_pseudo_id").isNotNull(), 1).otherwise(0).cast("long").alias("activations"))
    return rows.groupBy("wk").agg(F.sum("visits").alias("visits"), F.sum("activations").alias("activations"))


def weekly_aggregate_trend(trials: DataFrame, paid: DataFrame, cfg: FunnelConfig,
                           scope_country: str | None = None) -> DataFrame:
    """Sunday aggregate weeks moved to Monday, summed per week."""
    return by_week(_aggregate_series(trials, paid, cfg, scope_country))


def _aggregate_series(trials: DataFrame, paid: DataFrame, cfg: FunnelConfig, scope_country: str | None) -> DataFrame:
    u = union_measures(trials, paid).filter(in_ranges("week", cfg.trend_week_ranges_sunday))
    if scope_country is not None:
        u = u.filter(F.col("country_group") == scope_country)
    return (u.groupBy(F.date_add("week", 1).alias("wk"))
            .agg(F.coalesce(F.sum("trials"), F.lit(0)).cast("long").alias("trials"),
                 F.coalesce(F.sum("paid"), F.lit(0)).cast("long").alias("paid")))


def weekly_aggregate_prev_year(trials: DataFrame, paid: DataFrame, start, end,
                               scope_country: str | None = None) -> DataFrame:
    """A16/J6 (older joined form) with previous-year measures.

    The older query joined the two tables row by row on (week, group, key)
    before summing; here each side is aggregated to the week first and the
    week key is coalesced, so repeated keys cannot multiply and rows present
    on one side only keep their week.
    """
    t = trials.select("week", "country_group", F.col("free_trial_users").alias("trials"),
                      F.col("free_trial_users_prev_yr").alias("trials_prev_yr"))
    p = paid.select("week", "country_group", F.col("total_bookings_users").alias("paid"),
                    F.col("total_bookings_users_prev_yr").alias("paid_prev_yr"))
    u = t.unionByName(p, allowMissingColumns=True).filter(F.col("week").between(F.lit(start), F.lit(end)))
    if scope_country is not None:
        u = u.filter(F.col("country_group") == scope_country)
    cols = ("trials", "trials_prev_yr", "paid", "paid_prev_yr")
    return u.groupBy(F.col("week").alias("wk")).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in cols])


def trend_grid(web: DataFrame, agg: DataFrame, cfg: FunnelConfig) -> DataFrame:
    """P7 + J9: the trend-week grid with current and prior-year measures,
    zero-filled.

    Every weekly row contributes twice: to its own week as current measures
    and to the week ``trend_shift_days`` later as prior-year measures.  The
    grid rows (flagged) are unioned in and one aggregate by week keeps the
    grid weeks.  This is the lookup-with-default of the source job without a
    join: a join on the current and on the prior week would read the weekly
    series twice, and Spark would compute its whole event pipeline twice.
    """
    shift = cfg.trend_shift_days
    prior = [f"{m}_prior" for m in MEASURES]
    zero = F.lit(0).cast("long")

    def contributions(df: DataFrame) -> DataFrame:
        have = [m for m in MEASURES if m in df.columns]
        cur = F.struct(F.col("wk").alias("wk"),
                       *[(F.col(m) if m in have else zero).cast("long").alias(m) for m in MEASURES],
                       *[zero.alias(p) for p in prior])
        pri = F.struct(F.date_add("wk", shift).alias("wk"), *[zero.alias(m) for m in MEASURES],
                       *[(F.col(m) if m in have else zero).cast("long").alias(f"{m}_prior") for m in MEASURES])
        return (df.select(F.explode(F.array(cur, pri)).alias("c")).select("c.*")
                .withColumn("in_grid", F.lit(0)))

    grid = week_grid(web.sparkSession, cfg).select(
        "wk", *[zero.alias(c) for c in (*MEASURES, *prior)], F.lit(1).alias("in_grid"))
    rows = grid.unionByName(contributions(web)).unionByName(contributions(agg))
    out = (rows.groupBy("wk")
           .agg(F.max("in_grid").alias("in_grid"), *[F.sum(c).alias(c) for c in (*MEASURES, *prior)])
           .filter(F.col("in_grid") == 1))
    return out.select("wk", F.date_sub("wk", shift).alias("prior_wk"), *MEASURES, *prior).transform(by_week)


def trend(events: DataFrame, trials: DataFrame, paid: DataFrame, cfg: FunnelConfig,
          scope_country: str | None = None) -> DataFrame:
    """P5 + P6 + P7 together; sorted once, at the end."""
    return trend_grid(_web_series(events, cfg, scope_country),
                      _aggregate_series(trials, paid, cfg, scope_country), cfg)


def trend_arrays(grid: DataFrame) -> DataFrame:
    """K2: one row; every array is indexed by week position.

    Collects exactly the grid's rows (``trend_weeks`` of them, fixed by the
    configuration) into one row, ordered by week.
    """
    row = F.struct("wk", "prior_wk", *MEASURES, *[f"{m}_prior" for m in MEASURES])
    s = grid.agg(F.array_sort(F.collect_list(row)).alias("r"))
    iso = "yyyy-MM-dd"

    def field(name):  # one-argument lambda: transform() treats two as (x, index)
        return lambda x: x.getField(name)

    return s.select(
        F.transform("r", lambda x: F.date_format(x.getField("wk"), iso)).alias("weeks"),
        F.transform("r", lambda x: F.date_format(x.getField("prior_wk"), iso)).alias("weeks_prior_year"),
        *[F.transform("r", field(m)).alias(f"{m}_current") for m in MEASURES],
        *[F.transform("r", field(f"{m}_prior")).alias(f"{m}_prior") for m in MEASURES],
    )
