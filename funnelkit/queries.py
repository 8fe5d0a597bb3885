"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` each.

Every query reads the driver's tables through the adapters of
``sources.fixtures`` and runs the library's operators over the whole data.
Names match ``oracle.py``; ``__spark_entry__`` exposes both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle as O
from .config import DIMENSIONS
from .functions.dates import monday_week
from .operators.allocate import cell_visit_totals, missing_cells as _missing, top_per_group
from .operators.bitmaps import daily_bitmaps, users_by_window
from .operators.cube import activations_by_period as _acts, visits_by_period as _visits
from .operators.sessions import entry_columns, filter_events, session_facts, sessions, signup_users, user_attributes
from .operators.ranking import top_per_group_exact
from .operators.totals import aggregate_totals as _totals, window_totals as _window_totals
from .operators.windows import rolling_windows, sums_by_window
from .plans import report as _report, trend as _trend
from .plans.cube import session_dimensions, web_cube as _web_cube, window_cube as _window_cube
from .plans.funnel import CUBE_COLUMNS, allocated_cube, funnel_cube as _funnel_cube
from .plans.job import run_build
from .plans.open_cube import OPEN_DIMS, open_cube
from .sinks import cube_document, cube_document_lines, document_text, read_published, trend_document
from .sources import fixtures as fx, read_weekly, weekly_violations, windows_df
from .storage import new_path


def q_events_in_ranges(spark: SparkSession, sf: str) -> DataFrame:
    cfg = fx.cube_config()
    return filter_events(fx.web_events(spark, sf), cfg, cfg.scan_ranges)


def q_session_entry_first_page(spark: SparkSession, sf: str) -> DataFrame:
    cfg = fx.cube_config()
    facts = session_facts(filter_events(fx.web_events(spark, sf), cfg, cfg.scan_ranges), cfg)
    return sessions(facts).select("user_pseudo_id", "session_id", "session_date", "is_new", *entry_columns())


def q_session_entry_first_event(spark: SparkSession, sf: str) -> DataFrame:
    cfg = O.older_config()
    facts = session_facts(filter_events(fx.web_events(spark, sf), cfg, cfg.scan_ranges), cfg)
    return sessions(facts).select("user_pseudo_id", "session_id", "session_date", "is_new", "any_uid",
                                  *entry_columns())


def q_session_dims(spark: SparkSession, sf: str) -> DataFrame:
    cfg = fx.cube_config()
    dims = session_dimensions(fx.web_events(spark, sf), cfg)
    return sessions(dims).select("user_pseudo_id", "session_id", "session_date", "new_returning", "geo_country",
                                 "device", "channel", "landing_family", "is_acq")


def q_landing_family_extended(spark: SparkSession, sf: str) -> DataFrame:
    cfg = O.older_config()
    dims = session_dimensions(fx.web_events(spark, sf), cfg)
    return sessions(dims).select("user_pseudo_id", "session_id", F.col("entry.page_group").alias("page_group"),
                                 "landing_family")


def q_visits_by_period(spark: SparkSession, sf: str) -> DataFrame:
    cfg = fx.cube_config()
    return _visits(session_dimensions(fx.web_events(spark, sf), cfg), cfg)


def q_first_signups(spark: SparkSession, sf: str) -> DataFrame:
    cfg = fx.cube_config()
    return signup_users(session_dimensions(fx.web_events(spark, sf), cfg), cfg).select("user_pseudo_id",
                                                                                      "signup_date")


def q_user_attrs(spark: SparkSession, sf: str) -> DataFrame:
    cfg = fx.cube_config()
    return user_attributes(session_dimensions(fx.web_events(spark, sf), cfg), cfg)


def q_activations_by_period(spark: SparkSession, sf: str) -> DataFrame:
    cfg = fx.cube_config()
    return _acts(signup_users(session_dimensions(fx.web_events(spark, sf), cfg), cfg), cfg)


def q_web_cube(spark: SparkSession, sf: str) -> DataFrame:
    return _web_cube(fx.web_events(spark, sf), fx.cube_config())


def q_window_cube(spark: SparkSession, sf: str) -> DataFrame:
    cfg, start, end = O.window_cube_args()
    return _window_cube(fx.web_events(spark, sf), start, end, cfg)


QUERIES = {
    "events_in_ranges": (q_events_in_ranges, O.events_in_ranges),
    "session_entry_first_page": (q_session_entry_first_page, O.session_entry_first_page),
    "session_entry_first_event": (q_session_entry_first_event, O.session_entry_first_event),
    "session_dims": (q_session_dims, O.session_dims),
    "landing_family_extended": (q_landing_family_extended, O.landing_family_extended),
    "visits_by_period": (q_visits_by_period, O.visits_by_period),
    "first_signups": (q_first_signups, O.first_signups),
    "user_attrs": (q_user_attrs, O.user_attrs),
    "activations_by_period": (q_activations_by_period, O.activations_by_period),
    "web_cube": (q_web_cube, O.web_cube),
    "window_cube": (q_window_cube, O.window_cube),
}


# -- totals and apportionment ---------------------------------------------------


def _cube_inputs(spark: SparkSession, sf: str):
    return fx.web_events(spark, sf), fx.web_trials(spark, sf), fx.web_paid(spark, sf)


def q_aggregate_totals(spark: SparkSession, sf: str) -> DataFrame:
    return _totals(fx.web_trials(spark, sf), fx.web_paid(spark, sf), fx.cube_config())


def q_aggregate_totals_headline(spark: SparkSession, sf: str) -> DataFrame:
    return _totals(fx.web_trials(spark, sf), fx.web_paid(spark, sf), fx.headline_config())


def q_window_totals_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return _window_totals(fx.web_trials(spark, sf), fx.web_paid(spark, sf), fx.cube_config())


def q_missing_cells(spark: SparkSession, sf: str) -> DataFrame:
    cfg = fx.cube_config()
    ev, tr, pd_ = _cube_inputs(spark, sf)
    return _missing(_web_cube(ev, cfg), _totals(tr, pd_, cfg), cfg)


_ALLOC = ("period", "landing_family", "channel", "geo_country", "device", "new_returning", "visits",
          "activations", "trials", "paid")


def q_allocate_shares(spark: SparkSession, sf: str) -> DataFrame:
    cfg = fx.cube_config()
    a = cell_visit_totals(allocated_cube(*_cube_inputs(spark, sf), cfg))
    return a.filter(F.col("group_visits") > 0).select(*_ALLOC, "group_visits")


def q_allocate_even_split(spark: SparkSession, sf: str) -> DataFrame:
    cfg = fx.cube_config()
    a = cell_visit_totals(allocated_cube(*_cube_inputs(spark, sf), cfg))
    return a.filter(F.col("group_visits") == 0).select(*_ALLOC, "is_placeholder")


def q_funnel_cube(spark: SparkSession, sf: str) -> DataFrame:
    return _funnel_cube(*_cube_inputs(spark, sf), fx.cube_config())


def q_cube_top_k(spark: SparkSession, sf: str) -> DataFrame:
    capped = top_per_group(allocated_cube(*_cube_inputs(spark, sf), fx.cube_config()), O.CUBE_TOP_K)
    return capped.select(*[F.col("geo_country").alias("country") if c == "country" else F.col(c)
                           for c in CUBE_COLUMNS])


QUERIES.update({
    "aggregate_totals": (q_aggregate_totals, O.aggregate_totals),
    "aggregate_totals_headline": (q_aggregate_totals_headline, O.aggregate_totals_headline),
    "window_totals_by_group": (q_window_totals_by_group, O.window_totals_by_group),
    "missing_cells": (q_missing_cells, O.missing_cells),
    "allocate_shares": (q_allocate_shares, O.allocate_shares),
    "allocate_even_split": (q_allocate_even_split, O.allocate_even_split),
    "funnel_cube": (q_funnel_cube, O.funnel_cube),
    "cube_top_k": (q_cube_top_k, O.cube_top_k),
})


# -- weekly trend and reports ----------------------------------------------------


def _trend_inputs(spark: SparkSession, sf: str):
    return fx.order_events(spark, sf), fx.order_trials(spark, sf), fx.order_paid(spark, sf)


def q_weekly_visits(spark: SparkSession, sf: str) -> DataFrame:
    cfg = fx.trend_config()
    return _trend.weekly_visits(_trend.weekly_facts(fx.order_events(spark, sf), cfg), cfg)


def q_weekly_activations(spark: SparkSession, sf: str) -> DataFrame:
    cfg = fx.trend_config()
    return _trend.weekly_activations(_trend.weekly_facts(fx.order_events(spark, sf), cfg))


def q_weekly_web_trend(spark: SparkSession, sf: str) -> DataFrame:
    return _trend.weekly_web_trend(fx.order_events(spark, sf), fx.trend_config())


def q_weekly_web_trend_scoped(spark: SparkSession, sf: str) -> DataFrame:
    cfg = fx.trend_config()
    return _trend.weekly_web_trend(fx.order_events(spark, sf), cfg, cfg.scope_country)


def q_weekly_web_trend_anonymous(spark: SparkSession, sf: str) -> DataFrame:
    return _trend.weekly_web_trend(fx.order_events(spark, sf), fx.trend_config().with_(exclude_identified=True))


def q_weekly_web_trend_range(spark: SparkSession, sf: str) -> DataFrame:
    return _trend.weekly_web_trend(fx.order_events(spark, sf), fx.trend_config(), ranges=[O.TREND_RANGE])


def q_weekly_aggregate_trend_scoped(spark: SparkSession, sf: str) -> DataFrame:
    cfg = fx.trend_config()
    return _trend.weekly_aggregate_trend(fx.order_trials(spark, sf), fx.order_paid(spark, sf), cfg, cfg.scope_country)


def q_weekly_aggregate_trend(spark: SparkSession, sf: str) -> DataFrame:
    return _trend.weekly_aggregate_trend(fx.order_trials(spark, sf), fx.order_paid(spark, sf), fx.trend_config())


def q_weekly_aggregate_prev_year(spark: SparkSession, sf: str) -> DataFrame:
    s, e = O.prev_year_range(fx.trend_config())
    return _trend.weekly_aggregate_prev_year(fx.order_trials(spark, sf), fx.order_paid(spark, sf), s, e)


def q_trend_grid(spark: SparkSession, sf: str) -> DataFrame:
    return _trend.trend(*_trend_inputs(spark, sf), fx.trend_config())


def q_trend_document(spark: SparkSession, sf: str) -> DataFrame:
    """K2: the whole trend document as JSON text (one row)."""
    return document_text(trend_document(_trend.trend_arrays(q_trend_grid(spark, sf))))


def q_fiscal_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return _report.fiscal_bounds(fx.order_trials(spark, sf), fx.trend_config())


def q_calibration(spark: SparkSession, sf: str) -> DataFrame:
    return _report.calibrate(*_trend_inputs(spark, sf), fx.trend_config())


def q_period_totals(spark: SparkSession, sf: str) -> DataFrame:
    cfg = fx.cube_config()
    return _report.period_totals(_funnel_cube(*_cube_inputs(spark, sf), cfg), cfg)


def q_cube_document(spark: SparkSession, sf: str) -> DataFrame:
    """K1 + K3: the whole cube document (header + rows) as JSON text."""
    cfg = fx.cube_config()
    return document_text(cube_document(_funnel_cube(*_cube_inputs(spark, sf), cfg), cfg))


QUERIES.update({
    "cube_document": (q_cube_document, O.cube_document),
    "weekly_visits": (q_weekly_visits, O.weekly_visits),
    "weekly_activations": (q_weekly_activations, O.weekly_activations),
    "weekly_web_trend": (q_weekly_web_trend, O.weekly_web_trend),
    "weekly_web_trend_scoped": (q_weekly_web_trend_scoped, O.weekly_web_trend_scoped),
    "weekly_web_trend_anonymous": (q_weekly_web_trend_anonymous, O.weekly_web_trend_anonymous),
    "weekly_web_trend_range": (q_weekly_web_trend_range, O.weekly_web_trend_range),
    "weekly_aggregate_trend_scoped": (q_weekly_aggregate_trend_scoped, O.weekly_aggregate_trend_scoped),
    "weekly_aggregate_trend": (q_weekly_aggregate_trend, O.weekly_aggregate_trend),
    "weekly_aggregate_prev_year": (q_weekly_aggregate_prev_year, O.weekly_aggregate_prev_year),
    "trend_grid": (q_trend_grid, O.trend_grid),
    "trend_document": (q_trend_document, O.trend_document),
    "fiscal_bounds": (q_fiscal_bounds, O.fiscal_bounds),
    "calibration": (q_calibration, O.calibration),
    "period_totals": (q_period_totals, O.period_totals),
})


# -- open domains, window tables, publication ------------------------------------


def _open_cube(spark: SparkSession, sf: str) -> DataFrame:
    cfg = fx.cube_config().with_(top_countries=None)
    return open_cube(fx.hot_events(spark, sf), fx.web_trials(spark, sf), fx.web_paid(spark, sf), cfg)


_OPEN = ("period", "geo_country", *OPEN_DIMS, "visits", "activations", "trials", "paid", "is_placeholder")


def q_allocate_shares_open(spark: SparkSession, sf: str) -> DataFrame:
    """M3, M4 where one (period, country) holds a third of the cells and more."""
    return _open_cube(spark, sf).filter(F.col("group_visits") > 0).select(*_OPEN, "group_visits")


def q_allocate_even_split_open(spark: SparkSession, sf: str) -> DataFrame:
    """M6 and J10 on groups of any size."""
    return _open_cube(spark, sf).filter(F.col("group_visits") == 0).select(*_OPEN)


def q_cube_top_30000(spark: SparkSession, sf: str) -> DataFrame:
    """M8 at the source job's cap, on more rows than that."""
    order = ("landing_family", "channel", "geo_country", "device", "new_returning", "activations", "trials", "paid")
    return top_per_group_exact(fx.line_cells(spark, sf), O.CUBE_CAP, F.col("visits") + F.col("trials") + F.col("paid"),
                               ("period",), order)


def _rolling(spark: SparkSession, sf: str) -> DataFrame:
    days = filter_events(fx.web_events(spark, sf), fx.cube_config(), [O.ROLLING_RANGE]).select("event_date")
    return rolling_windows(days, O.ROLLING_DAYS)


def q_window_table_sums(spark: SparkSession, sf: str) -> DataFrame:
    """J7 with 1,000+ overlapping windows as a table: visits and sign-up users."""
    cfg = fx.cube_config()
    dims = session_dimensions(fx.web_events(spark, sf), cfg, [O.ROLLING_RANGE])
    visits = dims.filter("is_acq = 1").select(F.col("session_date").alias("day"), F.lit(1).alias("visits"),
                                              F.lit(0).alias("activations"))
    users = signup_users(dims, cfg).filter(F.col("user_pseudo_id").isNotNull()).select(
        F.col("signup_date").alias("day"), F.lit(0).alias("visits"), F.lit(1).alias("activations"))
    return sums_by_window(visits.unionByName(users), "day", _rolling(spark, sf), (),
                          {"visits": F.col("visits"), "activations": F.col("activations")})


def q_activations_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    """A9 from daily bitmaps."""
    cfg = fx.cube_config()
    users = signup_users(session_dimensions(fx.web_events(spark, sf), cfg), cfg)
    return users_by_window(daily_bitmaps(users, "user_pseudo_id", "signup_date", DIMENSIONS), "signup_date",
                           windows_df(spark, cfg), DIMENSIONS, into="activations")


def _signup_days(spark: SparkSession, sf: str, events: DataFrame, cfg, ranges) -> DataFrame:
    return filter_events(events, cfg, ranges).filter(F.col("event_name") == cfg.signup_event).select(
        "user_pseudo_id", "event_date")


def q_weekly_activations_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    """A14 from daily bitmaps: the weeks are windows."""
    cfg = fx.trend_config()
    rows = _signup_days(spark, sf, fx.order_events(spark, sf), cfg, cfg.trend_ranges)
    weeks = rows.select(monday_week(F.col("event_date")).alias("start")).distinct().select(
        F.col("start").alias("period"), "start", F.date_add("start", 6).alias("end"))
    return users_by_window(daily_bitmaps(rows, "user_pseudo_id", "event_date"), "event_date", weeks,
                           into="activations").withColumnRenamed("period", "wk")


def q_window_signup_users(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct users with a sign-up in each of 1,000+ overlapping windows."""
    rows = _signup_days(spark, sf, fx.web_events(spark, sf), fx.cube_config(), [O.ROLLING_RANGE])
    return users_by_window(daily_bitmaps(rows, "user_pseudo_id", "event_date"), "event_date", _rolling(spark, sf))


def q_weekly_aggregate_prev_year_scoped(spark: SparkSession, sf: str) -> DataFrame:
    cfg = fx.trend_config()
    s, e = O.prev_year_range(cfg)
    return _trend.weekly_aggregate_prev_year(fx.order_trials(spark, sf), fx.order_paid(spark, sf), s, e, cfg.scope_country)


def _stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """A weekly frame as a stored table, read by the library's weekly reader."""
    path = new_path(spark, name)
    df.write.parquet(path)
    return read_weekly(spark, path, df.schema)


def q_weekly_reader_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Both weekly tables through ``read_weekly``, checked."""
    return _window_totals(_stored(spark, fx.web_trials(spark, sf), "trials.parquet"),
                          _stored(spark, fx.web_paid(spark, sf), "paid.parquet"), fx.cube_config())


def q_weekly_violations(spark: SparkSession, sf: str) -> DataFrame:
    """The calendar checks as counts, on a table with moved and repeated weeks."""
    rows = fx.web_trials(spark, sf)
    moved = rows.withColumn("week", F.when(F.col("country_group") == "NATION_2", F.date_add("week", 1)).otherwise(F.col("week")))
    return weekly_violations(moved.unionByName(rows.filter(F.col("country_group") == "NATION_1")))


def q_extract_counts(spark: SparkSession, sf: str) -> DataFrame:
    """K4: the rows of the extracts, as the build reports them."""
    out = run_build(spark, *_cube_inputs(spark, sf), fx.cube_config(), new_path(spark, "counted"),
                    trend_inputs=_trend_inputs(spark, sf), top_rows=O.CUBE_CAP)
    return spark.read.parquet(out["row_counts"])


def q_published_cube(spark: SparkSession, sf: str) -> DataFrame:
    """K1 + K3 as one publication: the cube that the newest manifest names."""
    root = new_path(spark, "published")
    run_build(spark, *_cube_inputs(spark, sf), fx.cube_config(), root, trend_inputs=_trend_inputs(spark, sf))
    return read_published(spark, root, "cube")


def q_cube_document_lines(spark: SparkSession, sf: str) -> DataFrame:
    """K1 + K3 as a stream of numbered pieces."""
    cfg = fx.cube_config()
    return cube_document_lines(_funnel_cube(*_cube_inputs(spark, sf), cfg), cfg)


QUERIES.update({
    "allocate_shares_open": (q_allocate_shares_open, O.allocate_shares_open),
    "allocate_even_split_open": (q_allocate_even_split_open, O.allocate_even_split_open),
    "cube_top_30000": (q_cube_top_30000, O.cube_top_30000),
    "window_table_sums": (q_window_table_sums, O.window_table_sums),
    "activations_bitmap": (q_activations_bitmap, O.activations_by_period),
    "weekly_activations_bitmap": (q_weekly_activations_bitmap, O.weekly_activations),
    "window_signup_users": (q_window_signup_users, O.window_signup_users),
    "weekly_aggregate_prev_year_scoped": (q_weekly_aggregate_prev_year_scoped, O.weekly_aggregate_prev_year_scoped),
    "weekly_reader_totals": (q_weekly_reader_totals, O.window_totals_by_group),
    "weekly_violations": (q_weekly_violations, O.weekly_violations),
    "extract_counts": (q_extract_counts, O.extract_counts),
    "published_cube": (q_published_cube, O.funnel_cube),
    "cube_document_lines": (q_cube_document_lines, O.cube_document_lines),
})
