"""Weeks, shifts, zero fill, document shape."""

from datetime import date, timedelta

from conftest import SITE, cfg, ev, events_df
from funnelkit.config import reference_config
from funnelkit.functions.dates import monday_week, sunday_week
from funnelkit.plans.trend import (trend_arrays, trend_grid, weekly_aggregate_prev_year, weekly_aggregate_trend,
                                   weekly_web_trend)
from funnelkit.sources.tables import week_grid

WEEKLY = ("week date, country_group string, agg_key string, {m} long, {m}_prev_yr long, fy_text string, "
          "fw_number int")


def test_week_starts(spark):
    df = spark.createDataFrame([(date(2026, 5, 3),), (date(2026, 5, 4),), (date(2026, 4, 26),)], "d date")
    got = [(r.m, r.s) for r in df.select(monday_week(df.d).alias("m"), sunday_week(df.d).alias("s")).collect()]
    assert got == [(date(2026, 4, 27), date(2026, 5, 3)), (date(2026, 5, 4), date(2026, 5, 3)),
                   (date(2026, 4, 20), date(2026, 4, 26))]


def test_reference_calendar():
    c = reference_config("site.example", "acme")
    assert c.trend_start_week == date(2025, 6, 30) and c.trend_end_week == date(2026, 4, 27)
    assert c.trend_ranges == [(date(2024, 7, 1), date(2025, 5, 4)), (date(2025, 6, 30), date(2026, 5, 3))]
    assert [(w.period, w.start, w.end) for w in c.windows][2:] == [
        ("current_90d", date(2026, 2, 2), date(2026, 5, 2)), ("prior_yr_90d", date(2025, 2, 2), date(2025, 5, 2))]


def test_week_grid(spark):
    c = reference_config("site.example", "acme")
    rows = week_grid(spark, c).collect()
    assert len(rows) == 44 and rows[0].wk == date(2025, 6, 30) and rows[-1].wk == date(2026, 4, 27)
    assert all((b.wk - a.wk).days == 7 for a, b in zip(rows, rows[1:]))
    assert all((r.wk - r.prior_wk).days == 364 and r.prior_wk.weekday() == 0 for r in rows)


def _trend_cfg():
    return cfg(as_of=date(2026, 5, 9), trend_weeks=3)


def test_signups_on_sunday_and_monday(spark):
    rows = [ev(user="a", session="1", day=date(2026, 5, 3), name="sign_up", host="app." + SITE),
            ev(user="a", session="2", day=date(2026, 5, 4), name="sign_up", host="app." + SITE)]
    got = sorted((r.wk, r.activations) for r in weekly_web_trend(events_df(spark, rows), _trend_cfg()).collect())
    assert got == [(date(2026, 4, 27), 1), (date(2026, 5, 4), 1)]  # one user, counted in both weeks


def test_session_over_sunday_midnight_counts_twice(spark):
    rows = [ev(user="b", session="x", day=date(2026, 5, 3)), ev(user="b", session="x", day=date(2026, 5, 4))]
    got = sorted((r.wk, r.visits) for r in weekly_web_trend(events_df(spark, rows), _trend_cfg()).collect())
    assert got == [(date(2026, 4, 27), 1), (date(2026, 5, 4), 1)]


def test_scoped_trend(spark):
    rows = [ev(user="c", session="1", day=date(2026, 5, 5), geo="US"),
            ev(user="d", session="1", day=date(2026, 5, 5), geo="CA"),
            ev(user="d", session="2", day=date(2026, 5, 5), name="sign_up", geo="CA")]
    got = [(r.visits, r.activations) for r in weekly_web_trend(events_df(spark, rows), _trend_cfg(), "US").collect()]
    assert got == [(1, 0)]


def _weekly(spark, m, rows):
    return spark.createDataFrame([(w, g, "all", v, 0, "FY26", 1) for w, g, v in rows], WEEKLY.format(m=m))


def test_aggregate_week_shift(spark):
    c = _trend_cfg()
    tr = _weekly(spark, "free_trial_users", [(date(2026, 4, 26), "US", 5), (date(2026, 4, 26), None, 2)])
    pd_ = _weekly(spark, "total_bookings_users", [(date(2026, 5, 3), "US", 7)])
    got = sorted((r.wk, r.trials, r.paid) for r in weekly_aggregate_trend(tr, pd_, c).collect())
    assert got == [(date(2026, 4, 27), 7, 0), (date(2026, 5, 4), 0, 7)]
    scoped = sorted((r.wk, r.trials) for r in weekly_aggregate_trend(tr, pd_, c, "US").collect())
    assert scoped == [(date(2026, 4, 27), 5), (date(2026, 5, 4), 0)]
    prev = weekly_aggregate_prev_year(tr, pd_, date(2026, 4, 1), date(2026, 5, 31)).collect()
    assert sorted((r.wk, r.trials, r.paid) for r in prev) == [(date(2026, 4, 26), 7, 0), (date(2026, 5, 3), 0, 7)]


def test_grid_zero_fill_and_arrays(spark):
    c = _trend_cfg()
    web = spark.createDataFrame([(date(2026, 5, 4), 3, 1), (date(2025, 5, 5), 2, 0)],
                                "wk date, visits long, activations long")
    agg = spark.createDataFrame([(date(2026, 4, 27), 4, 1)], "wk date, trials long, paid long")
    g = trend_grid(web, agg, c).orderBy("wk").collect()
    assert [r.wk for r in g] == [date(2026, 4, 20), date(2026, 4, 27), date(2026, 5, 4)]
    assert [(r.visits, r.trials, r.visits_prior) for r in g] == [(0, 0, 0), (0, 4, 0), (3, 0, 2)]
    doc = trend_arrays(trend_grid(web, agg, c)).collect()[0]
    assert doc.weeks == ["2026-04-20", "2026-04-27", "2026-05-04"]
    assert doc.weeks_prior_year[-1] == (date(2026, 5, 4) - timedelta(days=364)).isoformat()
    lengths = {len(doc[k]) for k in doc.asDict()}
    assert lengths == {3} and doc.visits_current == [0, 0, 3] and doc.visits_prior == [0, 0, 2]


def test_series_come_ordered_by_week(spark):
    c = _trend_cfg()
    web = spark.createDataFrame([(date(2026, 5, 4), 3, 1), (date(2026, 4, 20), 2, 0), (date(2026, 4, 27), 1, 1)],
                                "wk date, visits long, activations long").repartition(3)
    agg = spark.createDataFrame([(date(2026, 4, 27), 4, 1)], "wk date, trials long, paid long")
    assert [r.wk for r in trend_grid(web, agg, c).collect()] == [date(2026, 4, 20), date(2026, 4, 27),
                                                                  date(2026, 5, 4)]


def test_trend_document_text(spark):
    import json

    from funnelkit.queries import q_trend_document
    doc = json.loads(q_trend_document(spark, "/root/testdata/sf0.001").collect()[0].document)
    assert list(doc) == ["weeks", "weeks_prior_year", "stages", "series_current", "series_prior"]
    assert len(doc["weeks"]) == 44 and doc["weeks"][-1] == "2000-12-25"
    for series in ("series_current", "series_prior"):
        assert list(doc[series]) == ["visits", "activations", "trials", "paid"]
        assert all(len(v) == 44 for v in doc[series].values())


def test_anonymous_rule_holds_in_the_trend(spark):
    """F8: with exclude_identified, sessions with a user id are no visits."""
    import funnelkit.sources.fixtures as fx
    from conftest import SF001
    from dataclasses import replace
    events, c = fx.order_events(spark, SF001), fx.trend_config()
    every = weekly_web_trend(events, c).agg({"visits": "sum"}).first()[0]
    anonymous = weekly_web_trend(events, replace(c, exclude_identified=True)).agg({"visits": "sum"}).first()[0]
    assert (every, anonymous) == (1571, 1340)
