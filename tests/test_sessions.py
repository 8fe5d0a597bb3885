"""F1-F8, A1-A9, J5, J7, J1, F10 on literal frames (FIXTURES.md section 5)."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import SITE, cfg, ev, events_df
from funnelkit.config import SIGNUP_DEFAULTS_OLDER, Window
from funnelkit.operators.cube import tag_periods
from funnelkit.operators.sessions import (classify_sessions, filter_events, host_filter, session_facts, sessions,
                                          signup_users, user_attributes)
from funnelkit.plans.cube import session_dimensions, web_cube, window_cube


def _entries(spark, rows, **kw):
    c = cfg(**kw)
    facts = session_facts(filter_events(events_df(spark, rows), c, c.scan_ranges), c)
    return {(r.user_pseudo_id, r.session_id): (r.entry.page_group if r.entry else None)
            for r in sessions(facts).collect()}


def test_entry_skips_ambient_first_event(spark):
    rows = [ev(session="a", ts=1, path=None, group="g0"), ev(session="a", ts=2, path="/x", group="g1"),
            ev(session="a", ts=3, path="/y", group="g2")]
    assert _entries(spark, rows) == {("u1", "a"): "g1"}
    assert _entries(spark, rows, entry_rule="first_event") == {("u1", "a"): "g0"}


def test_entry_only_ambient_session_dropped(spark):
    assert _entries(spark, [ev(session="b", ts=4, path=None, group="g9")]) == {}


def test_entry_null_timestamp_first(spark):
    rows = [ev(session="c", ts=None, path="/z", group="gn"), ev(session="c", ts=1, path="/w", group="gw")]
    assert _entries(spark, rows) == {("u1", "c"): "gn"}


def test_entry_null_group_kept(spark):
    rows = [ev(session="d", ts=7, path="/q", group=None)]
    assert _entries(spark, rows) == {("u1", "d"): None}
    c = cfg()
    dims = session_dimensions(events_df(spark, rows), c).collect()
    assert dims[0].landing_family == "Other" and dims[0].is_acq == 0


def test_entry_tie_broken_by_sequence(spark):
    rows = [ev(session="e", ts=5, group="late", seq=20), ev(session="e", ts=5, group="early", seq=10)]
    assert _entries(spark, rows) == {("u1", "e"): "early"}


def test_host_filter_suffix_without_dot(spark):
    c = cfg()
    rows = [ev(host=SITE), ev(host="app." + SITE, name="sign_up"), ev(host="x" + SITE, name="sign_up"),
            ev(host="app." + SITE), ev(host="other.example", name="sign_up")]
    kept = events_df(spark, rows).filter(host_filter(c)).count()
    assert kept == 3


def test_window_tags(spark):
    c = cfg()
    df = spark.createDataFrame([(date(2024, 1, 25),), (date(2024, 1, 18),), (date(2024, 1, 16),)], "d date")
    got = {}
    for r in tag_periods(df, "d", c.windows).collect():
        got.setdefault(r.d.isoformat(), set()).add(r.period)
    assert got == {"2024-01-25": {"current_7d", "current_14d"}, "2024-01-18": {"current_14d"}}


def test_window_calendar():
    c = cfg()
    assert [(w.period, w.start.isoformat(), w.end.isoformat()) for w in c.windows] == [
        ("current_7d", "2024-01-24", "2024-01-30"), ("prior_yr_7d", "2024-01-09", "2024-01-15"),
        ("current_14d", "2024-01-17", "2024-01-30"), ("prior_yr_14d", "2024-01-02", "2024-01-15")]
    assert c.scan_ranges == [(date(2024, 1, 2), date(2024, 1, 15)), (date(2024, 1, 17), date(2024, 1, 30))]


def test_first_signup_over_both_ranges(spark):
    rows = [ev(user="s", session="x", day=date(2024, 1, 5), name="sign_up"),
            ev(user="s", session="y", day=date(2024, 1, 26), name="sign_up")]
    c = cfg()
    cube = web_cube(events_df(spark, rows), c, suppress=False).collect()
    assert {(r.period, r.visits, r.activations) for r in cube} == {
        ("prior_yr_14d", 1, 1), ("current_7d", 1, 0), ("current_14d", 1, 0)}
    # sessions exist, so the user takes their first session's dimensions
    assert {r.landing_family for r in cube} == {"Homepage"}


def test_signup_without_session_gets_defaults(spark):
    rows = [ev(user="n", session="z", day=date(2024, 1, 26), name="sign_up", host="app." + SITE, geo="US")]
    cube = web_cube(events_df(spark, rows), cfg(), suppress=False).collect()
    assert {(r.period, r.landing_family, r.channel, r.geo_country, r.device, r.new_returning, r.visits,
             r.activations) for r in cube} == {
        ("current_7d", "Direct to Signup", "Direct", "Other", "desktop", "new", 0, 1),
        ("current_14d", "Direct to Signup", "Direct", "Other", "desktop", "new", 0, 1)}


def test_null_user_signup_counts_zero(spark):
    rows = [ev(user=None, session="z", day=date(2024, 1, 26), name="sign_up", host="app." + SITE)]
    c = cfg()
    raw = web_cube(events_df(spark, rows), c, suppress=False).collect()
    assert {r.activations for r in raw} == {0}
    assert web_cube(events_df(spark, rows), c).count() == 0  # dropped by the small-cell rule


def test_cube_visits_and_suppression(spark):
    rows = [ev(user=f"v{i}", session="s", day=date(2024, 1, 25), medium="organic") for i in range(3)]
    rows.append(ev(user="w", session="s", day=date(2024, 1, 25), group="help_pages_y"))  # not acquisition
    c = cfg(min_visits=3)
    cube = {(r.period, r.landing_family, r.channel, r.visits) for r in web_cube(events_df(spark, rows), c).collect()}
    assert cube == {("current_7d", "Homepage", "Organic Search", 3), ("current_14d", "Homepage", "Organic Search", 3)}
    assert web_cube(events_df(spark, rows), cfg(min_visits=4)).count() == 0


def test_is_new_from_any_event(spark):
    rows = [ev(session="n", ts=1, gsn=3), ev(session="n", ts=2, gsn=1, path=None)]
    dims = session_dimensions(events_df(spark, rows), cfg()).collect()
    assert dims[0].new_returning == "new"


def test_older_rules_exclude_identified_and_defaults(spark):
    rows = [ev(user="a", session="1", day=date(2024, 1, 12), uid="known"),
            ev(user="b", session="1", day=date(2024, 1, 12)),
            ev(user="c", session="1", day=date(2024, 1, 12), name="sign_up", host="app." + SITE)]
    c = cfg(entry_rule="first_event", exclude_identified=True, signup_defaults=SIGNUP_DEFAULTS_OLDER,
            top_countries=None)
    out = window_cube(events_df(spark, rows), date(2024, 1, 10), date(2024, 1, 14), c).collect()
    assert sum(r.visits for r in out) == 1  # the identified session is not a visit
    assert {(r.landing_family, r.activations) for r in out if r.activations} == {("Other", 1)}
    assert Window("w", date(2024, 1, 1), date(2024, 1, 2)).period == "w"


def test_signup_users_attributes_from_earliest_entry(spark):
    """The chosen session is the one whose entry event is earliest."""
    rows = [ev(user="u", session="2", ts=datetime(2024, 1, 20, 9), group="marketing_pricing_page"),
            ev(user="u", session="1", ts=datetime(2024, 1, 20, 8), group="homepage"),
            ev(user="u", session="3", ts=datetime(2024, 1, 22, 7), name="sign_up")]
    c = cfg()
    users = signup_users(classify_sessions(session_facts(events_df(spark, rows), c), c), c).collect()
    assert [(u.landing_family, u.signup_date) for u in users] == [("Homepage", date(2024, 1, 22))]
    # same choice through the struct form (an open country domain)
    c2 = cfg(top_countries=None)
    users2 = signup_users(classify_sessions(session_facts(events_df(spark, rows), c2), c2), c2).collect()
    assert [u.landing_family for u in users2] == ["Homepage"]


def test_pick_ties_without_sequence_are_deterministic(spark):
    t = datetime(2024, 1, 20, 8)
    rows = [ev(user="u", session="a", ts=t, group="marketing_pricing_page"),
            ev(user="u", session="b", ts=t, group="homepage"),
            ev(user="u", session="c", ts=datetime(2024, 1, 21), name="sign_up")]
    rows = [(None,) + r[1:] for r in rows]  # no event_seq
    c = cfg()
    for parts in (1, 3):
        df = events_df(spark, rows).repartition(parts)
        users = signup_users(classify_sessions(session_facts(df, c), c), c).collect()
        # equal timestamps: the smaller packed dimensions win (Homepage precedes Pricing)
        assert [u.landing_family for u in users] == ["Homepage"]


@pytest.mark.parametrize("seed", range(3))
def test_pick_is_the_same_for_closed_and_open_countries(spark, seed):
    """Ties on the timestamp, some without a sequence; the families' list
    order (Homepage first) is not the alphabetical one."""
    rng = random.Random(seed)
    groups = ("homepage", "solutions_pages_email_marketing", "marketing_pricing_page", "sales", None)
    rows = []
    for u in range(60):
        for s in range(4):
            row = ev(user=f"u{u}", session=str(s), ts=datetime(2024, 1, 20, 8, 0, rng.randrange(2)),
                     group=rng.choice(groups), device=rng.choice(("mobile", "desktop", "tablet")),
                     medium=rng.choice(("cpc", "email", "organic")), geo=rng.choice(("US", "CA")))
            rows.append(row if rng.random() < 0.5 else (None,) + row[1:])
    df = events_df(spark, rows)
    picked = []
    for c in (cfg(), cfg(top_countries=None)):
        users = user_attributes(classify_sessions(session_facts(df, c), c), c)
        picked.append(sorted(tuple(r) for r in users.collect()))
    assert picked[0] == picked[1] and len(picked[0]) == 60


def test_pick_goes_by_the_alphabet_without_a_sequence(spark):
    t = datetime(2024, 1, 20, 8)
    rows = [(None,) + ev(user="u", session=s, ts=t, group=g)[1:]
            for s, g in (("a", "homepage"), ("b", "solutions_pages_email_marketing"))]
    for c in (cfg(), cfg(top_countries=None)):
        users = user_attributes(classify_sessions(session_facts(events_df(spark, rows), c), c), c).collect()
        assert [u.landing_family for u in users] == ["Email Marketing solution"]


def test_order_key_is_exact(spark):
    from pyspark.sql import types as T

    from funnelkit.operators.sessions import order_key_sql
    vals = [(datetime(1969, 12, 31, 23, 59, 59), 5), (datetime(2024, 1, 1), 9223372036854775807),
            (datetime(2024, 1, 1, 0, 0, 0, 1), 0), (None, 3), (datetime(2024, 1, 1), None)]
    df = spark.createDataFrame(vals, "ts timestamp_ntz, seq long")
    key = F.expr(order_key_sql("ts", "seq", T.TimestampNTZType(), "0", 1))
    got = [(r.ts, r.seq) for r in df.orderBy(key).collect()]
    assert got == [(None, 3), (datetime(1969, 12, 31, 23, 59, 59), 5), (datetime(2024, 1, 1), None),
                   (datetime(2024, 1, 1), 9223372036854775807), (datetime(2024, 1, 1, 0, 0, 0, 1), 0)]


def test_shorter_window_never_exceeds_longer_before_suppression(spark):
    """Windows nest (7d inside 14d), so before F10 every 7-day sum is at most
    the 14-day sum of the same year (SURVEY 5.2)."""
    from funnelkit.sources import fixtures as fx
    c = fx.cube_config()
    cube = web_cube(fx.web_events(spark, "/root/testdata/sf0.01"), c, suppress=False)
    sums = {r.period: (r.v, r.a) for r in cube.groupBy("period").agg(F.sum("visits").alias("v"),
                                                                      F.sum("activations").alias("a")).collect()}
    for short, long in (("current_7d", "current_14d"), ("prior_yr_7d", "prior_yr_14d")):
        assert sums[short][0] <= sums[long][0] and sums[short][1] <= sums[long][1]
    assert sums["current_14d"][0] > 0


def test_integer_microsecond_timestamps(spark):
    """event_timestamp as BIGINT micros gives the same cube as TIMESTAMP_NTZ."""
    from funnelkit.sources import fixtures as fx
    c = fx.cube_config()
    ev_ts = fx.web_events(spark, "/root/testdata/sf0.001")
    ev_long = ev_ts.withColumn(
        "event_timestamp",
        F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', event_timestamp)"))
    assert dict(ev_long.dtypes)["event_timestamp"] == "bigint"
    a = sorted(tuple(r) for r in web_cube(ev_ts, c, suppress=False).collect())
    b = sorted(tuple(r) for r in web_cube(ev_long, c, suppress=False).collect())
    assert a == b and len(a) > 0


def test_dimension_labels_cover_every_classified_value(spark):
    """The packed pick needs every classified value in its label list."""
    from funnelkit.sources import fixtures as fx
    for c in (fx.cube_config(), fx.cube_config().with_(extended_families=True), cfg()):
        labels = c.dimension_labels()
        dims = session_dimensions(fx.web_events(spark, "/root/testdata/sf0.01"), c).filter(F.col("entry").isNotNull())
        for d, allowed in labels.items():
            seen = {r[0] for r in dims.select(d).distinct().collect()}
            assert seen <= set(allowed), (d, seen - set(allowed))


def test_unlisted_label_fails_loudly(spark):
    import pytest
    from pyspark.errors import PySparkException

    from funnelkit.operators.sessions import picked_attrs, session_pick
    c = cfg()
    rows = [ev(user="u", session="1", ts=1, group="homepage")]
    dims = session_dimensions(events_df(spark, rows), c).withColumn("channel", F.lit("Carrier Pigeon"))
    with pytest.raises(PySparkException):
        dims.groupBy("user_pseudo_id").agg(session_pick(dims, c).alias("p")).select(picked_attrs("p", c)).collect()
