"""First-match-wins rule tables, NULL handling, rule order."""

import pytest
from pyspark.sql import functions as F

from funnelkit.config import (CHANNEL_DEFAULT, CHANNEL_RULES, DEVICE_DEFAULT, DEVICE_RULES, LANDING_FAMILY_DEFAULT,
                              LANDING_FAMILY_EXTENSION, LANDING_FAMILY_RULES, FunnelConfig)
from funnelkit.functions import rules as R


def _eval(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


@pytest.mark.parametrize("medium,source,expected", [
    ("organic", "(direct)", "Organic Search"),   # medium rules come before the source test
    (None, "x", "Direct"),                        # NULL medium is Direct
    ("qr", "(direct)", "Direct"),                 # unknown medium, direct source
    ("qr", "x", "Display / Other"),
    ("CPC", None, "Paid Search"),                 # lower-cased
    ("", None, "Direct"),
    ("(none)", "google", "Direct"),
    ("banner", "(direct)", "Display / Other"),
    ("Email", None, "Email"),
    ("podcast", None, "Display / Other"),
])
def test_channel(spark, medium, source, expected):
    e = R.channel("m", "s", CHANNEL_RULES, CHANNEL_DEFAULT)
    assert _eval(spark, e, [(medium, source)], "m string, s string") == [expected]


@pytest.mark.parametrize("group,expected", [
    ("featuresXpagesYz", "Other Feature pages"),   # '_' is a one-character wildcard
    ("features_pages_analytics", "Other Feature pages"),
    ("help_pages_y", "Knowledge Base / Help"),
    ("integrations_pages", "Integrations"),
    ("integrations_pagesX", "Integrations"),
    ("personalize", "Other Solutions"),
    ("landing_pages", "Paid Landing Pages"),
    ("signup_start_page", "Direct to Signup"),
    ("other_switch_to_acme", "Switch-to / Compete"),
    ("acme_presents", "SEO Resources"),
    ("my_analytics_z", "Other"),
    (None, "Other"),
])
def test_landing_family(spark, group, expected):
    fams = FunnelConfig(as_of=None, site_host="x", brand="acme").families
    e = R.landing_family("g", fams, LANDING_FAMILY_DEFAULT)
    assert _eval(spark, e, [(group,)], "g string") == [expected]


@pytest.mark.parametrize("group,expected", [
    ("features_pages_analytics", "Other Feature pages"),  # extension is placed last
    ("my_analytics_z", "Reporting & Analytics"),
    ("monthly_report_analytic", "Reporting & Analytics"),
])
def test_landing_family_extended(spark, group, expected):
    e = R.landing_family("g", LANDING_FAMILY_RULES + LANDING_FAMILY_EXTENSION, LANDING_FAMILY_DEFAULT)
    assert _eval(spark, e, [(group,)], "g string") == [expected]


@pytest.mark.parametrize("device,expected", [("Mobile", "mobile"), ("smart tv", "desktop"), (None, "desktop"),
                                             ("TABLET", "tablet"), ("desktop", "desktop")])
def test_device(spark, device, expected):
    e = R.device("d", DEVICE_RULES, DEVICE_DEFAULT)
    assert _eval(spark, e, [(device,)], "d string") == [expected]


@pytest.mark.parametrize("geo,top,expected", [("US", ("US",), "US"), ("FR", ("US",), "Other"),
                                              (None, ("US",), "Other"), (None, None, "Other"), ("FR", None, "FR")])
def test_country(spark, geo, top, expected):
    assert _eval(spark, R.country("g", top), [(geo,)], "g string") == [expected]


def test_new_returning(spark):
    assert _eval(spark, R.new_returning("n"), [(1,), (0,)], "n int") == ["new", "returning"]


def test_sql_rendering_matches_rules():
    sql = R.channel_sql("m", "s", CHANNEL_RULES, CHANNEL_DEFAULT)
    assert sql.startswith("CASE WHEN LOWER(m) IN ('cpc'")
    assert "LOWER(m) IS NULL" in sql and sql.endswith("ELSE 'Display / Other' END")
    assert F is not None


def test_quotes_and_empty_lists(spark):
    """Values with apostrophes and backslashes are data; nothing is in an empty list."""
    from datetime import date

    from funnelkit.config import Window
    from funnelkit.functions.dates import period_tags
    odd = "Cote d'Ivoire \\ n"
    df = spark.createDataFrame([(odd, date(2024, 1, 1)), ("US", date(2024, 1, 1)), (None, date(2024, 1, 9))],
                               "c string, d date")
    one = df.select(R.country("c", (odd,)).alias("v")).collect()
    assert [r.v for r in one] == [odd, "Other", "Other"]
    assert {r.v for r in df.select(R.country("c", ()).alias("v")).collect()} == {"Other"}
    assert {r.v for r in df.select(R.in_list("c", ()).alias("v")).collect()} == {False}
    assert R.classify_sql((), "it's", {}) == "'it\\'s'"
    tags = df.select(period_tags("d", [Window("last year's", date(2024, 1, 1), date(2024, 1, 2))]).alias("t")).collect()
    assert [r.t for r in tags] == [["last year's"], ["last year's"], []]


def test_default_with_an_apostrophe(spark):
    from conftest import cfg, ev, events_df
    from funnelkit.config import SIGNUP_DEFAULTS
    from funnelkit.operators.sessions import classify_sessions, session_facts, signup_users
    c = cfg(signup_defaults=tuple((k, "Editor's pick" if k == "landing_family" else v) for k, v in SIGNUP_DEFAULTS))
    rows = [ev(user="u", name="sign_up", host="app.site.example")]
    users = signup_users(classify_sessions(session_facts(events_df(spark, rows), c), c), c).collect()
    assert [u.landing_family for u in users] == ["Editor's pick"]
