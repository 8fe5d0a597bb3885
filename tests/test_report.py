"""P8 calibration scoring, P9 period totals, K1-K3 sinks, the whole build."""

import glob
import json
import tempfile

from conftest import cfg
from funnelkit.plans.report import period_totals, score_calibration
from funnelkit.sinks import cube_document, cube_header


def test_calibration_flags(spark):
    c = cfg(calibration_targets=(("visits", 100), ("activations", 100), ("trials", 100), ("paid", 0)))
    m = spark.createDataFrame([("visits", 111), ("activations", 89), ("trials", 110), ("paid", 5)],
                              "stage string, measured long")
    got = {r.stage: (r.delta_pct, r.flag) for r in score_calibration(m, c).collect()}
    assert got == {"visits": (11.0, "OVER"), "activations": (-11.0, "OVER"), "trials": (10.0, "OK"),
                   "paid": (0.0, "OK")}


def test_period_totals_zero_for_missing_periods(spark):
    c = cfg(scope_country="US")
    cube = spark.createDataFrame([("current_7d", "US", 3, 1, 2, 1), ("current_7d", "CA", 4, 0, 1, 0)],
                                 "period string, country string, visits long, activations long, trials long, "
                                 "paid long")
    got = {r.period: r for r in period_totals(cube, c).collect()}
    assert set(got) == {"current_7d", "prior_yr_7d", "current_14d", "prior_yr_14d"}
    r = got["current_7d"]
    assert (r.visits_global, r.visits_scoped, r.trials_global, r.trials_scoped) == (7, 3, 3, 2)
    assert got["prior_yr_14d"].paid_global == 0


def test_header_and_document(spark):
    c = cfg()
    h = cube_header(spark, c).collect()[0]
    assert h.as_of == "2024-01-30" and h.stages == ["visits", "activations", "trials", "paid"]
    assert h.windows["current_7d"].start == "2024-01-24"
    cube = spark.createDataFrame([("current_7d", "US", 1, 0, 0, 0)],
                                 "period string, country string, visits long, activations long, trials long, "
                                 "paid long")
    doc = cube_document(cube, c).collect()[0]
    assert len(doc.rows) == 1 and doc.rows[0].country == "US"


def test_run_build_writes_all_outputs(spark):
    from funnelkit.plans.job import run_build
    from funnelkit.sources import fixtures as fx
    sf = "/root/testdata/sf0.001"
    out_dir = tempfile.mkdtemp(prefix="funnelkit-build-")
    c = fx.cube_config()
    tc = fx.trend_config()
    out = run_build(spark, fx.web_events(spark, sf), fx.web_trials(spark, sf), fx.web_paid(spark, sf), c, out_dir)
    assert spark.read.parquet(out["cube"]).count() > 0
    trend = json.load(open(glob.glob(out["trend"] + "/*.json")[0]))
    assert len(trend["weeks"]) == c.trend_weeks
    assert set(trend["series_current"]) == {"visits", "activations", "trials", "paid"}
    assert spark.read.parquet(out["period_totals"]).count() == 4
    assert spark.read.parquet(out["calibration"]).count() == 4
    assert tc.trend_weeks == 44


def test_headline_bridge_keeps_belgium(spark):
    from funnelkit.config import COUNTRY_BRIDGE_HEADLINE
    from funnelkit.operators.totals import bridge_buckets
    df = spark.createDataFrame([("Belgium",), ("Nordics",), (None,), ("Atlantis",)], "country_group string")
    got = {r.country_group: r.country for r in bridge_buckets(df, cfg(country_bridge=COUNTRY_BRIDGE_HEADLINE))
           .collect()}
    assert got == {"Belgium": "Belgium", "Nordics": "Other", None: "Other", "Atlantis": "Other"}
    canonical = {r.country_group: r.country for r in bridge_buckets(df, cfg(country_bridge=(("Belgium", "Other"),)))
                 .collect()}
    assert canonical["Belgium"] == "Other"


def test_prior_year_window_holds_one_more_sunday_week(spark):
    """365-day shift: prior_yr_90d starts on a Sunday and holds 13 weekly
    rows, current_90d 12; both 30-day windows hold 4 (SURVEY 1.4)."""
    from datetime import date, timedelta

    from funnelkit.config import reference_config
    from funnelkit.operators.totals import aggregate_totals
    c = reference_config("site.example", "acme").with_(country_bridge=(("US", "US"),))
    sundays = [date(2025, 1, 5) + timedelta(weeks=i) for i in range(80)]
    weekly = "week date, country_group string, {m} long"
    tr = spark.createDataFrame([(d, "US", 1) for d in sundays], weekly.format(m="free_trial_users"))
    pd_ = spark.createDataFrame([(d, "US", 1) for d in sundays], weekly.format(m="total_bookings_users"))
    got = {r.period: (r.trials, r.paid) for r in aggregate_totals(tr, pd_, c).collect()}
    assert got == {"current_30d": (4, 4), "prior_yr_30d": (4, 4), "current_90d": (12, 12), "prior_yr_90d": (13, 13)}


def test_calibration_flag_uses_exact_delta(spark):
    c = cfg(calibration_targets=(("visits", 3000000),))
    m = spark.createDataFrame([("visits", 3300001)], "stage string, measured long")
    r = score_calibration(m, c).collect()[0]
    assert r.delta_pct == 10.000033 and r.flag == "OVER"
    m2 = spark.createDataFrame([("visits", 3300000)], "stage string, measured long")
    assert score_calibration(m2, c).collect()[0].flag == "OK"


def test_command_line_build(spark):
    """The spark-submit entry point over stored reference-shaped inputs."""
    from funnelkit.__main__ import main
    from funnelkit.sources import fixtures as fx
    sf = "/root/testdata/sf0.001"
    root = tempfile.mkdtemp(prefix="funnelkit-cli-")
    fx.web_events(spark, sf).write.partitionBy("event_date").parquet(root + "/events")
    fx.web_trials(spark, sf).write.parquet(root + "/trials")
    fx.web_paid(spark, sf).write.parquet(root + "/paid")
    out = main(["--events", root + "/events", "--trials", root + "/trials", "--paid", root + "/paid",
                "--site-host", "site.example", "--as-of", "2024-01-30", "--min-visits", "1",
                "--out", root + "/out", "--cube-json"], spark=spark)
    cube = spark.read.parquet(out["cube"])
    assert cube.count() > 0 and set(cube.columns) >= {"period", "country", "visits", "trials", "paid"}
    assert sorted(r.period for r in spark.read.parquet(out["period_totals"]).collect()) == [
        "current_30d", "current_90d", "prior_yr_30d", "prior_yr_90d"]
    doc = json.load(open(glob.glob(out["cube_document"] + "/*.json")[0]))
    assert doc["as_of"] == "2024-01-30" and len(doc["rows"]) == cube.count()
    assert set(doc["windows"]) == {"current_30d", "prior_yr_30d", "current_90d", "prior_yr_90d"}


def test_run_build_with_separate_trend_inputs_and_empty_cube(spark):
    from funnelkit.plans.job import run_build
    from funnelkit.sources import fixtures as fx
    sf = "/root/testdata/sf0.001"
    out_dir = tempfile.mkdtemp(prefix="funnelkit-build2-")
    trend_in = (fx.order_events(spark, sf), fx.order_trials(spark, sf), fx.order_paid(spark, sf))
    tc = fx.trend_config()
    out = run_build(spark, fx.web_events(spark, sf), fx.web_trials(spark, sf), fx.web_paid(spark, sf), tc, out_dir,
                    trend_inputs=trend_in)
    trend = json.load(open(glob.glob(out["trend"] + "/*.json")[0]))
    assert trend["weeks"][-1] == "2000-12-25" and sum(trend["series_current"]["visits"]) > 0
    cal = {r.stage: r.measured for r in spark.read.parquet(out["calibration"]).collect()}
    assert set(cal) == {"visits", "activations", "trials", "paid"} and cal["trials"] > 0
    # the cube config's windows hold no web events here: an empty cube is written and read back
    assert spark.read.parquet(out["period_totals"]).count() == 4


def test_funnel_cube_keeps_the_group_totals(spark):
    """Trials and paid of the cube's cells sum to the totals of every (period, country)."""
    from pyspark.sql import functions as F

    from funnelkit.operators.totals import aggregate_totals
    from funnelkit.plans.funnel import funnel_cube
    from funnelkit.sources import fixtures as fx
    sf, c = "/root/testdata/sf0.01", fx.cube_config()
    tr, pd_ = fx.web_trials(spark, sf), fx.web_paid(spark, sf)
    for suppress in (True, False):
        cube = funnel_cube(fx.web_events(spark, sf), tr, pd_, c, suppress)
        sums = cube.groupBy("period", "country").agg(F.sum("trials").alias("trials"), F.sum("paid").alias("paid"))
        got = {tuple(r) for r in sums.filter("trials > 0 or paid > 0").collect()}
        want = aggregate_totals(tr, pd_, c).select("period", "country", "trials", "paid")
        assert got == {tuple(r) for r in want.filter("trials > 0 or paid > 0").collect()}


def test_calibration_with_empty_fiscal_slice(spark):
    from funnelkit.plans.report import calibrate
    from funnelkit.sources import fixtures as fx
    sf = "/root/testdata/sf0.001"
    tc = fx.trend_config().with_(fiscal_year="FY1900")
    got = {r.stage: (r.measured, r.flag) for r in calibrate(
        fx.order_events(spark, sf), fx.order_trials(spark, sf), fx.order_paid(spark, sf), tc).collect()}
    assert got == {"visits": (0, "OVER"), "activations": (0, "OVER"), "trials": (0, "OVER"), "paid": (0, "OVER")}


def test_funnel_and_trend_without_events(spark):
    from pyspark.sql import functions as F

    from funnelkit.operators.totals import aggregate_totals
    from funnelkit.plans.funnel import funnel_cube
    from funnelkit.plans.trend import trend
    from funnelkit.sources import fixtures as fx
    sf = "/root/testdata/sf0.01"
    c = fx.cube_config()
    no_events = fx.web_events(spark, sf).limit(0)
    tr, pd_ = fx.web_trials(spark, sf), fx.web_paid(spark, sf)
    cube = funnel_cube(no_events, tr, pd_, c)
    totals = aggregate_totals(tr, pd_, c).filter((F.col("trials") > 0) | (F.col("paid") > 0))
    assert cube.count() == totals.count()  # one placeholder per (period, country) with totals
    assert cube.agg(F.sum("trials")).first()[0] == totals.agg(F.sum("trials")).first()[0]
    assert cube.agg(F.sum("visits")).first()[0] == 0
    grid = trend(fx.order_events(spark, sf).limit(0), fx.order_trials(spark, sf), fx.order_paid(spark, sf),
                 fx.trend_config()).collect()
    assert len(grid) == 44 and sum(r.visits for r in grid) == 0 and sum(r.trials for r in grid) > 0


def test_cube_sink_json_and_empty_document(spark):
    from funnelkit.sinks import cube_document, write_cube
    c = cfg()
    cube = spark.createDataFrame([("current_7d", "US", None, 1, 0, 0, 0)],
                                 "period string, country string, device string, visits long, activations long, "
                                 "trials long, paid long")
    path = tempfile.mkdtemp(prefix="funnelkit-json-") + "/cube"
    write_cube(cube, path, fmt="json")
    files = glob.glob(path + "/period=current_7d/*.json")
    row = json.loads(open(files[0]).readline())
    assert row["country"] == "US" and "device" in row and row["device"] is None  # null fields are kept
    empty = cube_document(cube.limit(0), c).collect()[0]
    assert empty.rows == [] and empty.as_of == "2024-01-30"
