"""A hot key holding a third of all events: same result as the SQL twin and
as a one-partition run (partition-count invariance, SURVEY 5.2)."""

import tempfile
from datetime import date, datetime, timedelta

import duckdb
from pyspark.sql import functions as F

from conftest import SITE, cfg
from funnelkit import oracle as O
from funnelkit.plans.cube import web_cube
from funnelkit.plans.trend import weekly_web_trend
from funnelkit.sources.tables import EVENT_SCHEMA, read_events
from oracle_compare import _norm

GROUPS = ["homepage", "marketing_pricing_page", "solutions", "help_pages_y", "landing_pages", None]
MEDIUMS = ["cpc", "organic", None, "email", "qr"]


def _skewed_rows(n=9000):
    rows = []
    start = datetime(2024, 1, 1)
    for i in range(n):
        hot = i % 3 == 0  # a third of all events: one bot user, one session
        user = "bot" if hot else f"u{i % 97}"
        session = "s0" if hot else f"s{i % 11}"
        ts = start + timedelta(minutes=7 * i)
        rows.append((i, user, session, "sign_up" if i % 29 == 0 else "page_view", ts, ts.date(),
                     None, SITE if i % 13 else "app." + SITE, None if i % 5 == 0 else "/p",
                     GROUPS[i % len(GROUPS)], ["US", "CA", None][i % 3], ["mobile", "desktop"][i % 2],
                     i % 3 + 1, "google", MEDIUMS[i % len(MEDIUMS)]))
    return rows


def test_hot_key_cube_matches_sql_and_partitioning(spark):
    path = tempfile.mkdtemp(prefix="funnelkit-skew-") + "/events"
    spark.createDataFrame(_skewed_rows(), EVENT_SCHEMA).repartition(12).write.parquet(path)
    events = read_events(spark, path)
    c = cfg(min_visits=1, as_of=date(2024, 2, 12), window_days=(7, 30), prior_shift_days=14)

    many = web_cube(events, c)
    one = web_cube(events.coalesce(1), c)
    a = sorted(tuple(_norm(x) for x in r) for r in many.collect())
    b = sorted(tuple(_norm(x) for x in r) for r in one.collect())
    assert a == b and len(a) > 0

    con = duckdb.connect()
    steps = O.cube_steps(c, source=f"SELECT * FROM read_parquet('{path}/*.parquet')")
    sql = O.query([*steps, O.kept_cells(c)], "SELECT * FROM big_cell")
    rel = con.sql(sql)
    cols = rel.columns
    d = sorted(tuple(_norm(r[cols.index(k)]) for k in many.columns) for r in rel.fetchall())
    assert a == d
    # the hot user's first sign-up lands in exactly one cell per window containing it
    hot = many.filter(F.col("activations") > 0).count()
    assert hot > 0


def test_hot_key_trend_invariant(spark):
    path = tempfile.mkdtemp(prefix="funnelkit-skew-") + "/events"
    spark.createDataFrame(_skewed_rows(6000), EVENT_SCHEMA).repartition(9).write.parquet(path)
    events = read_events(spark, path)
    c = cfg(as_of=date(2024, 2, 12), trend_weeks=6, trend_shift_days=14)
    many = sorted(tuple(r) for r in weekly_web_trend(events, c).collect())
    one = sorted(tuple(r) for r in weekly_web_trend(events.coalesce(1), c).collect())
    assert many == one and len(many) > 0
