import os
import sys
from datetime import date, datetime

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from funnelkit.config import FunnelConfig  # noqa: E402
from funnelkit.sources.tables import EVENT_SCHEMA  # noqa: E402

SF001 = "/root/testdata/sf0.01"
SITE = "site.example"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[4]").appName("funnelkit-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


def cfg(**kw) -> FunnelConfig:
    base = dict(as_of=date(2024, 1, 30), site_host=SITE, window_days=(7, 14), prior_shift_days=15,
                top_countries=("US", "CA"), country_bridge=(("US", "US"), ("CA", "CA"), ("ROW", "Other")),
                min_visits=1)
    base.update(kw)
    return FunnelConfig(**base)


_seq = [0]


def ev(user="u1", session="s1", ts=None, day=None, name="page_view", host=SITE, path="/", group="homepage",
       geo="US", device="desktop", gsn=2, source="google", medium="organic", uid=None, seq=None):
    """One event row in the reference shape; ``day`` (date) defaults from ts."""
    _seq[0] += 1
    if ts is not None and not isinstance(ts, datetime):
        ts = datetime(2024, 1, 20, 0, 0, int(ts))
    d = day or (ts.date() if ts else date(2024, 1, 20))
    return (seq if seq is not None else _seq[0], user, session, name, ts, d, uid, host, path, group, geo, device,
            gsn, source, medium)


def events_df(spark, rows):
    return spark.createDataFrame(rows, EVENT_SCHEMA)
