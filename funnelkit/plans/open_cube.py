"""The funnel at an open grain: raw landing page, medium, entry day and country.

The cube's dimensions are closed label sets; here the cell key holds raw values,
so a (period, country) can have any number of cells.  Trials and paid are spread
by ``operators.apportion``, which no group size bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import FunnelConfig
from ..functions.dates import period_tags
from ..operators.apportion import allocate_open
from ..operators.sessions import is_visit, sessions
from ..operators.totals import aggregate_totals
from .cube import session_dimensions

OPEN_DIMS = ("landing_page", "medium", "entry_day", "device", "new_returning")
#: value of every open dimension of a placeholder row
AGGREGATE = "(aggregate)"


def open_cells(events: DataFrame, cfg: FunnelConfig) -> DataFrame:
    """(period, country, open dimensions) -> visits, and sessions with a sign-up
    as activations; one scan, one shuffle by session, one by cell."""
    rows = sessions(session_dimensions(events, cfg)).select(
        F.explode(period_tags("session_date", cfg.windows)).alias("period"),
        F.coalesce("entry.page_group", F.lit("(none)")).alias("landing_page"),
        F.coalesce("entry.traffic_source_medium", F.lit("(none)")).alias("medium"),
        F.col("session_date").cast("string").alias("entry_day"),
        "geo_country", "device", "new_returning",
        is_visit(F.col("is_acq") == 1, cfg).cast("long").alias("visit"), "signup_date")
    return rows.groupBy("period", "geo_country", *OPEN_DIMS).agg(
        F.sum("visit").alias("visits"), F.count("signup_date").alias("activations"))


def open_cube(events: DataFrame, trials: DataFrame, paid: DataFrame, cfg: FunnelConfig) -> DataFrame:
    """The open cells with all four measures, placeholders flagged, and the
    visits of their (period, country)."""
    return allocate_open(open_cells(events, cfg), aggregate_totals(trials, paid, cfg).withColumnRenamed("country", "geo_country"),
                         cfg, OPEN_DIMS, {d: AGGREGATE for d in OPEN_DIMS})
