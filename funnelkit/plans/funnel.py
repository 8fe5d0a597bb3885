"""P3 ``aggregate_totals`` + P4 ``funnel_cube``: the stitched four-stage cube."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import FunnelConfig
from ..operators.allocate import allocate
from ..operators.totals import aggregate_totals
from .cube import web_cube

CUBE_COLUMNS = ("period", "landing_family", "channel", "country", "device", "new_returning",
                "visits", "activations", "trials", "paid")


def allocated_cube(events: DataFrame, trials: DataFrame, paid: DataFrame, cfg: FunnelConfig,
                   suppress: bool = True) -> DataFrame:
    """Cube rows with all four measures, placeholders flagged."""
    return allocate(web_cube(events, cfg, suppress), aggregate_totals(trials, paid, cfg), cfg)


def funnel_cube(events: DataFrame, trials: DataFrame, paid: DataFrame, cfg: FunnelConfig,
                suppress: bool = True) -> DataFrame:
    """P4 end to end: cube -> allocation -> output columns, every cell;
    ``suppress=False`` keeps the small cells too (F10 off)."""
    cube = allocated_cube(events, trials, paid, cfg, suppress)
    return cube.select(*[F.col("geo_country").alias("country") if c == "country" else F.col(c)
                           for c in CUBE_COLUMNS])
