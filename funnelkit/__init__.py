"""funnelkit: a Spark-native web acquisition funnel engine.

Main entry points (all return lazy DataFrames except ``run_build``)::

    from funnelkit import (FunnelConfig, reference_config, read_events, read_weekly, web_cube,
                           funnel_cube, trend, trend_arrays, calibrate, period_totals, run_build)
"""

from .config import FunnelConfig, Window, reference_config
from .plans.cube import web_cube, window_cube
from .plans.funnel import allocated_cube, funnel_cube
from .plans.job import run_build
from .plans.report import calibrate, period_totals
from .plans.trend import trend, trend_arrays, trend_grid, weekly_aggregate_trend, weekly_web_trend
from .sources import read_events, read_weekly

__all__ = [
    "FunnelConfig", "Window", "reference_config", "read_events", "read_weekly", "web_cube", "window_cube",
    "allocated_cube", "funnel_cube", "trend", "trend_arrays", "trend_grid", "weekly_web_trend",
    "weekly_aggregate_trend", "calibrate", "period_totals", "run_build",
]
__version__ = "0.1.0"
