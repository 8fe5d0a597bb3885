"""P1 ``web_cube`` and P2 ``window_cube``: visits and activations per cell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DIMENSIONS, FunnelConfig, Window
from ..operators.cube import cube_cells, suppress_small
from ..operators.sessions import classify_sessions, filter_events, session_facts


def session_dimensions(events: DataFrame, cfg: FunnelConfig, ranges=None) -> DataFrame:
    """S1 -> F1/F3 -> A1-A4 -> C1-C7: one classified row per session key."""
    ev = filter_events(events, cfg, ranges or cfg.scan_ranges)
    return classify_sessions(session_facts(ev, cfg), cfg)


def web_cube(events: DataFrame, cfg: FunnelConfig, suppress: bool = True) -> DataFrame:
    """(period, 5 dims) -> visits, activations over every window at once.

    One scan of the events covers all windows; then one shuffle by session
    key, one by (user | cell) and one on the closed cell domain.
    """
    cells = cube_cells(session_dimensions(events, cfg), cfg)
    return suppress_small(cells, cfg.min_visits) if suppress else cells


def window_cube(events: DataFrame, start, end, cfg: FunnelConfig) -> DataFrame:
    """P2 (older form): one window, 5 dims, no period column, no suppression.

    Use with ``entry_rule="first_event"``, ``exclude_identified=True``,
    ``signup_defaults=SIGNUP_DEFAULTS_OLDER`` for the older behaviour.
    """
    w = [Window("window", start, end)]
    cells = cube_cells(session_dimensions(events, cfg, ranges=[(start, end)]), cfg, windows=w)
    return cells.select(*DIMENSIONS, F.col("visits"), F.col("activations"))
