"""Sources: readers for session events and weekly aggregates, literal tables."""

from .checks import checked_weekly, weekly_violations
from .tables import (EVENT_COLUMNS, EVENT_SCHEMA, bridge_df, read_events, read_weekly, targets_df,
                     week_grid, windows_df)

__all__ = ["EVENT_COLUMNS", "EVENT_SCHEMA", "bridge_df", "read_events", "read_weekly", "targets_df",
           "week_grid", "windows_df", "checked_weekly", "weekly_violations"]
