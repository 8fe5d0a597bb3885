"""Column-level building blocks (pure expressions, no actions)."""

from .dates import in_ranges, monday_week, period_tags, sunday_week
from .rules import (channel, channel_sql, classify_sql, country, country_sql, device, device_sql, in_list,
                    in_list_sql, landing_family, landing_family_sql, new_returning, new_returning_sql, sql_list)

__all__ = [
    "channel", "channel_sql", "classify_sql", "country", "country_sql", "device", "device_sql",
    "in_list", "in_list_sql", "landing_family", "landing_family_sql", "new_returning", "new_returning_sql",
    "sql_list", "in_ranges", "monday_week", "period_tags", "sunday_week",
]
