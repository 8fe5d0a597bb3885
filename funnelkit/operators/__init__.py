"""Relational operators of the funnel (DataFrame -> DataFrame, no actions)."""
