"""Composite jobs (P1-P9): DataFrames + config in, lazy DataFrame out."""
