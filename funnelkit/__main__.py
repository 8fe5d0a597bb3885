"""Run the whole funnel build as a Spark application.

    spark-submit funnelkit/__main__.py \\
        --events warehouse.web_session_events --trials warehouse.free_trials_weekly \\
        --paid warehouse.bookings_weekly --site-host www.example.com --brand example \\
        --as-of 2026-05-02 --out s3://bucket/funnel/2026-05-02

Inputs are table names or parquet paths.  Writes the cube rows (partitioned
by period), the cube header, the trend document, the calibration report, the
period totals and the row counts as one publication under ``--out``; prints the
three reports.
"""

from __future__ import annotations

import argparse
import os
import sys
from datetime import date

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from funnelkit.config import COUNTRY_BRIDGE_HEADLINE, reference_config  # noqa: E402
from funnelkit.plans.job import run_build  # noqa: E402
from funnelkit.sources import read_events, read_weekly  # noqa: E402


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="funnelkit", description=__doc__.split("\n")[0])
    p.add_argument("--events", required=True)
    p.add_argument("--trials", required=True)
    p.add_argument("--paid", required=True)
    p.add_argument("--site-host", required=True)
    p.add_argument("--brand", default="brand")
    p.add_argument("--as-of", type=date.fromisoformat, default=date(2026, 5, 2))
    p.add_argument("--min-visits", type=int, default=5)
    p.add_argument("--scope-country", default="United States")
    p.add_argument("--fiscal-year", default="FY26")
    p.add_argument("--entry-rule", choices=("first_page", "first_event"), default="first_page")
    p.add_argument("--exclude-identified", action="store_true", help="count anonymous sessions only")
    p.add_argument("--raw-countries", action="store_true", help="keep every country by name")
    p.add_argument("--headline-bridge", action="store_true", help="the older bridge of country groups")
    p.add_argument("--all-cells", action="store_true", help="keep cells below --min-visits")
    p.add_argument("--out", required=True)
    p.add_argument("--cube-json", action="store_true", help="also write the cube as one JSON document")
    p.add_argument("--cube-lines", action="store_true", help="also write that document as ordered text parts")
    p.add_argument("--top-rows", type=int, help="keep this many rows per period, the largest by visits + trials + paid")
    return p.parse_args(argv)


def main(argv=None, spark: SparkSession | None = None) -> dict[str, str]:
    a = parse_args(argv)
    spark = spark or SparkSession.builder.appName("funnelkit").getOrCreate()
    cfg = reference_config(a.site_host, a.brand).with_(
        as_of=a.as_of, min_visits=a.min_visits, scope_country=a.scope_country, fiscal_year=a.fiscal_year)
    cfg = cfg.with_(entry_rule=a.entry_rule, exclude_identified=a.exclude_identified)
    if a.raw_countries:
        cfg = cfg.with_(top_countries=None)
    if a.headline_bridge:
        cfg = cfg.with_(country_bridge=COUNTRY_BRIDGE_HEADLINE)
    out = run_build(spark, read_events(spark, a.events), read_weekly(spark, a.trials),
                    read_weekly(spark, a.paid), cfg, a.out, cube_json=a.cube_json, suppress=not a.all_cells,
                    top_rows=a.top_rows, cube_lines=a.cube_lines)
    for name in ("row_counts", "calibration", "period_totals"):
        spark.read.parquet(out[name]).show(truncate=False)
    return out


if __name__ == "__main__":
    main()
