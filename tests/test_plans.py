"""Physical-plan properties that the scale design relies on."""

import re
import tempfile

import pytest

from conftest import SF001
from funnelkit.operators.allocate import top_per_group
from funnelkit.plans.cube import web_cube
from funnelkit.plans.funnel import allocated_cube, funnel_cube
from funnelkit.plans.report import calibrate
from funnelkit.plans.trend import weekly_web_trend
from funnelkit.sources import fixtures as fx
from funnelkit.sources import read_events


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored_events(spark):
    """Reference-shaped events stored partitioned by event_date."""
    path = tempfile.mkdtemp(prefix="funnelkit-events-") + "/events"
    fx.web_events(spark, SF001).write.partitionBy("event_date").parquet(path)
    return read_events(spark, path)


def _scans(plan: str, needle: str) -> int:
    return sum(1 for line in plan.splitlines() if "FileScan" in line and needle in line)


def test_web_cube_scans_once_with_pruning(spark, stored_events):
    df = web_cube(stored_events, fx.cube_config())
    plan = _plan(df)
    assert _scans(plan, "events") == 1
    assert "PartitionFilters: [" in plan and "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "StringEndsWith(hostname" in plan  # host filter pushed to the reader
    assert plan.count("Exchange hashpartitioning") == 3
    assert "Join" not in plan


def test_trend_scans_once(spark, stored_events):
    cfg = fx.cube_config().with_(as_of=fx.cube_config().as_of, trend_weeks=3)
    plan = _plan(weekly_web_trend(stored_events, cfg))
    assert _scans(plan, "events") == 1
    assert "Join" not in plan


def test_calibration_prunes_to_fiscal_quarter(spark):
    tc = fx.trend_config()
    df = calibrate(fx.order_events(spark, SF001), fx.order_trials(spark, SF001), fx.order_paid(spark, SF001), tc)
    # the fiscal bounds arrive as scalar subqueries on the orders scan, run once
    orders_scans = [ln for ln in _plan(df).splitlines() if "FileScan" in ln and "orders" in ln and "o_orderdate" in ln]
    assert any("subquery" in ln.lower() for ln in orders_scans), orders_scans


def test_allocation_reads_cube_once_and_top_k_is_limited(spark):
    cfg = fx.cube_config()
    a = allocated_cube(fx.web_events(spark, SF001), fx.web_trials(spark, SF001), fx.web_paid(spark, SF001), cfg)
    plan = _plan(top_per_group(a, 25))
    assert "WindowGroupLimit" in plan
    assert "LeftAnti" not in plan
    expand = [ln for ln in plan.splitlines() if "Expand" in ln]
    assert len(expand) == 1  # one grouping-sets pass: the cube is computed once


def test_trend_grid_computes_the_series_once(spark):
    from funnelkit.plans.trend import trend
    tc = fx.trend_config()
    df = trend(fx.order_events(spark, SF001), fx.order_trials(spark, SF001), fx.order_paid(spark, SF001), tc)
    df.collect()
    final = _plan(df).split("== Initial Plan ==")[0]
    assert final.count("Expand [") == 1
    assert not [ln for ln in final.splitlines() if "Join [wk" in ln or "Join [k#" in ln]  # no lookup joins


def test_calibration_is_lazy_and_prunes_by_the_bounds(spark, tmp_path):
    from pyspark.sql import functions as F

    tc = fx.trend_config()
    path = str(tmp_path / "events")
    ev = fx.order_events(spark, SF001).withColumn("month", F.trunc("event_date", "month"))
    ev.repartition(4).write.partitionBy("month").parquet(path)
    stored = spark.read.parquet(path).drop("event_date").withColumnRenamed("month", "event_date")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "building the plan")
    df = calibrate(stored, fx.order_trials(spark, SF001), fx.order_paid(spark, SF001), tc)
    assert not list(tracker.getJobIdsForGroup("lazy"))
    spark.sparkContext.setJobGroup("run", "running it")
    assert df.count() == 4
    scans = [ln for ln in _plan(df).splitlines() if "PartitionFilters" in ln and "month" in ln]
    assert any("subquery" in ln.lower() for ln in scans), scans


def test_funnel_cube_sorts_no_period_in_one_task(spark):
    cfg = fx.cube_config()
    cube = funnel_cube(fx.web_events(spark, SF001), fx.web_trials(spark, SF001), fx.web_paid(spark, SF001), cfg)
    plan = _plan(cube)
    assert not re.search(r"hashpartitioning\(period#\d+, \d+\)", plan)
