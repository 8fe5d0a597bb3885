"""Operators without a window over a whole group: ranking, top-k at any n,
apportionment on open domains, window tables, bitmaps."""

import random
import re
from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF001, cfg
from funnelkit.operators.allocate import allocate, top_per_group
from funnelkit.operators.apportion import allocate_open
from funnelkit.operators.bitmaps import daily_bitmaps, user_numbers, users_by_window
from funnelkit.operators.ranking import numbered, salted_join, top_per_group_exact
from funnelkit.operators.windows import rolling_windows, sums_by_window, tag_window_table
from funnelkit.queries import QUERIES

CELLS = ("period string, landing_family string, channel string, geo_country string, device string, new_returning string, "
         "visits long, activations long")
ORDER = ("landing_family", "channel", "device", "new_returning")
TOTALS = "period string, country string, trials long, paid long"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _windows_over_rows(df) -> list[str]:
    """Window nodes whose partitioning is not that of the small base tables."""
    lines = [ln for ln in _plan(df).split("== Initial Plan ==")[0].splitlines() if re.search(r"\bWindow(GroupLimit)? \[", ln)]
    return [ln for ln in lines if "__part" not in ln and "__bucket" not in ln and "__sum_" not in ln]


# -- places -----------------------------------------------------------------------


def test_places_follow_the_order_over_many_partitions(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot"] * 8 + ["a", None]), rng.randrange(50), k) for k in range(2000)]
    df = spark.createDataFrame(rows, "g string, v int, k int").repartition(7)
    found = numbered(df, ["g"], [F.col("v").desc(), F.col("k").asc()], "places", sums={"total": "v"}).collect()
    for g in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        got = sorted((r for r in found if r["g"] == g), key=lambda r: r["place"])
        assert [(r["v"], r["k"], r["place"]) for r in got] == [(v, k, i) for i, (_, v, k) in enumerate(mine)]
        assert {r["total"] for r in got} == {sum(r[1] for r in mine)}
    assert numbered(df.limit(0), ["g"], [F.col("v").asc()], "none").count() == 0


def test_equal_rows_get_distinct_places_in_several_tasks(spark):
    df = spark.range(40_000).select(F.lit("x").alias("g"), F.lit(1).alias("v"))
    found = numbered(df, ["g"], [F.col("v").asc()], "equal")
    assert found.select("place").distinct().count() == 40_000
    assert found.agg(F.max("place")).first()[0] == 39_999


def test_salted_join_keeps_every_row(spark):
    rows = spark.range(500).select(F.when(F.col("id") < 400, "hot").otherwise("cold").alias("g"), "id")
    groups = spark.createDataFrame([("hot", 1), ("cold", 2)], "g string, n int")
    assert salted_join(rows, groups, ["g"]).groupBy("n").count().collect() == [(1, 400), (2, 100)] or \
        {r["n"]: r["count"] for r in salted_join(rows, groups, ["g"]).groupBy("n").count().collect()} == {1: 400, 2: 100}
    assert salted_join(rows, groups.filter("n = 1"), ["g"], how="left").filter("n IS NULL").count() == 100


# -- top k --------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 7, 60, 400])
def test_top_rows_match_the_window_form(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice(["p", "p", "p", "q"]), f"f{k:03d}", "c", "US", "d", "new", rng.choice([0, 1, 1, 1, 5, 70_000, 2 ** 40 + k]), 0)
            for k in range(300)]
    df = spark.createDataFrame(rows, CELLS).withColumns({"trials": F.lit(0).cast("long"), "paid": F.lit(0).cast("long"),
                                                          "is_placeholder": F.lit(False)}).repartition(5)
    exact = top_per_group_exact(df, n, F.col("visits") + F.col("trials") + F.col("paid"), ("period",), (*ORDER, "geo_country"))
    assert sorted(map(tuple, exact.collect())) == sorted(map(tuple, top_per_group(df, n).collect()))


def test_scores_of_either_sign_and_ties_are_cut_exactly(spark):
    df = spark.range(3000).select(F.lit("p").alias("period"), "id", ((F.col("id") % 5 - 2) * 10 ** 9).alias("s"))
    found = top_per_group_exact(df, 700, F.col("s"), ("period",), ("id",))
    assert [r["id"] for r in found.orderBy("id").collect()] == sorted([5 * k + 4 for k in range(600)] + [5 * k + 3 for k in range(100)])
    assert not _windows_over_rows(found)
    assert top_per_group_exact(df.limit(0), 5, F.col("s"), ("period",), ("id",)).count() == 0


def test_cube_cap_bites_and_no_window_sorts_a_period(spark):
    capped = QUERIES["cube_top_30000"][0](spark, SF001)
    counts = {r["period"]: r["count"] for r in capped.groupBy("period").count().collect()}
    assert counts["current"] == 30000 and 0 < counts["prior"] < 30000
    assert not _windows_over_rows(capped)


# -- apportionment --------------------------------------------------------------------


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.data())
def test_open_form_equals_the_closed_one(spark, data):
    countries = ["US", "CA", "Other"]
    cells = data.draw(st.lists(st.tuples(st.sampled_from("abcde"), st.sampled_from("xyz"), st.sampled_from(countries),
                                         st.integers(0, 6), st.integers(0, 3)), max_size=14, unique_by=lambda c: c[:3]))
    totals = data.draw(st.lists(st.tuples(st.sampled_from(countries), st.integers(-3, 40), st.integers(-3, 40)), max_size=3,
                                unique_by=lambda t: t[0]))
    left = spark.createDataFrame([("p", f, c, g, "desktop", "new", v, a) for f, c, g, v, a in cells], CELLS)
    right = spark.createDataFrame([("p", *t) for t in totals], TOTALS)
    want = allocate(left, right, cfg())
    got = allocate_open(left, right.withColumnRenamed("country", "geo_country"), cfg(), ORDER)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_even_split_over_a_million_rows(spark):
    n, trials = 1_000_000, 2_500_007
    cells = spark.range(n).select(
        F.lit("p").alias("period"), F.format_string("page %07d", "id").alias("landing_family"), F.lit("c").alias("channel"),
        F.lit("US").alias("geo_country"), F.lit("d").alias("device"), F.lit("new").alias("new_returning"),
        F.lit(0).cast("long").alias("visits"), F.lit(1).cast("long").alias("activations"))
    totals = spark.createDataFrame([("p", "US", trials, 3)], "period string, geo_country string, trials long, paid long")
    out = allocate_open(cells, totals, cfg(), ORDER)
    assert not _windows_over_rows(out)
    r = out.agg(F.sum("trials"), F.min("trials"), F.max("trials"), F.sum("paid"), F.max("paid"), F.count(F.lit(1)),
                F.max(F.when(F.col("paid") > 0, F.col("landing_family")))).first()
    # the placeholder is the last of n + 1 rows; three paid go to the first three pages
    assert tuple(r) == (trials, 2, 3, 3, 1, n + 1, "page 0000002")


def test_a_group_with_most_cells_keeps_its_total(spark):
    rng = random.Random(1)
    rows = [("p", f"page {k}", "c", "US" if k % 3 else f"X{k % 40}", "d", "new", rng.choice([1, 1, 1, 2, 9]), 0) for k in range(6000)]
    totals = [("p", "US", 12_345, 17)] + [("p", f"X{k}", 100 + k, 0) for k in range(45)]
    left = spark.createDataFrame(rows, CELLS).repartition(9)
    out = allocate_open(left, spark.createDataFrame(totals, "period string, geo_country string, trials long, paid long"), cfg(), ORDER)
    sums = {r["geo_country"]: (r["t"], r["p"]) for r in out.groupBy("geo_country").agg(F.sum("trials").alias("t"), F.sum("paid").alias("p")).collect()}
    assert sums == {g: (t, p) for _, g, t, p in totals}
    assert out.filter("is_placeholder").count() == len({g for _, g, _, _ in totals} - {r[3] for r in rows})
    want = allocate(left, spark.createDataFrame(totals, TOTALS), cfg())
    assert out.select(*want.columns).exceptAll(want).count() == 0


def test_repeated_cells_stay_apart(spark):
    rows = [("p", "a", "c", "US", "d", "new", 1, 0)] * 3
    out = allocate_open(spark.createDataFrame(rows, CELLS), spark.createDataFrame(
        [("p", "US", 4, 1)], "period string, geo_country string, trials long, paid long"), cfg(), ORDER)
    assert sorted((r["trials"], r["paid"]) for r in out.collect()) == [(1, 0), (1, 0), (2, 1)]


# -- window tables and bitmaps ----------------------------------------------------------


def _days(spark, n=4000):
    rng = random.Random(6)
    rows = [(date(2024, 1, 1) + timedelta(days=0 if k % 3 == 0 else rng.randrange(-400, 400)), f"u{rng.randrange(60)}") for k in range(n)]
    return rows + [(None, "u1"), (date(2024, 1, 1), None)]


@pytest.mark.parametrize("bins", [1, 28, 1000])
def test_window_table_matches_a_nested_loop(spark, bins):
    rows = _days(spark)
    rng = random.Random(7)
    spans = [(f"w{k}", s, s + timedelta(days=rng.choice([0, 1, 6, 89, 364]))) for k in range(1100)
             for s in [date(2023, 1, 1) + timedelta(days=rng.randrange(700))]] + [
        ("reversed", date(2024, 2, 1), date(2024, 1, 1)), ("open", None, date(2024, 1, 1))]
    df = spark.createDataFrame(rows, "day date, u string")
    table = spark.createDataFrame(spans, "period string, start date, end date")
    sums = sums_by_window(df, "day", table, (), {"n": F.lit(1)}, bin_days=bins)
    want = {p: sum(s <= d <= e for d, _ in rows if d) for p, s, e in spans if s}
    assert {r["period"]: r["n"] for r in sums.collect()} == {p: n for p, n in want.items() if n}
    plan = _plan(sums)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert tag_window_table(df.limit(0), "day", table).count() == 0 and tag_window_table(df, "day", table.limit(0)).count() == 0


def test_bitmaps_count_distinct_users_exactly(spark):
    rows = _days(spark)
    df = spark.createDataFrame(rows, "day date, u string").repartition(4)
    table = rolling_windows(df.select("day").filter("day BETWEEN DATE'2023-12-01' AND DATE'2024-01-10'"), 30)
    spans = {r["period"]: (r["start"], r["end"]) for r in table.collect()}
    assert len(spans) > 700
    got = {r["period"]: r["users"] for r in users_by_window(daily_bitmaps(df, "u", "day"), "day", table).collect()}
    assert got == {p: len({u for d, u in rows if d and u and s <= d <= e}) for p, (s, e) in spans.items()}


def test_user_numbers_are_dense_and_bitmaps_cross_buckets(spark):
    users = spark.range(70_000).select(F.concat(F.lit("u"), F.col("id")).alias("u"))
    numbers = user_numbers(users.unionByName(users.limit(10)))
    assert numbers.agg(F.min("user_no"), F.max("user_no"), F.count_distinct("user_no")).first() == (1, 70_000, 70_000)
    days = users.withColumn("day", F.date_add(F.lit(date(2024, 1, 1)), (F.xxhash64("u") % 3).cast("int")))
    window = spark.createDataFrame([("all", date(2023, 12, 1), date(2024, 2, 1))], "period string, start date, end date")
    assert users_by_window(daily_bitmaps(days, "u", "day"), "day", window).collect()[0]["users"] == 70_000
