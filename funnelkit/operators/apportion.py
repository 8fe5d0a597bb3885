"""M1-M7 and J10 on open domains: groups of any number of cells.

``operators.allocate`` ranks a (period, country) group with windows, which is
right while the other dimensions are closed (at most 757 rows).  With raw
landing pages, media or days in the cell key a group can hold a third of all
cells; here nothing sees a whole group:

* group totals (visits, rows) are a pre-aggregated key set; the groups without
  visits come from it by an anti join instead of a window (J10, M1);
* the totals meet the cells in a salted join;
* each cell's floor and exact remainder are per-row arithmetic; the units that
  the floors leave are the group's total less a sum of floors;
* who gets a leftover unit is decided by a place in the order (remainder
  descending, dimensions) from one range-partitioned sort (``numbered``): the
  even split of a group without visits (M6) is the case of equal remainders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import FunnelConfig
from ..storage import written
from .allocate import GROUP, MEASURES
from .ranking import numbered, salted_join


def group_sums(cells: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """A22 per group: visits and number of cells (map-side sums)."""
    return cells.groupBy(*group).agg(F.sum("visits").alias("group_visits"), F.count(F.lit(1)).alias("group_rows"))


def open_placeholders(cells: DataFrame, totals: DataFrame, labels: dict[str, str], group: Sequence[str] = GROUP) -> DataFrame:
    """J10 + M1: one row for each group with trials or paid and no visits;
    ``labels`` are its values of the other dimensions."""
    visited = group_sums(cells, group).filter(F.col("group_visits") > 0).select(*group)
    missing = totals.filter(" OR ".join(f"{m} > 0" for m in MEASURES)).join(visited, list(group), "left_anti")
    kinds = {f.name: f.dataType for f in cells.schema}
    zero = F.lit(0).cast("long")
    return missing.select(*[
        F.col(c) if c in group else zero.alias(c) if c in ("visits", "activations")
        else F.lit(True).alias(c) if c == "is_placeholder" else F.lit(-1).cast("long").alias(c) if c == "__cell" else F.lit(labels.get(c)).cast(kinds[c]).alias(c)
        for c in cells.columns])


def allocate_open(cells: DataFrame, totals: DataFrame, cfg: FunnelConfig, order: Sequence[str],
                  labels: dict[str, str] | None = None, group: Sequence[str] = GROUP) -> DataFrame:
    """M1-M7: ``cells`` (group, ``order`` dimensions, visits, activations) and
    placeholders with ``trials`` and ``paid`` of ``totals`` (group, measures)
    spread over them by the rules of ``allocate``, whatever the size of a group;
    also ``is_placeholder`` and ``group_visits``.  Group keys are not NULL."""
    # the number keeps repeated cells apart; it is stored, so every reader sees the same one
    base = written(cells.select("*", F.lit(False).alias("is_placeholder"),
                                F.monotonically_increasing_id().alias("__cell")), "open_cells")
    labels = dict(cfg.placeholder_dims) if labels is None else labels
    want = totals.select(*group, *[F.coalesce(F.col(m), F.lit(0)).cast("long").alias(m) for m in MEASURES])
    rows = base.unionByName(open_placeholders(base, want, labels, group))
    per_group = group_sums(rows, group).join(want.withColumnsRenamed({m: f"t_{m}" for m in MEASURES}), list(group), "left")
    per_group = per_group.na.fill(0, [f"t_{m}" for m in MEASURES])
    met = salted_join(rows, per_group, group)
    stages = F.array(*[F.struct(F.lit(m).alias("stage"), F.col(f"t_{m}").alias("total")) for m in MEASURES])
    units = met.select(*rows.columns, "group_visits", "group_rows", F.explode(stages).alias("s")).select(
        *rows.columns, "group_visits", "group_rows", "s.stage", "s.total")
    visited = F.col("group_visits") > 0
    # nothing to give: M2 and M5
    idle = F.when(visited, F.col("total") <= 0).otherwise(F.col("total") == 0)
    floor = F.when(idle, F.lit(0)).when(visited, F.expr("visits * total div nullif(group_visits, 0)")).otherwise(
        F.expr("(total - pmod(total, group_rows)) div group_rows"))
    rest = F.when(~idle & visited, F.expr("visits * total % nullif(group_visits, 0)")).otherwise(F.lit(0))
    units = units.withColumns({"floor": floor.cast("long"), "rest": rest.cast("long"), "__idle": idle})
    ranked = numbered(units.filter(~F.col("__idle")), [*group, "stage"],
                      [F.col("rest").desc(), F.col("is_placeholder").asc(), *[F.col(c).asc() for c in order]],
                      "open_units", sums={"floors": "floor"})
    share = F.col("floor") + F.when(F.col("place") < F.col("total") - F.col("floors"), 1).otherwise(0)
    keep = [*rows.columns, "group_visits", "stage"]
    given = ranked.select(*keep, share.cast("long").alias("n")).unionByName(
        units.filter("__idle").select(*keep, F.lit(0).cast("long").alias("n")))
    # both stages of a cell side by side again
    return given.groupBy(*rows.columns, "group_visits").agg(
        *[F.sum(F.when(F.col("stage") == m, F.col("n"))).alias(m) for m in MEASURES]).drop("__cell")
