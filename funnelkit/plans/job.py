"""The whole build, as the reference's ``main`` runs it: cube, trend,
calibration, period totals and row counts, published under one output folder.

Fault tolerance: every output is written to storage by Spark; totals and cube
are written first and read back, so no later output recomputes them or depends
on their lineage (a lost executor costs only the tasks it ran).  The build is
one publication (``sinks.publish``): readers see all of it or the one before.
The output folder should be shared storage on a cluster.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import FunnelConfig
from ..operators.allocate import allocate
from ..operators.ranking import top_per_group_exact
from ..operators.totals import aggregate_totals
from ..sinks.documents import (cube_document, cube_document_lines, cube_header, trend_document, write_cube,
                               write_document_lines, write_json_document)
from ..sinks.publish import Publication
from ..sources.tables import literal_df
from .cube import web_cube
from .funnel import CUBE_COLUMNS
from .report import calibrate, period_totals
from .trend import trend, trend_arrays


class RowCounts:
    """Row counts taken by the jobs that write the rows (``DataFrame.observe``),
    so a count costs no job of its own."""

    def __init__(self):
        self._seen: dict[str, Observation] = {}

    def of(self, df: DataFrame, name: str) -> DataFrame:
        self._seen[name] = Observation(f"rows of {name}")
        return df.observe(self._seen[name], F.count(F.lit(1)).alias("rows"))

    def taken(self) -> dict[str, int]:
        """The counts; each frame must have been written."""
        return {name: self._rows(seen) for name, seen in self._seen.items()}

    @staticmethod
    def _rows(seen: Observation) -> int:
        try:
            return int(seen.get["rows"])
        except Py4JJavaError:  # adaptive execution found the frame empty and dropped it from the plan, metrics and all
            return 0


def run_build(spark: SparkSession, events: DataFrame, trials: DataFrame, paid: DataFrame,
              cfg: FunnelConfig, out_dir: str, trend_inputs=None, cube_json: bool = False,
              suppress: bool = True, top_rows: int | None = None, cube_lines: bool = False) -> dict[str, str]:
    """Publish cube rows + header, trend document, calibration, period totals
    and row counts; returns where each output is.

    ``trend_inputs`` optionally gives different (events, trials, paid) for the
    trend and calibration; by default the same frames serve every output.
    ``top_rows`` keeps that many rows per period with the largest visits + trials
    + paid (M8; the source job keeps 30,000).  ``cube_json`` also writes the cube
    as one JSON document (header + rows); ``cube_lines`` writes the same document
    as ordered text parts, for any number of rows.  ``suppress=False`` keeps the
    small cells.
    """
    build, counts = Publication(spark, out_dir), RowCounts()
    out: dict[str, str] = {}

    def table(name: str, df: DataFrame) -> DataFrame:
        out[name] = build.path(name, df.schema)
        df.write.parquet(out[name])
        return spark.read.schema(df.schema).parquet(out[name])

    totals = table("aggregate_totals", counts.of(aggregate_totals(trials, paid, cfg), "aggregate_totals"))
    cells = counts.of(web_cube(events, cfg, suppress), "web_cube")
    cube_df = allocate(cells, totals, cfg)
    if top_rows is not None:
        cube_df = top_per_group_exact(
            cube_df, top_rows, F.col("visits") + F.col("trials") + F.col("paid"), ("period",),
            ("landing_family", "channel", "geo_country", "device", "new_returning", "is_placeholder"))
    cube_df = cube_df.select(*[F.col("geo_country").alias("country") if c == "country" else F.col(c) for c in CUBE_COLUMNS])
    out["cube"] = build.path("cube", cube_df.schema)
    write_cube(counts.of(cube_df, "cube"), out["cube"])
    out["cube_header"] = build.path("cube_header")
    write_json_document(cube_header(spark, cfg), out["cube_header"])
    # the known schema: an empty cube writes no partition files to infer from
    cube = spark.read.schema(cube_df.schema).parquet(out["cube"])
    if cube_json:
        out["cube_document"] = build.path("cube_document")
        write_json_document(cube_document(cube, cfg), out["cube_document"])
    if cube_lines:
        out["cube_lines"] = build.path("cube_lines")
        write_document_lines(cube_document_lines(cube, cfg), out["cube_lines"])
    t_ev, t_tr, t_pd = trend_inputs or (events, trials, paid)
    out["trend"] = build.path("trend")
    weekly = counts.of(trend(t_ev, t_tr, t_pd, cfg), "trend_weeks")
    write_json_document(trend_document(trend_arrays(weekly)), out["trend"])
    table("calibration", calibrate(t_ev, t_tr, t_pd, cfg).coalesce(1))
    table("period_totals", period_totals(cube, cfg).coalesce(1))
    taken = counts.taken()
    table("row_counts", literal_df(spark, ("extract", "rows"), ("string", "long"), list(taken.items())).coalesce(1))
    out["manifest"] = build.commit(taken, cfg.as_of.isoformat())
    out["version"] = build.version
    return out
