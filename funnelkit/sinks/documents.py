"""Sinks (K1-K4): the cube and trend documents and the reports.

The reference serialises each output as one minified JSON document on one
machine.  Here every output is a DataFrame written by Spark:

* K1 cube: rows as parquet or JSON lines partitioned by ``period`` (written
  in parallel), plus a one-row header document (K3).  The reference's single
  document is header + rows; a consumer joins them, or ``cube_document``
  builds it when the cube is known to be small (its closed dimensions bound it).
* K2 trend: one row of week-aligned arrays (44 weeks by configuration).
* K4 reports: calibration and period totals stay DataFrames; printing is
  the caller's concern.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import STAGES, FunnelConfig
from ..operators.ranking import numbered

JSON_OPTIONS = {"ignoreNullFields": "false"}  # Spark drops null fields by default


def cube_header(spark: SparkSession, cfg: FunnelConfig) -> DataFrame:
    """K3: {as_of, windows: {period: {start, end}}, stages}, one row built
    from configuration literals (windows in configuration order)."""
    windows = F.create_map(*[e for w in cfg.windows for e in (
        F.lit(w.period), F.struct(F.lit(w.start.isoformat()).alias("start"), F.lit(w.end.isoformat()).alias("end")))])
    return spark.range(1).select(F.lit(cfg.as_of.isoformat()).alias("as_of"), windows.alias("windows"),
                                 F.array(*[F.lit(s) for s in STAGES]).alias("stages"))


def write_cube(cube: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """K1 rows: one directory per period, written by all tasks in parallel."""
    w = cube.write.mode(mode).partitionBy("period")
    if fmt == "json":
        w.options(**JSON_OPTIONS).json(path)
    else:
        w.format(fmt).save(path)


def cube_document(cube: DataFrame, cfg: FunnelConfig) -> DataFrame:
    """K1 + K3 as the reference's single document (one row).

    Only for closed dimensions: families, channels, listed countries, devices
    and new/returning bound the rows of a window, and so this one-row
    aggregate.  An open country list is refused; use ``write_cube`` for it.
    """
    if cfg.top_countries is None:
        raise ValueError("cube_document needs a closed country list; use write_cube")
    # sorted by the cell key (the leading struct fields), so the text is stable
    rows = cube.agg(F.array_sort(F.collect_list(F.struct(*cube.columns))).alias("rows"))
    return cube_header(cube.sparkSession, cfg).crossJoin(rows)


def cube_document_lines(cube: DataFrame, cfg: FunnelConfig) -> DataFrame:
    """K1 + K3 as a stream: the text of ``cube_document`` in numbered pieces
    (line, text) that joined in order give the same bytes, for any number of
    rows and an open country list.  Line 0 opens the document, each row is a
    line, the last line closes it; no row count bounds it, since the rows are
    numbered by one range-partitioned sort (``numbered``)."""
    spark = cube.sparkSession
    rows = numbered(cube, [], [F.col(c).asc_nulls_first() for c in cube.columns], "document_rows", into="line")
    comma = F.when(F.col("line") > 0, ",").otherwise("")
    lines = rows.select((F.col("line") + 1).alias("line"), F.concat(comma, F.to_json(F.struct(*cube.columns))).alias("text"))
    header = cube_header(spark, cfg).select(F.to_json(F.struct("as_of", "windows", "stages")).alias("text"))
    opening = header.select(F.lit(0).cast("long").alias("line"), F.concat(
        F.expr("left(text, length(text) - 1)"), F.lit(',"rows":[')).alias("text"))
    closing = rows.agg((F.count(F.lit(1)) + 1).alias("line")).withColumn("text", F.lit("]}"))
    return opening.unionByName(lines).unionByName(closing)


def write_document_lines(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write numbered lines as text parts in order: the part files, read by
    name, are the document, with a line break (white space to JSON) after each piece."""
    lines.repartitionByRange("line").sortWithinPartitions("line").select("text").write.mode(mode).text(path)


def trend_document(arrays: DataFrame) -> DataFrame:
    """K2: {weeks, weeks_prior_year, stages, series_current{..}, series_prior{..}}."""
    return arrays.select(
        "weeks", "weeks_prior_year", F.array(*[F.lit(s) for s in STAGES]).alias("stages"),
        F.struct(*[F.col(f"{s}_current").alias(s) for s in STAGES]).alias("series_current"),
        F.struct(*[F.col(f"{s}_prior").alias(s) for s in STAGES]).alias("series_prior"))


def document_text(doc: DataFrame) -> DataFrame:
    """A one-row document as one JSON string column ``document`` (the text a
    JSON sink writes, compact, keys in column order)."""
    return doc.select(F.to_json(F.struct(*doc.columns)).alias("document"))


def write_json_document(doc: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a one-row document as a single JSON file in ``path``."""
    doc.coalesce(1).write.mode(mode).options(**JSON_OPTIONS).json(path)
