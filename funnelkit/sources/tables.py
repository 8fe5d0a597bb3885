"""Readers for the funnel's inputs.

Readers only select and type columns; filters are applied by the operators
with literal bounds, so Catalyst pushes them into the parquet scan (and prunes
``event_date`` partitions when the table is stored partitioned by it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import FunnelConfig
from .checks import checked_weekly

EVENT_COLUMNS = (
    "event_seq", "user_pseudo_id", "session_id", "event_name", "event_timestamp", "event_date",
    "user_id", "hostname", "page_path", "page_group", "geo_country", "device_category",
    "ga_session_number", "traffic_source_source", "traffic_source_medium",
)

EVENT_SCHEMA = T.StructType([
    T.StructField("event_seq", T.LongType()),
    T.StructField("user_pseudo_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("event_timestamp", T.TimestampNTZType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("hostname", T.StringType()),
    T.StructField("page_path", T.StringType()),
    T.StructField("page_group", T.StringType()),
    T.StructField("geo_country", T.StringType()),
    T.StructField("device_category", T.StringType()),
    T.StructField("ga_session_number", T.LongType()),
    T.StructField("traffic_source_source", T.StringType()),
    T.StructField("traffic_source_medium", T.StringType()),
])


def load_table(spark: SparkSession, source: str, schema=None) -> DataFrame:
    if "/" in source or source.endswith(".parquet"):
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(source)
    return spark.table(source)


def read_events(spark: SparkSession, source: str, schema=None) -> DataFrame:
    """Session events (parquet path or table name).  ``event_seq`` is
    optional.  Pass ``schema`` (e.g. EVENT_SCHEMA) to skip schema inference
    on a path; the partition column ``event_date`` is then taken from it."""
    return event_columns(load_table(spark, source, schema))


def event_columns(df: DataFrame) -> DataFrame:
    """The event columns of ``df``, ``event_seq`` NULL where it has none."""
    if "event_seq" not in df.columns:
        df = df.withColumn("event_seq", F.lit(None).cast("long"))
    return df.select(*EVENT_COLUMNS)


def read_weekly(spark: SparkSession, source: str, schema=None, check: bool = True) -> DataFrame:
    """A weekly aggregate table (trials or bookings), with its weeks and
    keys checked inside the plan (``checked_weekly``)."""
    weekly = load_table(spark, source, schema)
    return checked_weekly(weekly) if check else weekly


# -- S4 literal tables --------------------------------------------------------
# Their row counts are fixed by the configuration, which is what makes an
# explicit broadcast of them safe.  They are built from literal expressions
# (``inline`` of an array of structs), which Catalyst folds into a local
# relation on the JVM: no Python worker is involved, unlike a DataFrame made
# from a Python list.

def _sql_literal(v, t: str) -> str:
    if v is None:
        return f"CAST(NULL AS {t})"
    if t == "date":
        return f"DATE'{v.isoformat()}'"
    if t == "string":
        return "'" + str(v).replace("'", "''") + "'"
    return f"CAST({v} AS {t})"


def literal_df(spark: SparkSession, names: tuple[str, ...], types: tuple[str, ...], rows) -> DataFrame:
    structs = ", ".join(
        "named_struct(" + ", ".join(f"'{n}', {_sql_literal(v, t)}" for v, n, t in zip(r, names, types)) + ")"
        for r in rows)
    return spark.range(1).select(F.expr(f"inline(array({structs}))"))


def windows_df(spark: SparkSession, cfg: FunnelConfig) -> DataFrame:
    rows = [(w.period, w.start, w.end) for w in cfg.windows]
    return literal_df(spark, ("period", "start", "end"), ("string", "date", "date"), rows)


def bridge_df(spark: SparkSession, cfg: FunnelConfig) -> DataFrame:
    return literal_df(spark, ("country_group", "bucket"), ("string", "string"), cfg.country_bridge)


def targets_df(spark: SparkSession, cfg: FunnelConfig) -> DataFrame:
    return literal_df(spark, ("stage", "reference"), ("string", "long"), cfg.calibration_targets)


def week_grid(spark: SparkSession, cfg: FunnelConfig) -> DataFrame:
    """The trend weeks (Mondays) and their weekday-aligned prior twins."""
    start = cfg.trend_start_week
    return (spark.range(cfg.trend_weeks, numPartitions=1)
            .select(F.date_add(F.lit(start), (F.col("id") * 7).cast("int")).alias("wk"))
            .withColumn("prior_wk", F.date_sub("wk", cfg.trend_shift_days)))
