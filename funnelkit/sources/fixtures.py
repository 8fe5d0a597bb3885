"""Adapters: the driver's tables -> reference-shaped funnel inputs.

The driver's data is a TPC-H-like schema plus an ``events`` table.  Two event
frames are derived from it, each in the shape of a web session-event fact:

* ``web_events``   from events x customer x nation (Jan 2024, day sessions),
  used by the cube, whose windows are days long;
* ``order_events`` from orders x customer x nation (1995-2001, month
  sessions), used by the 44-week trend and the fiscal calibration.

and two pairs of weekly aggregate tables (trials, bookings) with Sunday weeks.
Each adapter exists twice, as DataFrame code for Spark and as SQL text for the
DuckDB oracle; the two are kept rule for rule identical.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import FunnelConfig
from ..functions.dates import sunday_week
from .tables import event_columns, load_table

SITE_HOST = "site.example"
APP_HOST = "app.site.example"
OTHER_HOST = "other.example"

# Value lists indexed by ``seq % len(list)``; None is SQL NULL.
PAGE_GROUPS = (
    "homepage", "marketing_pricing_page", "solutions", "solutions_pages_email_marketing",
    "solutions_pages_sms_marketing", "solutions_pages_marketing_automation", "signup_start_page",
    "sales", "landing_pages", "personalize", "features_pages_x", "resources_pages", "help_pages_y",
    "integrations_pages", "my_analytics_z", "unmapped", None,
)
DEVICES = ("Mobile", "desktop", "TABLET", None, "smart tv", "mobile")
SOURCES = ("(direct)", "google", "x", None, None)
MEDIUMS = ("CPC", "paid_social", "organic", "social", "Email", "affiliate", "referral", "banner", "",
           "(none)", "podcast", "qr", None)
KB_NATION = 4          # every page of this nation is a help page (no acquisition visits)
NO_GEO_NATION = 5      # this nation has no geo at all
HOT_COUNTRY = "NATION_1"
TOP_NATIONS = tuple(f"NATION_{i}" for i in range(7))
BRIDGE = tuple((f"NATION_{i}", f"NATION_{i}") for i in range(6)) + (("NATION_6", "Other"), ("ROW", "Other"))
BRIDGE_HEADLINE = tuple((f"NATION_{i}", f"NATION_{i}") for i in range(7)) + (("ROW", "Other"),)


def cube_config() -> FunnelConfig:
    """Settings for the cube over ``web_events`` (FIXTURES.md section 3)."""
    return FunnelConfig(
        as_of=date(2024, 1, 30), site_host=SITE_HOST, window_days=(7, 14), prior_shift_days=15,
        top_countries=TOP_NATIONS, country_bridge=BRIDGE, min_visits=2, scope_country="NATION_1",
    )


def headline_config() -> FunnelConfig:
    """The cube settings with a headline bridge (one more group by name)."""
    return cube_config().with_(country_bridge=BRIDGE_HEADLINE)


def trend_config() -> FunnelConfig:
    """Settings for the trend and calibration over ``order_events``."""
    return FunnelConfig(
        as_of=date(2000, 12, 30), site_host=SITE_HOST, top_countries=TOP_NATIONS, country_bridge=BRIDGE,
        scope_country="NATION_1", fiscal_year="FY2000", fiscal_weeks=(1, 13),
    )


# -- DataFrame side ---------------------------------------------------------

# Declared schemas of the driver tables that are read: no inference job per
# read, and a changed file fails fast instead of silently re-typing a column.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_table(spark, f"{sf_dir}/{name}.parquet", TABLE_SCHEMAS[name])


def _pick(idx: str, values) -> Column:
    return F.expr(_pick_sql(idx, values))


def _customer_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # nation has 25 rows by the TPC-H spec: a bounded broadcast.
    return customer.join(F.broadcast(nation), customer.c_nationkey == nation.n_nationkey)


def _shape(df: DataFrame) -> DataFrame:
    """Common columns from seq, uid, ts, event_name, page_path, nk, n_name."""
    seq = F.col("seq")
    return df.select(
        seq.alias("event_seq"),
        F.col("uid").cast("string").alias("user_pseudo_id"),
        F.col("session_id"),
        F.col("event_name"),
        F.col("ts").alias("event_timestamp"),
        F.col("ts").cast("date").alias("event_date"),
        F.when(seq % 7 == 0, F.col("uid").cast("string")).alias("user_id"),
        F.when(seq % 10 == 0, F.lit(APP_HOST)).when(seq % 97 == 1, F.lit(OTHER_HOST))
         .otherwise(F.lit(SITE_HOST)).alias("hostname"),
        F.col("page_path"),
        F.when(F.col("nk") == KB_NATION, F.lit("knowledge_base_pages"))
         .otherwise(_pick("seq % 17", PAGE_GROUPS)).alias("page_group"),
        F.when((F.col("nk") == NO_GEO_NATION) | (seq % 19 == 0), F.lit(None).cast("string"))
         .otherwise(F.col("n_name")).alias("geo_country"),
        _pick("seq % 6", DEVICES).alias("device_category"),
        (seq % 3 + 1).alias("ga_session_number"),
        _pick("seq % 5", SOURCES).alias("traffic_source_source"),
        _pick("seq % 13", MEDIUMS).alias("traffic_source_medium"),
    ).transform(event_columns)


def web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    cn = _customer_nation(spark, sf_dir)
    j = ev.join(cn, ev.user_id == cn.c_custkey)
    return _shape(j.select(
        F.col("event_id").alias("seq"), F.col("user_id").alias("uid"), "ts",
        F.col("ts").cast("date").cast("string").alias("session_id"),
        F.when((F.col("event_type") == "signup") & (F.col("value") < 5), F.lit("sign_up"))
         .otherwise(F.col("event_type")).alias("event_name"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("/"), F.col("event_type"))).alias("page_path"),
        F.col("c_nationkey").alias("nk"), "n_name"))


def hot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``web_events`` with a third of the users in one country."""
    hot = F.col("user_pseudo_id").cast("long") % 3 == 0
    return web_events(spark, sf_dir).withColumn("geo_country", F.when(hot, HOT_COUNTRY).otherwise(F.col("geo_country")))


def line_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as cube cells, most of them in one period, with many equal
    scores: more rows than the source job's cap from sf0.01 on."""
    line = read_table(spark, sf_dir, "lineitem")
    text = {"landing_family": "l_returnflag", "channel": "l_linenumber", "geo_country": "l_suppkey",
            "device": "l_orderkey", "new_returning": "l_partkey"}
    return line.select(
        F.when(F.col("l_linenumber") == 7, "prior").otherwise("current").alias("period"),
        *[F.col(c).cast("string").alias(k) for k, c in text.items()],
        F.col("l_quantity").cast("long").alias("visits"), F.col("l_linenumber").cast("long").alias("activations"),
        F.round(F.col("l_tax") * 100).cast("long").alias("trials"), F.round(F.col("l_discount") * 100).cast("long").alias("paid"))


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    cn = _customer_nation(spark, sf_dir)
    j = o.join(cn, o.o_custkey == cn.c_custkey)
    return _shape(j.select(
        F.col("o_orderkey").alias("seq"), F.col("o_custkey").alias("uid"), F.col("o_orderdate").alias("ts"),
        (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("string").alias("session_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("sign_up")).otherwise(F.lit("order")).alias("event_name"),
        F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 3 == 0), F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("/"), F.lower("o_orderstatus"))).alias("page_path"),
        F.col("c_nationkey").alias("nk"), "n_name"))


def _country_group(nk: Column, name: Column) -> Column:
    return F.when(nk <= 6, name).when(nk == 24, F.lit(None).cast("string")).otherwise(F.lit("ROW"))


def _weekly(base: DataFrame, measure: str) -> DataFrame:
    """Weekly counts per country group with fiscal labels and the value of
    the same group 364 days earlier (a range window: one pass, no self-join)."""
    agg = (base.groupBy("week", "country_group").agg(F.count(F.lit(1)).alias(measure))
           .withColumn("agg_key", F.lit("all")))
    year_ago = (Window.partitionBy("country_group", "agg_key").orderBy(F.unix_date("week"))
                .rangeBetween(-364, -364))
    return agg.select(
        "week", "country_group", "agg_key", F.col(measure),
        F.coalesce(F.sum(measure).over(year_ago), F.lit(0)).alias(f"{measure}_prev_yr"),
        F.concat(F.lit("FY"), F.year("week").cast("string")).alias("fy_text"),
        (F.floor((F.dayofyear("week") - 1) / 7) + 1).cast("int").alias("fw_number"))


def _events_weekly_base(spark: SparkSession, sf_dir: str, event_type: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("ts", "user_id", "event_type")
    cn = _customer_nation(spark, sf_dir)
    j = ev.filter(F.col("event_type") == event_type).join(cn, ev.user_id == cn.c_custkey)
    return j.select(sunday_week(F.col("ts").cast("date")).alias("week"),
                    _country_group(F.col("c_nationkey"), F.col("n_name")).alias("country_group"))


def _orders_weekly_base(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderdate")
    cn = _customer_nation(spark, sf_dir)
    j = o.filter(F.col("o_orderstatus") == status).join(cn, o.o_custkey == cn.c_custkey)
    return j.select(sunday_week(F.col("o_orderdate").cast("date")).alias("week"),
                    _country_group(F.col("c_nationkey"), F.col("n_name")).alias("country_group"))


def web_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weekly(_events_weekly_base(spark, sf_dir, "view"), "free_trial_users")


def web_paid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weekly(_events_weekly_base(spark, sf_dir, "purchase"), "total_bookings_users")


def order_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weekly(_orders_weekly_base(spark, sf_dir, "O"), "free_trial_users")


def order_paid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weekly(_orders_weekly_base(spark, sf_dir, "F"), "total_bookings_users")


# -- SQL side (DuckDB) --------------------------------------------------------

def _q(v) -> str:
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


def _pick_sql(idx: str, values) -> str:
    return "CASE " + " ".join(f"WHEN {idx} = {i} THEN {_q(v)}" for i, v in enumerate(values)) + " END"


def _shape_sql(inner: str) -> str:
    return f"""SELECT
      seq AS event_seq,
      CAST(uid AS VARCHAR) AS user_pseudo_id,
      session_id,
      event_name,
      ts AS event_timestamp,
      CAST(ts AS DATE) AS event_date,
      CASE WHEN seq % 7 = 0 THEN CAST(uid AS VARCHAR) END AS user_id,
      CASE WHEN seq % 10 = 0 THEN '{APP_HOST}' WHEN seq % 97 = 1 THEN '{OTHER_HOST}' ELSE '{SITE_HOST}' END AS hostname,
      page_path,
      CASE WHEN nk = {KB_NATION} THEN 'knowledge_base_pages' ELSE {_pick_sql('seq % 17', PAGE_GROUPS)} END AS page_group,
      CASE WHEN nk = {NO_GEO_NATION} OR seq % 19 = 0 THEN NULL ELSE n_name END AS geo_country,
      {_pick_sql('seq % 6', DEVICES)} AS device_category,
      seq % 3 + 1 AS ga_session_number,
      {_pick_sql('seq % 5', SOURCES)} AS traffic_source_source,
      {_pick_sql('seq % 13', MEDIUMS)} AS traffic_source_medium
    FROM ({inner}) base"""


WEB_EVENTS_SQL = _shape_sql("""
      SELECT e.event_id AS seq, e.user_id AS uid, e.ts AS ts,
             CAST(CAST(e.ts AS DATE) AS VARCHAR) AS session_id,
             CASE WHEN e.event_type = 'signup' AND e.value < 5 THEN 'sign_up' ELSE e.event_type END AS event_name,
             CASE WHEN e.event_type = 'error' THEN NULL ELSE '/' || e.event_type END AS page_path,
             c.c_nationkey AS nk, n.n_name AS n_name
      FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey""")

HOT_EVENTS_SQL = f"""SELECT * REPLACE (CASE WHEN CAST(user_pseudo_id AS BIGINT) % 3 = 0 THEN '{HOT_COUNTRY}'
      ELSE geo_country END AS geo_country) FROM ({WEB_EVENTS_SQL}) w"""

LINE_CELLS_SQL = """
      SELECT CASE WHEN l_linenumber = 7 THEN 'prior' ELSE 'current' END AS period, l_returnflag AS landing_family,
             CAST(l_linenumber AS VARCHAR) AS channel, CAST(l_suppkey AS VARCHAR) AS geo_country,
             CAST(l_orderkey AS VARCHAR) AS device, CAST(l_partkey AS VARCHAR) AS new_returning,
             CAST(l_quantity AS BIGINT) AS visits, CAST(l_linenumber AS BIGINT) AS activations,
             CAST(round(l_tax * 100) AS BIGINT) AS trials, CAST(round(l_discount * 100) AS BIGINT) AS paid
      FROM lineitem"""

ORDER_EVENTS_SQL = _shape_sql("""
      SELECT o.o_orderkey AS seq, o.o_custkey AS uid, o.o_orderdate AS ts,
             CAST(year(o.o_orderdate) * 100 + month(o.o_orderdate) AS VARCHAR) AS session_id,
             CASE WHEN o.o_orderpriority = '1-URGENT' THEN 'sign_up' ELSE 'order' END AS event_name,
             CASE WHEN o.o_orderstatus = 'P' AND o.o_orderkey % 3 = 0 THEN NULL ELSE '/' || lower(o.o_orderstatus) END AS page_path,
             c.c_nationkey AS nk, n.n_name AS n_name
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey""")

SUNDAY_SQL = "(CAST(date_trunc('week', {d} + 1) AS DATE) - 1)"
CG_SQL = "CASE WHEN c.c_nationkey <= 6 THEN n.n_name WHEN c.c_nationkey = 24 THEN NULL ELSE 'ROW' END"


def _weekly_sql(base: str, measure: str) -> str:
    return f"""SELECT a.week, a.country_group, a.agg_key, a.{measure},
        COALESCE(p.{measure}, 0) AS {measure}_prev_yr,
        'FY' || CAST(year(a.week) AS VARCHAR) AS fy_text,
        CAST(floor((dayofyear(a.week) - 1) / 7) + 1 AS INTEGER) AS fw_number
      FROM (SELECT week, country_group, 'all' AS agg_key, COUNT(*) AS {measure} FROM ({base}) b GROUP BY 1, 2) a
      LEFT JOIN (SELECT week, country_group, 'all' AS agg_key, COUNT(*) AS {measure} FROM ({base}) b GROUP BY 1, 2) p
        ON a.week = p.week + 364 AND a.country_group IS NOT DISTINCT FROM p.country_group AND a.agg_key = p.agg_key"""


def _events_base_sql(event_type: str) -> str:
    return f"""SELECT {SUNDAY_SQL.format(d='CAST(e.ts AS DATE)')} AS week, {CG_SQL} AS country_group
      FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
      WHERE e.event_type = '{event_type}'"""


def _orders_base_sql(status: str) -> str:
    return f"""SELECT {SUNDAY_SQL.format(d='CAST(o.o_orderdate AS DATE)')} AS week, {CG_SQL} AS country_group
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
      WHERE o.o_orderstatus = '{status}'"""


WEB_TRIALS_SQL = _weekly_sql(_events_base_sql("view"), "free_trial_users")
WEB_PAID_SQL = _weekly_sql(_events_base_sql("purchase"), "total_bookings_users")
ORDER_TRIALS_SQL = _weekly_sql(_orders_base_sql("O"), "free_trial_users")
ORDER_PAID_SQL = _weekly_sql(_orders_base_sql("F"), "total_bookings_users")
