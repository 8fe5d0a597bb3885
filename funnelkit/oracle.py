"""DuckDB SQL twins of the registered queries (the correctness oracle).

plans: an entry event is the first row of a window over its session, raw
values meet their expected labels in lookup tables of this module, every
measure is a row of a long table (stage, keys, n) that is summed once, weeks
come from a calendar spine, and the apportionment runs over unpivoted stages.
No rule text is shared with the engine, so a changed rule turns a row red.
"""

from __future__ import annotations

from datetime import date

from .config import SIGNUP_DEFAULTS_OLDER, FunnelConfig
from .sources import fixtures as fx

# Expected labels of the raw values in the fixtures and tests (None is NULL).
# page group -> (landing family, counts as an acquisition entry)
PAGE_LABELS = {
    "homepage": ("Homepage", True),
    "marketing_pricing_page": ("Pricing", True),
    "solutions": ("Other Solutions", True),
    "solutions_pages_email_marketing": ("Email Marketing solution", True),
    "solutions_pages_sms_marketing": ("SMS Marketing solution", True),
    "solutions_pages_marketing_automation": ("Marketing Automation solution", True),
    "signup_start_page": ("Direct to Signup", True),
    "sales": ("Other Solutions", True),
    "landing_pages": ("Paid Landing Pages", True),
    "personalize": ("Other Solutions", False),
    "features_pages_x": ("Other Feature pages", False),
    "resources_pages": ("SEO Resources", False),
    "help_pages_y": ("Knowledge Base / Help", False),
    "knowledge_base_pages": ("Knowledge Base / Help", False),
    "integrations_pages": ("Integrations", False),
    "my_analytics_z": ("Other", False),
    "unmapped": ("Other", False),
    None: ("Other", False),
}
EXTENDED_FAMILY = {"my_analytics_z": "Reporting & Analytics"}
# medium -> (channel, channel when the source is "(direct)")
MEDIUM_LABELS = {
    "CPC": ("Paid Search", "Paid Search"),
    "cpc": ("Paid Search", "Paid Search"),
    "paid_social": ("Paid Social", "Paid Social"),
    "organic": ("Organic Search", "Organic Search"),
    "social": ("Organic Social", "Organic Social"),
    "Email": ("Email", "Email"),
    "email": ("Email", "Email"),
    "affiliate": ("Affiliate", "Affiliate"),
    "referral": ("Referral", "Referral"),
    "banner": ("Display / Other", "Display / Other"),
    "": ("Direct", "Direct"),
    "(none)": ("Direct", "Direct"),
    "podcast": ("Display / Other", "Direct"),
    "qr": ("Display / Other", "Direct"),
    None: ("Direct", "Direct"),
}
DEVICE_LABELS = {"Mobile": "mobile", "mobile": "mobile", "desktop": "desktop", "TABLET": "tablet",
                 "smart tv": "desktop", None: "desktop"}
KEPT_COUNTRIES = ("NATION_0", "NATION_1", "NATION_2", "NATION_3", "NATION_4", "NATION_5", "NATION_6",
                  "US", "CA")

# The calendar of the fixtures, written out: cube windows, their scan ranges,
# and the trend weeks (Monday to Sunday) of this year and of 364 days before.
CUBE_WINDOWS = (
    ("current_7d", date(2024, 1, 24), date(2024, 1, 30)),
    ("prior_yr_7d", date(2024, 1, 9), date(2024, 1, 15)),
    ("current_14d", date(2024, 1, 17), date(2024, 1, 30)),
    ("prior_yr_14d", date(2024, 1, 2), date(2024, 1, 15)),
)
CUBE_RANGES = ((date(2024, 1, 2), date(2024, 1, 15)), (date(2024, 1, 17), date(2024, 1, 30)))
TREND_FIRST_WEEK, TREND_WEEKS, TREND_SHIFT = date(2000, 2, 28), 44, 364
TREND_RANGES = ((date(1999, 3, 1), date(2000, 1, 2)), (date(2000, 2, 28), date(2000, 12, 31)))
SUNDAY_RANGE = (date(2000, 2, 27), date(2000, 12, 30))
AS_OF = date(2024, 1, 30)
# country group of the weekly tables -> country of the cube (others: Other)
GROUP_COUNTRY = (("NATION_0", "NATION_0"), ("NATION_1", "NATION_1"), ("NATION_2", "NATION_2"), ("NATION_3", "NATION_3"),
                 ("NATION_4", "NATION_4"), ("NATION_5", "NATION_5"), ("NATION_6", "Other"), ("ROW", "Other"))
GROUP_COUNTRY_HEADLINE = (*GROUP_COUNTRY[:6], ("NATION_6", "NATION_6"), ("ROW", "Other"))
# a sign-up user without a session, and a group without visits
NO_SESSION = {"landing_family": "Direct to Signup", "channel": "Direct", "geo_country": "Other", "device": "desktop",
              "new_returning": "new"}
NO_VISITS = {"landing_family": "Other", "channel": "Direct", "device": "desktop", "new_returning": "new"}
MIN_VISITS = 2
STAGES = ("visits", "activations", "trials", "paid")
TARGETS = (("visits", 7711102), ("activations", 131765), ("trials", 42284), ("paid", 27030))
TOLERANCE_PCT = 10

DIMS = "landing_family, channel, geo_country, device, new_returning"
CUBE_TOP_K = 25


# -- literals ------------------------------------------------------------------

def lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).upper()
    if isinstance(v, date):
        return f"DATE '{v.isoformat()}'"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def table(name: str, columns: str, rows) -> str:
    """A literal table as one step of a WITH list."""
    body = ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows)
    return f"{name}({columns}) AS (VALUES {body})"


def windows_table(windows=CUBE_WINDOWS) -> str:
    return table("win", "period, opens, closes", windows)


def label_tables(cfg: FunnelConfig) -> list[str]:
    pages = {g: (EXTENDED_FAMILY.get(g, family) if cfg.extended_families else family, acq)
             for g, (family, acq) in PAGE_LABELS.items()}
    return [
        table("page_label", "raw, family, acquisition", [(g, *v) for g, v in pages.items()]),
        table("medium_label", "raw, from_direct, channel",
              [(m, k == 1, v[k]) for m, v in MEDIUM_LABELS.items() for k in (0, 1)]),
        table("device_label", "raw, device", DEVICE_LABELS.items()),
        table("kept", "country", [(c,) for c in KEPT_COUNTRIES]),
    ]


def query(steps: list[str], body: str) -> str:
    return "WITH " + ",\n".join(steps) + "\n" + body


# -- sessions ------------------------------------------------------------------

def marketing_host(cfg: FunnelConfig) -> str:
    return (f"(hostname = {lit(cfg.site_host)} OR "
            f"(event_name = {lit(cfg.signup_event)} AND ends_with(hostname, {lit(cfg.site_host)})))")


def calendar(cfg: FunnelConfig) -> tuple:
    """Windows and scan ranges: written out for the fixtures' calendar, those
    of ``cfg`` for any other."""
    own = fx.cube_config()
    if (cfg.as_of, cfg.window_days, cfg.prior_shift_days) == (own.as_of, own.window_days, own.prior_shift_days):
        return CUBE_WINDOWS, CUBE_RANGES
    return [(w.period, w.start, w.end) for w in cfg.windows], cfg.scan_ranges


def spans_table(ranges) -> str:
    return table("span", "opens, closes", ranges)


def first_of(keys: str, cond: str, source: str, columns: str = "*") -> str:
    """The earliest row of every key."""
    return (f"SELECT {columns} FROM {source} WHERE {cond} QUALIFY row_number() OVER "
            f"(PARTITION BY {keys} ORDER BY event_timestamp NULLS FIRST, event_seq NULLS FIRST) = 1")


def session_steps(cfg: FunnelConfig, raw: str, keys: str = "user_pseudo_id, session_id") -> list[str]:
    """``seen``, the site rows with the facts of their session, and the
    ``entry`` row of every session; ``raw`` selects the events in range."""
    page = "page_path IS NOT NULL" if cfg.entry_rule == "first_page" else "TRUE"
    return [
        f"seen AS (SELECT * FROM ({raw}) r WHERE {marketing_host(cfg)})",
        f"""site_row AS (
          SELECT *, min(event_date) OVER s AS session_date, bool_or(ga_session_number = 1) OVER s AS fresh,
                 bool_or(user_id IS NOT NULL) OVER s AS identified
          FROM seen WHERE hostname = {lit(cfg.site_host)} WINDOW s AS (PARTITION BY {keys}))""",
        f"entry AS ({first_of(keys, page, 'site_row')})",
    ]


def web_steps(cfg: FunnelConfig, ranges=None, source: str = fx.WEB_EVENTS_SQL) -> list[str]:
    raw = (f"SELECT * FROM ({source}) e WHERE EXISTS "
           "(SELECT 1 FROM span WHERE e.event_date BETWEEN span.opens AND span.closes)")
    return [spans_table(ranges or calendar(cfg)[1]), *session_steps(cfg, raw)]


def labelled_steps(cfg: FunnelConfig) -> list[str]:
    country = "coalesce(e.geo_country, 'Other')" if cfg.top_countries is None else "coalesce(k.country, 'Other')"
    return [*label_tables(cfg), f"""labelled AS (
      SELECT e.user_pseudo_id, e.session_id, e.session_date, e.identified, e.page_group, e.event_timestamp, e.event_seq,
             p.acquisition, p.family AS landing_family, m.channel, {country} AS geo_country, d.device,
             if(e.fresh, 'new', 'returning') AS new_returning
      FROM entry e
      LEFT JOIN page_label p ON p.raw IS NOT DISTINCT FROM e.page_group
      LEFT JOIN medium_label m ON m.raw IS NOT DISTINCT FROM e.traffic_source_medium
                              AND m.from_direct = (coalesce(e.traffic_source_source, '') = '(direct)')
      LEFT JOIN device_label d ON d.raw IS NOT DISTINCT FROM e.device_category
      LEFT JOIN kept k ON k.country = e.geo_country)"""]


# -- the cube --------------------------------------------------------------------

def cube_steps(cfg: FunnelConfig, windows=None, ranges=None,
               source: str = fx.WEB_EVENTS_SQL) -> list[str]:
    """Up to ``cell``: every (period, dimensions) with visits, activations."""
    older = {"landing_family": "Other"} if cfg.entry_rule == "first_event" else {}
    dims = ", ".join(f"coalesce(c.{k}, {lit((NO_SESSION | older)[k])}) AS {k}" for k in DIMS.split(", "))
    counted = "acquisition" + (" AND NOT identified" if cfg.exclude_identified else "")
    return [
        *web_steps(cfg, ranges, source), *labelled_steps(cfg), windows_table(windows or calendar(cfg)[0]),
        f"""joined_on AS (
          SELECT user_pseudo_id, event_date AS signup_date FROM seen WHERE event_name = {lit(cfg.signup_event)}
          QUALIFY row_number() OVER (PARTITION BY user_pseudo_id ORDER BY event_date) = 1)""",
        f"user_row AS ({first_of('user_pseudo_id', 'TRUE', 'labelled')})",
        f"""tally AS (
          SELECT 'visits' AS stage, period, {DIMS}, 1 AS n
          FROM labelled JOIN win ON session_date BETWEEN opens AND closes WHERE {counted}
          UNION ALL
          SELECT 'activations', period, {dims}, (j.user_pseudo_id IS NOT NULL)::INT
          FROM joined_on j JOIN win ON signup_date BETWEEN opens AND closes
          LEFT JOIN user_row c ON c.user_pseudo_id = j.user_pseudo_id)""",
        f"""cell AS (
          SELECT period, {DIMS}, coalesce(sum(n) FILTER (stage = 'visits'), 0)::BIGINT AS visits,
                 coalesce(sum(n) FILTER (stage = 'activations'), 0)::BIGINT AS activations
          FROM tally GROUP BY ALL)""",
    ]


def kept_cells(cfg: FunnelConfig | None = None) -> str:
    least = MIN_VISITS if cfg is None else cfg.min_visits
    return f"big_cell AS (SELECT * FROM cell WHERE activations > 0 OR visits >= {least})"


def _sessions_query(cfg: FunnelConfig, extra: str = "") -> str:
    raw = ", ".join(f"{c} AS entry_{c}" for c in ("page_group", "traffic_source_source", "traffic_source_medium",
                                                   "geo_country", "device_category"))
    return query(web_steps(cfg), f"SELECT user_pseudo_id, session_id, session_date, fresh::INT AS is_new, {extra}{raw} "
                                 "FROM entry")


def older_config() -> FunnelConfig:
    return fx.cube_config().with_(entry_rule="first_event", exclude_identified=True,
                                  signup_defaults=SIGNUP_DEFAULTS_OLDER, extended_families=True)


def events_in_ranges() -> str:
    return query(web_steps(fx.cube_config()), "SELECT * FROM seen")


def session_entry_first_page() -> str:
    return _sessions_query(fx.cube_config())


def session_entry_first_event() -> str:
    return _sessions_query(older_config(), "identified::INT AS any_uid, ")


def session_dims() -> str:
    cfg = fx.cube_config()
    return query(web_steps(cfg) + labelled_steps(cfg),
                 f"SELECT user_pseudo_id, session_id, session_date, {DIMS}, acquisition::INT AS is_acq FROM labelled")


def landing_family_extended() -> str:
    cfg = older_config()
    return query(web_steps(cfg) + labelled_steps(cfg),
                 "SELECT user_pseudo_id, session_id, page_group, landing_family FROM labelled")


def _stage_cells(stage: str) -> str:
    return query(cube_steps(fx.cube_config()), f"""SELECT period, {DIMS}, sum(n)::BIGINT AS {stage}
      FROM tally WHERE stage = '{stage}' GROUP BY ALL""")


def visits_by_period() -> str:
    return _stage_cells("visits")


def activations_by_period() -> str:
    return _stage_cells("activations")


def first_signups() -> str:
    return query(cube_steps(fx.cube_config()), "SELECT * FROM joined_on")


def user_attrs() -> str:
    return query(cube_steps(fx.cube_config()), f"SELECT user_pseudo_id, {DIMS} FROM user_row")


def web_cube() -> str:
    cfg = fx.cube_config()
    return query([*cube_steps(cfg), kept_cells()], "SELECT * FROM big_cell")


def window_cube_args():
    return older_config().with_(top_countries=None), date(2024, 1, 10), date(2024, 1, 24)


def window_cube() -> str:
    cfg, start, end = window_cube_args()
    return query(cube_steps(cfg, [("window", start, end)], [(start, end)]),
                 f"SELECT {DIMS}, visits, activations FROM cell")


# -- totals and apportionment -------------------------------------------------------

def weekly_step(trials_sql: str, paid_sql: str, extra: str = "") -> str:
    """Both weekly tables as one long table (week, country_group, stage, n)."""
    return f"""weekly AS (
      SELECT week, country_group{extra}, 'trials' AS stage, free_trial_users AS n FROM ({trials_sql}) t
      UNION ALL SELECT week, country_group{extra}, 'paid', total_bookings_users FROM ({paid_sql}) b)"""


def stage_sums(*stages: str) -> str:
    return ", ".join(f"coalesce(sum(n) FILTER (stage = '{s}'), 0)::BIGINT AS {s}" for s in stages)


def totals_steps(bridge=GROUP_COUNTRY, with_windows: bool = True) -> list[str]:
    return [*([windows_table()] if with_windows else []), weekly_step(fx.WEB_TRIALS_SQL, fx.WEB_PAID_SQL),
            table("bridge", "name, bucket", bridge), f"""want AS (
      SELECT period, coalesce(bucket, 'Other') AS country, {stage_sums('trials', 'paid')}
      FROM weekly JOIN win ON week BETWEEN opens AND closes LEFT JOIN bridge ON name = country_group GROUP BY ALL)"""]


def allocation_steps() -> list[str]:
    cfg = fx.cube_config()
    ph = NO_VISITS
    return [*cube_steps(cfg), kept_cells(), *totals_steps(with_windows=False), f"""lone AS (
      SELECT period, {lit(ph['landing_family'])} AS landing_family, {lit(ph['channel'])} AS channel,
             country AS geo_country, {lit(ph['device'])} AS device, {lit(ph['new_returning'])} AS new_returning,
             0::BIGINT AS visits, 0::BIGINT AS activations, TRUE AS is_placeholder
      FROM want WHERE greatest(trials, paid) > 0 AND NOT EXISTS (
        SELECT 1 FROM big_cell b WHERE b.period = want.period AND b.geo_country = want.country AND b.visits > 0))""",
            f"""member AS (
      SELECT *, sum(visits) OVER g AS group_visits, count(*) OVER g AS members,
             row_number() OVER (PARTITION BY period, geo_country
               ORDER BY is_placeholder, landing_family, channel, device, new_returning) AS pos
      FROM (SELECT *, FALSE AS is_placeholder FROM big_cell UNION ALL SELECT * FROM lone) u
      WINDOW g AS (PARTITION BY period, geo_country))""",
            # one row per member and stage: what it is owed and what the division leaves over
            """owed AS (
      SELECT member.period, geo_country, pos, stage, total, visits, members, nullif(group_visits, 0) AS group_visits,
             (visits * total) % nullif(group_visits, 0) AS rest
      FROM member JOIN (UNPIVOT want ON trials, paid INTO NAME stage VALUE total) w
        ON w.period = member.period AND w.country = member.geo_country)""",
            # the rests of a group sum to group_visits times the units still to give; the even
            # split gives the pos-th of m members floor((total + m - pos) / m)
            """given AS (
      SELECT period, geo_country, pos, stage, CASE
        WHEN group_visits IS NULL THEN floor((total + members - pos) / members)
        WHEN total <= 0 THEN 0
        ELSE (visits * total - rest) // group_visits
           + (row_number() OVER (PARTITION BY period, geo_country, stage ORDER BY rest DESC, pos) * group_visits
              <= sum(rest) OVER (PARTITION BY period, geo_country, stage))::INT END AS n
      FROM owed)""",
            f"""alloc AS (
      SELECT m.period, {', '.join('m.' + c for c in DIMS.split(', '))}, m.visits, m.activations,
             coalesce(t.n, 0)::BIGINT AS trials, coalesce(p.n, 0)::BIGINT AS paid, m.is_placeholder,
             m.group_visits::BIGINT AS group_visits
      FROM member m
      LEFT JOIN given t ON t.period = m.period AND t.geo_country = m.geo_country AND t.pos = m.pos AND t.stage = 'trials'
      LEFT JOIN given p ON p.period = m.period AND p.geo_country = m.geo_country AND p.pos = m.pos AND p.stage = 'paid')""",
            """cube AS (
      SELECT period, landing_family, channel, geo_country AS country, device, new_returning, visits, activations,
             trials, paid, is_placeholder FROM alloc)"""]


def aggregate_totals() -> str:
    return query(totals_steps(), "SELECT * FROM want")


def aggregate_totals_headline() -> str:
    return query(totals_steps(GROUP_COUNTRY_HEADLINE), "SELECT * FROM want")


def window_totals_by_group() -> str:
    return query(totals_steps(), f"""SELECT period, country_group, {stage_sums('trials', 'paid')}
      FROM weekly JOIN win ON week BETWEEN opens AND closes GROUP BY ALL""")


def missing_cells() -> str:
    return query(allocation_steps(), "SELECT * FROM lone")


_ALLOC_COLS = f"period, {DIMS}, visits, activations, trials, paid"


def allocate_shares() -> str:
    return query(allocation_steps(), f"SELECT {_ALLOC_COLS}, group_visits FROM alloc WHERE group_visits > 0")


def allocate_even_split() -> str:
    return query(allocation_steps(), f"SELECT {_ALLOC_COLS}, is_placeholder FROM alloc WHERE group_visits = 0")


_CUBE_KEYS = "period, landing_family, channel, country, device, new_returning"


def funnel_cube() -> str:
    return query(allocation_steps(), "SELECT * EXCLUDE (is_placeholder) FROM cube")


def cube_top_k() -> str:
    return query(allocation_steps(), f"""SELECT * EXCLUDE (is_placeholder) FROM cube
      QUALIFY row_number() OVER (PARTITION BY period
        ORDER BY visits + trials + paid DESC, {_CUBE_KEYS}, is_placeholder) <= {CUBE_TOP_K}""")


def _header_fields() -> str:
    windows = ", ".join(f"'{p}': {{'start': '{s.isoformat()}', 'end': '{e.isoformat()}'}}" for p, s, e in CUBE_WINDOWS)
    return f"'as_of': '{AS_OF.isoformat()}', 'windows': {{{windows}}}, 'stages': {list(STAGES)}"


def cube_document() -> str:
    """K1 + K3: {as_of, windows, stages, rows} as compact JSON text, rows
    ordered by the cell key."""
    row = "{" + ", ".join(f"'{c}': {c}" for c in (*_CUBE_KEYS.split(", "), *STAGES)) + "}"
    return query(allocation_steps(), f"""SELECT CAST(to_json({{{_header_fields()},
        'rows': list({row} ORDER BY {_CUBE_KEYS}, {', '.join(STAGES)})}}) AS VARCHAR) AS document FROM cube""")


def period_totals() -> str:
    scope = lit(fx.cube_config().scope_country)
    sums = ", ".join(f"coalesce(sum({s}), 0)::BIGINT AS {s}_global, "
                     f"coalesce(sum({s}) FILTER (country = {scope}), 0)::BIGINT AS {s}_scoped" for s in STAGES)
    return query(allocation_steps(), f"SELECT win.period, {sums} FROM win LEFT JOIN cube USING (period) GROUP BY ALL")


# -- weekly trend --------------------------------------------------------------------

def spine_table(ranges) -> list[str]:
    """The Monday weeks of the ranges, each clipped to its range."""
    return [spans_table(ranges), """spine AS (
      SELECT wk, greatest(wk, opens) AS opens, least(wk + 6, closes) AS closes
      FROM (SELECT opens, closes, CAST(unnest(generate_series(date_trunc('week', opens)::TIMESTAMP, closes::TIMESTAMP,
                                                              INTERVAL 7 DAY)) AS DATE) AS wk FROM span) s)"""]


def series_steps(cfg: FunnelConfig, scope: str | None = None, ranges=None) -> list[str]:
    """``series``: the web stages as a long table (wk, stage, n)."""
    raw = (f"SELECT spine.wk, e.* FROM ({fx.ORDER_EVENTS_SQL}) e JOIN spine "
           "ON e.event_date BETWEEN spine.opens AND spine.closes")
    counted = ["p.acquisition"]
    if cfg.exclude_identified:
        counted.append("NOT e.identified")
    if scope is not None:
        counted.append(f"e.geo_country = {lit(scope)}")
    inside = "TRUE" if scope is None else f"geo_country = {lit(scope)}"
    return [*spine_table(ranges or TREND_RANGES), *session_steps(cfg, raw, "wk, user_pseudo_id, session_id"),
            *label_tables(cfg), f"""week_user AS (
      SELECT wk, user_pseudo_id, geo_country FROM seen WHERE event_name = {lit(cfg.signup_event)}
      QUALIFY row_number() OVER (PARTITION BY wk, user_pseudo_id
        ORDER BY geo_country IS NULL, event_timestamp NULLS FIRST, event_seq NULLS FIRST) = 1)""",
            f"""series AS (
      SELECT e.wk, 'visits' AS stage, 1 AS n
      FROM entry e JOIN page_label p ON p.raw IS NOT DISTINCT FROM e.page_group WHERE {' AND '.join(counted)}
      UNION ALL
      SELECT wk, 'activations', (user_pseudo_id IS NOT NULL)::INT FROM week_user WHERE {inside})"""]


def _series_query(stages: tuple[str, ...], cfg: FunnelConfig, scope: str | None = None, ranges=None) -> str:
    wanted = ", ".join(map(lit, stages))
    return query(series_steps(cfg, scope, ranges),
                 f"SELECT wk, {stage_sums(*stages)} FROM series WHERE stage IN ({wanted}) GROUP BY wk")


def weekly_visits() -> str:
    return _series_query(("visits",), fx.trend_config())


def weekly_activations() -> str:
    return _series_query(("activations",), fx.trend_config())


def weekly_web_trend() -> str:
    return _series_query(("visits", "activations"), fx.trend_config())


def weekly_web_trend_scoped() -> str:
    cfg = fx.trend_config()
    return _series_query(("visits", "activations"), cfg, cfg.scope_country)


def weekly_web_trend_anonymous() -> str:
    return _series_query(("visits", "activations"), fx.trend_config().with_(exclude_identified=True))


#: a plain range that begins and ends inside a week
TREND_RANGE = (date(2000, 3, 1), date(2000, 6, 15))


def weekly_web_trend_range() -> str:
    return _series_query(("visits", "activations"), fx.trend_config(), ranges=[TREND_RANGE])


def _aggregate_query(cfg: FunnelConfig, scope: str | None = None) -> str:
    inside = "TRUE" if scope is None else f"country_group = {lit(scope)}"
    return query([*spine_table(TREND_RANGES), weekly_step(fx.ORDER_TRIALS_SQL, fx.ORDER_PAID_SQL)],
                 f"""SELECT wk, {stage_sums('trials', 'paid')}
      FROM weekly JOIN spine ON wk = week + 1 WHERE {inside} GROUP BY wk""")


def weekly_aggregate_trend() -> str:
    return _aggregate_query(fx.trend_config())


def weekly_aggregate_trend_scoped() -> str:
    cfg = fx.trend_config()
    return _aggregate_query(cfg, cfg.scope_country)


def prev_year_range(cfg: FunnelConfig):
    return SUNDAY_RANGE


def weekly_aggregate_prev_year_scoped() -> str:
    return weekly_aggregate_prev_year(f"AND country_group = {lit(fx.HOT_COUNTRY)}")


def weekly_aggregate_prev_year(scope: str = "") -> str:
    s, e = SUNDAY_RANGE
    return query([f"""weekly AS (
      SELECT week, country_group, 'trials' AS stage, free_trial_users AS n, free_trial_users_prev_yr AS old FROM ({fx.ORDER_TRIALS_SQL}) t
      UNION ALL SELECT week, country_group, 'paid', total_bookings_users, total_bookings_users_prev_yr FROM ({fx.ORDER_PAID_SQL}) b)"""],
                 f"""SELECT week AS wk, {stage_sums('trials', 'paid')},
             coalesce(sum(old) FILTER (stage = 'trials'), 0)::BIGINT AS trials_prev_yr,
             coalesce(sum(old) FILTER (stage = 'paid'), 0)::BIGINT AS paid_prev_yr
      FROM weekly WHERE week BETWEEN {lit(s)} AND {lit(e)} {scope} GROUP BY week""")


def grid_steps(cfg: FunnelConfig) -> list[str]:
    def at(shift: str, suffix: str) -> str:
        return ", ".join(f"coalesce(sum(n) FILTER (stage = '{s}' AND s.wk = g.wk{shift}), 0)::BIGINT AS {s}{suffix}"
                         for s in STAGES)

    back = f" - {TREND_SHIFT}"
    return [*series_steps(cfg), weekly_step(fx.ORDER_TRIALS_SQL, fx.ORDER_PAID_SQL), f"""grid AS (
      SELECT g.wk, g.wk{back} AS prior_wk, {at('', '')}, {at(back, '_prior')}
      FROM (SELECT {lit(TREND_FIRST_WEEK)} + (7 * i)::INT AS wk FROM range({TREND_WEEKS}) r(i)) g
      LEFT JOIN (SELECT wk, stage, sum(n) AS n FROM (
                   FROM series UNION ALL SELECT week + 1, stage, n FROM weekly) a GROUP BY ALL) s
        ON s.wk = g.wk OR s.wk = g.wk{back}
      GROUP BY g.wk)"""]


def trend_grid() -> str:
    return query(grid_steps(fx.trend_config()), "SELECT * FROM grid")


def trend_document() -> str:
    """K2: the document {weeks, weeks_prior_year, stages, series_current,
    series_prior} as compact JSON text, arrays ordered by week."""
    def arrays(suffix: str) -> str:
        return "{" + ", ".join(f"'{s}': list({s}{suffix} ORDER BY wk)" for s in STAGES) + "}"

    return query(grid_steps(fx.trend_config()), f"""SELECT CAST(to_json({{
        'weeks': list(strftime(wk, '%Y-%m-%d') ORDER BY wk),
        'weeks_prior_year': list(strftime(prior_wk, '%Y-%m-%d') ORDER BY wk), 'stages': {list(STAGES)},
        'series_current': {arrays('')}, 'series_prior': {arrays('_prior')}}}) AS VARCHAR) AS document FROM grid""")


# -- reports ---------------------------------------------------------------------------

def quarter_steps(cfg: FunnelConfig) -> list[str]:
    """``weekly`` cut to the fiscal weeks and ``quarter``, its first and last day."""
    a, b = cfg.fiscal_weeks
    return [weekly_step(fx.ORDER_TRIALS_SQL, fx.ORDER_PAID_SQL, ", fy_text, fw_number"),
            f"fiscal AS (FROM weekly WHERE fy_text = {lit(cfg.fiscal_year)} AND fw_number >= {a} AND fw_number <= {b})",
            "quarter AS (SELECT min(week) AS first_wk, max(week) AS last_wk, max(week) + 6 AS end_date "
            "FROM fiscal WHERE stage = 'trials')"]


def fiscal_bounds() -> str:
    return query(quarter_steps(fx.trend_config()), "SELECT * FROM quarter")


def calibration() -> str:
    cfg = fx.trend_config()
    scope = lit(cfg.scope_country)
    raw = f"SELECT e.* FROM ({fx.ORDER_EVENTS_SQL}) e SEMI JOIN quarter ON event_date BETWEEN first_wk AND end_date"
    steps = [*quarter_steps(cfg), *session_steps(cfg, raw), *label_tables(cfg),
             table("target", "stage, reference", TARGETS), f"""fact AS (
      SELECT 'visits' AS stage, e.geo_country AS place, 1 AS n
      FROM entry e JOIN page_label p ON p.raw IS NOT DISTINCT FROM e.page_group WHERE p.acquisition
      UNION ALL
      SELECT 'activations', geo_country, (user_pseudo_id IS NOT NULL)::INT FROM (
        SELECT user_pseudo_id, geo_country FROM seen WHERE event_name = {lit(cfg.signup_event)}
        QUALIFY row_number() OVER (PARTITION BY user_pseudo_id
          ORDER BY geo_country IS NULL, event_timestamp NULLS FIRST, event_seq NULLS FIRST) = 1) u
      UNION ALL
      SELECT stage, country_group, n FROM fiscal)""", f"""score AS (
      SELECT stage, reference::BIGINT AS reference, coalesce(sum(n) FILTER (place = {scope}), 0)::BIGINT AS measured
      FROM target LEFT JOIN fact USING (stage) GROUP BY ALL)"""]
    return query(steps, f"""SELECT stage, measured, reference, round(off, 6)::DOUBLE AS delta_pct,
        if(abs(off) > {TOLERANCE_PCT}, 'OVER', 'OK') AS flag
      FROM (SELECT *, coalesce((measured - reference) / nullif(reference, 0) * 100, 0) AS off FROM score) s""")


# -- open domains, window tables, publication ------------------------------------------

OPEN_DIMS = "landing_page, medium, entry_day, device, new_returning"
CUBE_CAP = 30000
#: days and lengths of the rolling windows: every day seen x 1 to 40 days
ROLLING_RANGE, ROLLING_DAYS = (date(2024, 1, 1), date(2024, 1, 30)), 40


def open_steps() -> list[str]:
    """Up to ``shared``: open cells and placeholders with what each is given."""
    cfg = fx.cube_config()
    return [
        *web_steps(cfg, source=fx.HOT_EVENTS_SQL), *label_tables(cfg), windows_table(),
        *totals_steps(with_windows=False), f"""signed AS (
      SELECT DISTINCT user_pseudo_id, session_id FROM seen WHERE event_name = {lit(cfg.signup_event)})""",
        f"""open_cell AS (
      SELECT period, coalesce(e.geo_country, 'Other') AS geo_country, coalesce(e.page_group, '(none)') AS landing_page,
             coalesce(e.traffic_source_medium, '(none)') AS medium, CAST(e.session_date AS VARCHAR) AS entry_day, d.device,
             if(e.fresh, 'new', 'returning') AS new_returning, count(*) FILTER (p.acquisition) AS visits,
             count(s.session_id) AS activations, FALSE AS is_placeholder
      FROM entry e JOIN win ON e.session_date BETWEEN opens AND closes
      LEFT JOIN page_label p ON p.raw IS NOT DISTINCT FROM e.page_group
      LEFT JOIN device_label d ON d.raw IS NOT DISTINCT FROM e.device_category
      LEFT JOIN signed s ON s.user_pseudo_id = e.user_pseudo_id AND s.session_id = e.session_id
      GROUP BY ALL)""",
        f"""open_row AS (
      SELECT *, sum(visits) OVER g AS group_visits, count(*) OVER g AS members,
             row_number() OVER (PARTITION BY period, geo_country ORDER BY is_placeholder, {OPEN_DIMS}) AS pos
      FROM (FROM open_cell UNION ALL
            SELECT period, country, {", ".join(["'(aggregate)'"] * 5)}, 0, 0, TRUE FROM want
            WHERE greatest(trials, paid) > 0 AND NOT EXISTS (SELECT 1 FROM open_cell o
              WHERE o.period = want.period AND o.geo_country = want.country AND o.visits > 0)) u
      WINDOW g AS (PARTITION BY period, geo_country))""",
        """owed AS (
      SELECT r.period, r.geo_country, pos, stage, total, visits, members, group_visits, (visits * total) % nullif(group_visits, 0) AS rest
      FROM open_row r JOIN (UNPIVOT want ON trials, paid INTO NAME stage VALUE total) w
        ON w.period = r.period AND w.country = r.geo_country)""",
        """given AS (
      SELECT period, geo_country, pos, stage, CASE
        WHEN group_visits = 0 THEN floor((total + members - pos) / members)
        WHEN total <= 0 THEN 0
        ELSE (visits * total - rest) // group_visits
           + (row_number() OVER (PARTITION BY period, geo_country, stage ORDER BY rest DESC, pos) * group_visits
              <= sum(rest) OVER (PARTITION BY period, geo_country, stage))::INT END AS n
      FROM owed)""",
        f"""shared AS (
      SELECT period, geo_country, {OPEN_DIMS}, visits::BIGINT AS visits, activations::BIGINT AS activations,
             coalesce((SELECT n FROM given g WHERE g.period = r.period AND g.geo_country = r.geo_country AND g.pos = r.pos AND stage = 'trials'), 0)::BIGINT AS trials,
             coalesce((SELECT n FROM given g WHERE g.period = r.period AND g.geo_country = r.geo_country AND g.pos = r.pos AND stage = 'paid'), 0)::BIGINT AS paid,
             is_placeholder, group_visits::BIGINT AS group_visits
      FROM open_row r)"""]


def allocate_shares_open() -> str:
    return query(open_steps(), "SELECT * FROM shared WHERE group_visits > 0")


def allocate_even_split_open() -> str:
    return query(open_steps(), "SELECT * EXCLUDE (group_visits) FROM shared WHERE group_visits = 0")


def cube_top_30000() -> str:
    return f"""SELECT * FROM ({fx.LINE_CELLS_SQL}) c
      QUALIFY row_number() OVER (PARTITION BY period ORDER BY visits + trials + paid DESC, landing_family, channel, geo_country,
        device, new_returning, activations, trials, paid) <= {CUBE_CAP}"""


def rolling_step() -> str:
    """``roll``: every day of ``seen`` as the last of 1 to 40 days."""
    return f"""roll AS (
      SELECT event_date || '/' || n AS period, event_date - (n - 1)::INT AS opens, event_date AS closes
      FROM (SELECT DISTINCT event_date FROM seen) d, range(1, {ROLLING_DAYS + 1}) r(n))"""


def window_table_sums() -> str:
    cfg = fx.cube_config()
    steps = [*web_steps(cfg, [ROLLING_RANGE]), *labelled_steps(cfg), rolling_step(), f"""dated AS (
      SELECT session_date AS day, 1 AS visit, 0 AS activation FROM labelled WHERE acquisition
      UNION ALL
      SELECT min(event_date), 0, 1 FROM seen WHERE event_name = {lit(cfg.signup_event)} AND user_pseudo_id IS NOT NULL
      GROUP BY user_pseudo_id)"""]
    return query(steps, """SELECT period, sum(visit)::BIGINT AS visits, sum(activation)::BIGINT AS activations
      FROM roll JOIN dated ON day BETWEEN opens AND closes GROUP BY period""")


def window_signup_users() -> str:
    cfg = fx.cube_config()
    return query([*web_steps(cfg, [ROLLING_RANGE]), rolling_step()], f"""SELECT period, count(DISTINCT user_pseudo_id) AS users
      FROM roll JOIN seen ON event_date BETWEEN opens AND closes WHERE event_name = {lit(cfg.signup_event)} GROUP BY period""")


def weekly_violations() -> str:
    return f"""WITH weekly AS ({fx.WEB_TRIALS_SQL}), dirty AS (
      SELECT if(country_group = 'NATION_2', week + 1, week) AS week, country_group, agg_key FROM weekly
      UNION ALL SELECT week, country_group, agg_key FROM weekly WHERE country_group = 'NATION_1'),
    key AS (SELECT *, count(*) AS n, concat_ws(', ', week, coalesce(country_group, 'NULL'), agg_key) AS name FROM dirty GROUP BY ALL)
    SELECT 'week is a Sunday' AS "check", coalesce(sum(n), 0)::BIGINT AS violations, min(week)::VARCHAR AS example
    FROM key WHERE dayofweek(week) <> 0
    UNION ALL SELECT 'key is unique', count(*), min(name) FROM key WHERE n > 1"""


def extract_counts() -> str:
    """K4: rows of the totals, the web cube, the cube and the trend grid."""
    return query(allocation_steps(), f"""SELECT 'aggregate_totals' AS extract, count(*) AS rows FROM want
      UNION ALL SELECT 'web_cube', count(*) FROM big_cell
      UNION ALL SELECT 'cube', count(*) FROM cube
      UNION ALL SELECT 'trend_weeks', {TREND_WEEKS}""")


def cube_document_lines() -> str:
    row = "{" + ", ".join(f"'{c}': {c}" for c in (*_CUBE_KEYS.split(", "), *STAGES)) + "}"
    order = f"ORDER BY {_CUBE_KEYS}, {', '.join(STAGES)}"
    return query(allocation_steps(), f"""SELECT row_number() OVER ({order}) AS line,
             if(row_number() OVER ({order}) > 1, ',', '') || CAST(to_json({row}) AS VARCHAR) AS text FROM cube
      UNION ALL SELECT 0, rtrim(CAST(to_json({{{_header_fields()}}}) AS VARCHAR), '}}') || ',"rows":['
      UNION ALL SELECT count(*) + 1, ']}}' FROM cube""")
