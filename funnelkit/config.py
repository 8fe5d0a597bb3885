"""Job configuration: windows, week grid and the classification rule tables.

Everything the funnel job needs to know that is not data lives here, so the
same operators serve the production tables and the test fixtures.  Names that
belong to one business (the marketing host, page groups carrying a brand name)
are parameters, never literals in the operators.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, timedelta

# A rule is ``(label, predicates)``; it matches when ANY predicate is true and
# rules are tried in order (first match wins, like a searched CASE).
# A predicate is ``(field, op, arg)`` with op one of
#   "in"   -> field IN arg            (arg: tuple of strings)
#   "like" -> field LIKE arg          (SQL pattern, ``_`` and ``%`` wildcards)
#   "null" -> field IS NULL           (arg ignored)
# NULL never satisfies "in" or "like", so NULL input falls through to later
# rules exactly as in SQL three-valued logic.
Predicate = tuple[str, str, object]
Rule = tuple[str, tuple[Predicate, ...]]


# --------------------------------------------------------------------------
# These must equal the reference's for identical results.
# --------------------------------------------------------------------------

# Acquisition page-group carve-out (visits count only sessions entering here).
# ``{brand}`` is filled from FunnelConfig.brand.
ACQ_PAGE_GROUPS = (
    "homepage", "marketing_pricing_page", "solutions",
    "solutions_pages_email_marketing", "solutions_pages_sms_marketing",
    "solutions_pages_marketing_automation", "solutions_pages_templates",
    "signup_start_page", "other_switch_to_{brand}",
    "overview_pages", "sales", "contact_pages",
    "landing_pages",
)

# Countries kept by name; every other value (and NULL) becomes "Other".
TOP_COUNTRIES = (
    "United States", "Canada", "United Kingdom", "India", "Mexico",
    "China", "Spain", "Australia", "Germany", "Japan",
    "Argentina", "Saudi Arabia", "Ireland", "Brazil", "France",
    "Italy", "Netherlands", "Singapore", "Thailand", "Malaysia",
)

# Aggregate-table country_group -> cube country bucket (unknown/NULL -> Other).
COUNTRY_BRIDGE = (
    ("United States", "United States"),
    ("Canada", "Canada"),
    ("United Kingdom", "United Kingdom"),
    ("Australia", "Australia"),
    ("Ireland", "Ireland"),
    ("Netherlands", "Netherlands"),
    ("Belgium", "Other"),
    ("New Zealand", "Other"),
    ("Nordics", "Other"),
    ("Tier 1 Develop", "Other"),
    ("Tier 2 Develop", "Other"),
    ("ROW", "Other"),
)

# Older headline form of the bridge: Belgium and New Zealand keep their names.
COUNTRY_BRIDGE_HEADLINE = (
    ("United States", "United States"),
    ("United Kingdom", "United Kingdom"),
    ("Canada", "Canada"),
    ("Australia", "Australia"),
    ("Netherlands", "Netherlands"),
    ("Belgium", "Belgium"),
    ("Ireland", "Ireland"),
    ("New Zealand", "New Zealand"),
    ("Nordics", "Other"),
    ("Tier 1 Develop", "Other"),
    ("Tier 2 Develop", "Other"),
    ("ROW", "Other"),
)

# Channel: rules on LOWER(medium) ("medium") and LOWER(source) ("source").
CHANNEL_RULES: tuple[Rule, ...] = (
    ("Paid Search", (("medium", "in", ("cpc", "ppc", "paidsearch", "paid-search", "paid_search")),)),
    ("Paid Social", (("medium", "in", ("paid_social", "paidsocial", "paid-social", "social-paid", "social_paid", "cpm")),)),
    ("Organic Search", (("medium", "in", ("organic", "seo")),)),
    ("Organic Social", (("medium", "in", ("social", "social-organic", "social_organic", "organic_social", "organic-social")),)),
    ("Email", (("medium", "in", ("email", "newsletter")),)),
    ("Affiliate", (("medium", "in", ("affiliate", "affiliates")),)),
    ("Referral", (("medium", "in", ("referral",)),)),
    ("Display / Other", (("medium", "in", ("display", "banner", "cpv")),)),
    ("Direct", (("medium", "in", ("", "(none)", "none", "direct")),
                ("medium", "null", None),
                ("source", "in", ("(direct)", "direct")))),
)
CHANNEL_DEFAULT = "Display / Other"

# Landing family on the raw page_group ("page_group").  ``{brand}`` as above.
LANDING_FAMILY_RULES: tuple[Rule, ...] = (
    ("Homepage", (("page_group", "in", ("homepage",)),)),
    ("Pricing", (("page_group", "in", ("marketing_pricing_page",)),)),
    ("Email Marketing solution", (("page_group", "in", ("solutions_pages_email_marketing",)),)),
    ("SMS Marketing solution", (("page_group", "in", ("solutions_pages_sms_marketing",)),)),
    ("Marketing Automation solution", (("page_group", "in", ("solutions_pages_marketing_automation",)),)),
    ("Other Solutions", (("page_group", "in", ("solutions", "solutions_pages_templates", "overview_pages", "sales",
                                               "contact_pages", "expert_directory", "onboarding_services",
                                               "personalize")),)),
    ("Other Feature pages", (("page_group", "in", ("feature_pages",)), ("page_group", "like", "features_pages_%"))),
    ("SEO Resources", (("page_group", "in", ("resources_pages", "resources_pages_email", "resources_pages_benchmarks",
                                             "resources_pages_home", "resources_pages_deliverability",
                                             "marketing_glossary_pages", "{brand}_presents",
                                             "{brand}_story_pages")),)),
    ("Knowledge Base / Help", (("page_group", "in", ("knowledge_base_pages",)), ("page_group", "like", "help_pages_%"))),
    ("Integrations", (("page_group", "like", "integrations_pages%"),)),
    ("Switch-to / Compete", (("page_group", "in", ("other_switch_to_{brand}",)),)),
    ("Direct to Signup", (("page_group", "in", ("signup_start_page",)),)),
    ("Paid Landing Pages", (("page_group", "in", ("landing_pages",)),)),
)
# Older, extended rule set: one more family, placed last.
LANDING_FAMILY_EXTENSION: tuple[Rule, ...] = (
    ("Reporting & Analytics", (("page_group", "like", "%report%analytic%"), ("page_group", "like", "%analytics%"))),
)
LANDING_FAMILY_DEFAULT = "Other"

# Device on LOWER(IFNULL(device_category, '')) ("device").
DEVICE_RULES: tuple[Rule, ...] = (
    ("mobile", (("device", "in", ("mobile",)),)),
    ("desktop", (("device", "in", ("desktop",)),)),
    ("tablet", (("device", "in", ("tablet",)),)),
)
DEVICE_DEFAULT = "desktop"

# Dimension values given to a sign-up user with no session attributes.
SIGNUP_DEFAULTS = (
    ("landing_family", "Direct to Signup"),
    ("channel", "Direct"),
    ("geo_country", "Other"),
    ("device", "desktop"),
    ("new_returning", "new"),
)
# Older variant: such users land in family "Other".
SIGNUP_DEFAULTS_OLDER = (
    ("landing_family", "Other"),
    ("channel", "Direct"),
    ("geo_country", "Other"),
    ("device", "desktop"),
    ("new_returning", "new"),
)

# Placeholder row for a (period, country) with aggregate totals but no visits.
PLACEHOLDER_DIMS = (
    ("landing_family", "Other"),
    ("channel", "Direct"),
    ("device", "desktop"),
    ("new_returning", "new"),
)

# Published fiscal-quarter calibration targets and tolerance (percent).
CALIBRATION_TARGETS = (
    ("visits", 7711102),
    ("activations", 131765),
    ("trials", 42284),
    ("paid", 27030),
)
CALIBRATION_TOLERANCE_PCT = 10

STAGES = ("visits", "activations", "trials", "paid")
DIMENSIONS = ("landing_family", "channel", "geo_country", "device", "new_returning")

# --------------------------------------------------------------------------


def _fill(values, brand: str):
    if isinstance(values, str):
        return values.replace("{brand}", brand)
    if isinstance(values, tuple):
        return tuple(_fill(v, brand) for v in values)
    return values


def _fill_rules(rules: tuple[Rule, ...], brand: str) -> tuple[Rule, ...]:
    return tuple((label, tuple((f, op, _fill(arg, brand)) for f, op, arg in preds)) for label, preds in rules)


@dataclass(frozen=True)
class Window:
    period: str
    start: date
    end: date  # inclusive


@dataclass(frozen=True)
class FunnelConfig:
    """Parameters of one funnel build.

    ``entry_rule``: "first_page" (first event with a non-null page_path; the
    canonical rule) or "first_event" (older: first event, nulls included).
    ``exclude_identified``: older rule dropping sessions with any user_id.
    ``top_countries``: None keeps raw country names (older option).
    """

    as_of: date
    site_host: str
    brand: str = "brand"
    window_days: tuple[int, ...] = (30, 90)
    prior_shift_days: int = 365
    trend_weeks: int = 44
    trend_shift_days: int = 364
    signup_event: str = "sign_up"
    acq_groups: tuple[str, ...] | None = None
    family_rules: tuple[Rule, ...] | None = None
    extended_families: bool = False
    channel_rules: tuple[Rule, ...] = CHANNEL_RULES
    device_rules: tuple[Rule, ...] = DEVICE_RULES
    top_countries: tuple[str, ...] | None = TOP_COUNTRIES
    country_bridge: tuple[tuple[str, str], ...] = COUNTRY_BRIDGE
    min_visits: int = 5
    entry_rule: str = "first_page"
    exclude_identified: bool = False
    signup_defaults: tuple[tuple[str, str], ...] = SIGNUP_DEFAULTS
    placeholder_dims: tuple[tuple[str, str], ...] = PLACEHOLDER_DIMS
    scope_country: str = "United States"
    fiscal_year: str = "FY26"
    fiscal_weeks: tuple[int, int] = (1, 13)
    calibration_targets: tuple[tuple[str, int], ...] = CALIBRATION_TARGETS
    tolerance_pct: float = CALIBRATION_TOLERANCE_PCT

    # -- rule tables with the brand filled in ------------------------------
    @property
    def acq(self) -> tuple[str, ...]:
        return _fill(self.acq_groups if self.acq_groups is not None else ACQ_PAGE_GROUPS, self.brand)

    @property
    def families(self) -> tuple[Rule, ...]:
        base = self.family_rules if self.family_rules is not None else LANDING_FAMILY_RULES
        if self.extended_families:
            base = tuple(base) + LANDING_FAMILY_EXTENSION
        return _fill_rules(base, self.brand)

    def dimension_labels(self) -> dict[str, tuple[str, ...]] | None:
        """Every value each cube dimension can take, in ascending order, or
        None when a dimension is open (raw country names, ``top_countries``
        None).  Used to pack a session's five dimensions into one BIGINT."""
        if self.top_countries is None:
            return None

        def labels(rules, default):
            return tuple(sorted({label for label, _ in rules} | {default}))

        return {
            "landing_family": labels(self.families, LANDING_FAMILY_DEFAULT),
            "channel": labels(self.channel_rules, CHANNEL_DEFAULT),
            "geo_country": tuple(sorted({*self.top_countries, "Other"})),
            "device": labels(self.device_rules, DEVICE_DEFAULT),
            "new_returning": ("new", "returning"),
        }

    def with_(self, **kw) -> FunnelConfig:
        return replace(self, **kw)

    # -- calendar ----------------------------------------------------------
    @property
    def windows(self) -> list[Window]:
        """current_Nd and prior_yr_Nd for each N, in that order."""
        out = []
        for n in self.window_days:
            start = self.as_of - timedelta(days=n - 1)
            shift = timedelta(days=self.prior_shift_days)
            out.append(Window(f"current_{n}d", start, self.as_of))
            out.append(Window(f"prior_yr_{n}d", start - shift, self.as_of - shift))
        return out

    @property
    def scan_ranges(self) -> list[tuple[date, date]]:
        """Smallest set of disjoint date ranges covering every window."""
        return merge_ranges([(w.start, w.end) for w in self.windows])

    @property
    def trend_end_week(self) -> date:
        return self.as_of - timedelta(days=self.as_of.weekday())  # Monday

    @property
    def trend_start_week(self) -> date:
        return self.trend_end_week - timedelta(weeks=self.trend_weeks - 1)

    @property
    def trend_ranges(self) -> list[tuple[date, date]]:
        """Event-date ranges of the current and the prior trend weeks."""
        cur = (self.trend_start_week, self.trend_end_week + timedelta(days=6))
        shift = timedelta(days=self.trend_shift_days)
        return merge_ranges([(cur[0] - shift, cur[1] - shift), cur])

    @property
    def trend_week_ranges_sunday(self) -> list[tuple[date, date]]:
        """Ranges of Sunday-start aggregate weeks matching the trend weeks."""
        return [(s - timedelta(days=1), e - timedelta(days=1)) for s, e in self.trend_ranges]


def merge_ranges(ranges: list[tuple[date, date]]) -> list[tuple[date, date]]:
    out: list[list[date]] = []
    for s, e in sorted(ranges):
        if out and s <= out[-1][1] + timedelta(days=1):
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def reference_config(site_host: str, brand: str) -> FunnelConfig:
    """The canonical settings: as-of 2026-05-02, 30/90-day windows."""
    return FunnelConfig(as_of=date(2026, 5, 2), site_host=site_host, brand=brand)
