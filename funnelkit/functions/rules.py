"""First-match-wins classification (searched CASE) driven by rule tables.

A rule table renders to one SQL CASE expression (``classify_sql``), compiled
with ``F.expr``: the result is the same
Catalyst CaseWhen / In / Like tree a chain of ``F.when`` calls would build,
evaluated inside whole-stage codegen, but created with one JVM round trip
instead of one per literal (the rule tables hold about a hundred literals).
Field arguments are SQL expressions over the input columns.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Rule


def _q(s: str) -> str:
    """``s`` as a SQL string literal (backslash is an escape character there)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _in(expr: str, values) -> str:
    """``expr`` in ``values``; nothing is in an empty list."""
    return f"{expr} IN ({sql_list(values)})" if values else "false"


def classify_sql(rules: tuple[Rule, ...], default: str, fields: Mapping[str, str]) -> str:
    arms = []
    for label, preds in rules:
        conds = []
        for name, op, arg in preds:
            f = fields[name]
            if op == "in":
                conds.append(_in(f, arg))
            elif op == "like":
                conds.append(f"{f} LIKE {_q(arg)}")
            elif op == "null":
                conds.append(f"{f} IS NULL")
            else:
                raise ValueError(op)
        arms.append(f"WHEN {' OR '.join(conds)} THEN {_q(label)}")
    if not arms:
        return _q(default)
    return "CASE " + " ".join(arms) + f" ELSE {_q(default)} END"


def sql_list(values) -> str:
    return ", ".join(_q(v) for v in values)


# -- the concrete classifiers (C1-C6); arguments are SQL expressions --------

def channel_sql(medium: str, source: str, rules: tuple[Rule, ...], default: str) -> str:
    """Rules on LOWER(medium) and LOWER(source)."""
    return classify_sql(rules, default, {"medium": f"LOWER({medium})", "source": f"LOWER({source})"})


def landing_family_sql(page_group: str, rules: tuple[Rule, ...], default: str) -> str:
    """Rules on the raw page group."""
    return classify_sql(rules, default, {"page_group": page_group})


def device_sql(device_category: str, rules: tuple[Rule, ...], default: str) -> str:
    """C4: rules on LOWER(IFNULL(device, ''))."""
    return classify_sql(rules, default, {"device": f"LOWER(COALESCE({device_category}, ''))"})


def country_sql(geo: str, top: tuple[str, ...] | None) -> str:
    """Top-N collapse; NULL and unlisted -> Other.  ``top=None`` keeps names."""
    if top is None:
        return f"COALESCE({geo}, 'Other')"
    return f"CASE WHEN {_in(geo, top)} THEN {geo} ELSE 'Other' END"


def new_returning_sql(is_new: str) -> str:
    """C6."""
    return f"CASE WHEN {is_new} = 1 THEN 'new' ELSE 'returning' END"


def in_list_sql(col: str, values) -> str:
    """F7-style membership flag; NULL -> false."""
    return f"COALESCE({_in(col, values)}, false)"


def channel(medium: str, source: str, rules: tuple[Rule, ...], default: str) -> Column:
    return F.expr(channel_sql(medium, source, rules, default))


def landing_family(page_group: str, rules: tuple[Rule, ...], default: str) -> Column:
    return F.expr(landing_family_sql(page_group, rules, default))


def device(device_category: str, rules: tuple[Rule, ...], default: str) -> Column:
    return F.expr(device_sql(device_category, rules, default))


def country(geo: str, top: tuple[str, ...] | None) -> Column:
    return F.expr(country_sql(geo, top))


def new_returning(is_new: str) -> Column:
    return F.expr(new_returning_sql(is_new))


def in_list(col: str, values) -> Column:
    return F.expr(in_list_sql(col, values))
