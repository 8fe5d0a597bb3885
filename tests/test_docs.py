"""The README's operator map names real functions."""

import importlib
import os
import re

from conftest import ROOT

MODULES = ["funnelkit.sources.tables", "funnelkit.sinks", "funnelkit.plans.trend", "funnelkit.functions.dates",
           "funnelkit.operators.sessions", "funnelkit.functions.rules", "funnelkit.operators.totals",
           "funnelkit.operators.cube", "funnelkit.operators.allocate", "funnelkit.plans.report",
           "funnelkit.plans.cube", "funnelkit.plans.funnel", "funnelkit.plans.job", "funnelkit.config",
           "funnelkit.operators.ranking", "funnelkit.operators.apportion", "funnelkit.operators.windows",
           "funnelkit.operators.bitmaps", "funnelkit.sources.checks", "funnelkit.sinks.publish"]


def test_operator_map_names_exist():
    text = open(os.path.join(ROOT, "README.md")).read()
    section = text.split("## Operator map")[1].split("## Design for scale")[0]
    names = set()
    for cell in re.findall(r"`([^`]+)`", section):
        for part in re.split(r"[ /,()+]+", cell):
            leaf = part.split(".")[-1]
            if re.fullmatch(r"[a-z_][a-z_0-9]*|[A-Z_]+", leaf) and leaf not in {"functions", "rules", "sinks"}:
                names.add(leaf)
    mods = [importlib.import_module(m) for m in MODULES]
    missing = sorted(n for n in names if not any(hasattr(m, n) for m in mods)
                     and n not in {"is_acq", "scope_country", "any_uid", "plans", "operators", "sources", "cube",
                                   "funnel", "job", "report", "between", "min"})
    assert not missing, missing
