"""Headline-query benchmark: prints ONE JSON line.

    BENCH_SF_DIR  (default /root/testdata/sf0.1)
    BENCH_CPUS    (default 8)        -> local[BENCH_CPUS]
    BENCH_REPEAT  (default 3)        -> timed passes; the best pass is reported

Each query is materialised with ``collect()`` (all results are small: the
cube is bounded by its dimension domains, the trend by its week grid).  One
untimed warm-up pass first, so JVM start-up and class loading are excluded.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from funnelkit.queries import QUERIES  # noqa: E402
from funnelkit.session import local_session  # noqa: E402

HEADLINE = (
    "funnel_cube",        # the cube document: sessions, cube, totals, allocation, cap
    "trend_document",     # the trend document: 44 weeks + prior-year overlay
    "calibration",        # fiscal-quarter calibration report
    "period_totals",      # period totals report
    "web_cube",           # visits + activations cube alone
    "weekly_web_trend",   # weekly visits + activations alone
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = local_session(cpus=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="funnelkit-bench")
    errors: dict[str, str] = {}
    for name in HEADLINE:
        try:
            QUERIES[name][0](spark, sf_dir).collect()
        except Exception as e:  # keep the one-line contract; report the failure
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    best: dict[str, float] = {}
    rows: dict[str, int] = {}
    for _ in range(repeat):
        for name in HEADLINE:
            if name in errors:
                continue
            t0 = time.perf_counter()
            n = len(QUERIES[name][0](spark, sf_dir).collect())
            dt = time.perf_counter() - t0
            best[name] = min(dt, best.get(name, float("inf")))
            rows[name] = n
    total = sum(best.values())
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {
        "metric": "headline_queries_total", "value": round(total, 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in best.items()},
        "rows": rows, "sf": sf, "cpus": cpus,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
