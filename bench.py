"""Benchmark: one nightly run of all 42 report tables at $BENCH_SF_DIR on
local[$BENCH_CPUS].

Same shape as the production job (``bondmart.plans.job``): dimension
snapshots are built once, the three shared cleaned facts are written once
(both timed, and counted in the total), then every report table is fully
computed into the no-op sink (all rows and columns, nothing collected); the
sets by root are written as item rows, from which the tables take their sizes.
``--standalone`` instead times each report from the raw tables on its own.

Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bondmart.plans import cash_reports, job  # noqa: E402
from bondmart.registry import feeds_for, queries  # noqa: E402
from bondmart.session import get_session, snapshot  # noqa: E402

def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    standalone = "--standalone" in sys.argv
    only = [a for a in sys.argv[1:] if not a.startswith("-")]
    names = [n for n in job.REPORTS if not only or n in only]
    spark = get_session(f"local[{cpus}]", int(cpus) * 2)
    times: dict[str, float] = {}
    if standalone:
        qs = queries()
        _noop(qs["memberid2name"](spark, sf_dir))  # warm-up: JVM, codegen, dimension snapshots
        for name in names:
            t0 = time.perf_counter()
            _noop(qs[name](spark, sf_dir))
            times[name] = round(time.perf_counter() - t0, 3)
    else:
        t0 = time.perf_counter()
        f = feeds_for(spark, sf_dir)
        job.build_dimensions(f)
        times["dimensions"] = round(time.perf_counter() - t0, 3)
        t0 = time.perf_counter()
        job.materialize_facts(spark, f)
        times["facts"] = round(time.perf_counter() - t0, 3)
        items: dict = {}
        for name in names:
            t0 = time.perf_counter()
            base = cash_reports.TWINS.get(name, name)
            if base in cash_reports.SET_TABLES:  # the items are written as rows, the sizes come from them
                own = cash_reports.SET_TABLES[base]
                if base not in items:
                    items[base] = snapshot(own.items(f), f"{base}_items")
                _noop(own.sizes(items[base]))
            else:
                _noop(job.REPORTS[name](f))
            times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "nightly_run_all_report_tables" if not standalone else "standalone_report_tables_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "n_reports": len(names),
    }
    print(json.dumps(out, ensure_ascii=False))


if __name__ == "__main__":
    main()
