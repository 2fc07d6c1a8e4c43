"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line.  Every query is fully executed into the ``noop``
sink (no rows pulled to the driver), best of ``BENCH_RUNS`` runs;
``value`` is the sum over the queries.  ``setup`` reports the one-time
creation of the stand-in input (derived tables and rendered landing
files, written to a fresh folder) and of the stored scope tables.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fundlake.registry import QUERIES  # noqa: E402
from fundlake.session import build_session, checkpoint_root  # noqa: E402
from fundlake.sources import catalog, fixtures  # noqa: E402
from fundlake.plans import ingest, scope  # noqa: E402

HEADLINE = [
    "net_income", "ebitda", "income_statement", "balance_sheet", "ebitda_margin", "roe",
    "price_earnings", "enterprise_value", "ev_ebitda", "bv_share", "cagr_revenue",
    "statistics", "compare_measure", "ingest_fixed_width", "merge_shares", "ingest_statements",
    "cash_flow_union", "price_load",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(cpus, app="fundlake-bench", shuffle_partitions=max(8, 2 * cpus))
    root = f"{checkpoint_root(spark)}/fundlake/bench/{uuid.uuid4().hex}"

    t0 = time.time()
    tables = catalog.load_tables(spark, sf_dir, root=root)
    for name in fixtures.NAMES:
        tables.get(name)
    t1 = time.time()
    ingest.landing(tables)
    t2 = time.time()
    for group in ("consolidated", "individual"):  # the stored dimension tables every query joins
        scope.scope(tables, group)
    setup = {"derive_tables": round(t1 - t0, 3), "render_landing": round(t2 - t1, 3),
             "build_scope": round(time.time() - t2, 3)}
    timings = {}
    # the registered queries find the freshly written tables through the memo
    catalog._MEMO[(spark.sparkContext.applicationId, catalog.table_root(spark, sf_dir))] = tables

    for name in names:
        best = None
        for _ in range(runs):
            t = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            el = time.time() - t
            best = el if best is None else min(best, el)
        timings[name] = round(best, 3)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf, "cpus": cpus, "runs": runs, "setup": setup}))


if __name__ == "__main__":
    main()
