"""Command-line entry for the refresh jobs.

    python -m martlet full   --landing DIR --mart DIR [--as-of YYYY-MM-DD]
    python -m martlet weekly --landing DIR --mart DIR [--as-of YYYY-MM-DD]
                             [--start YYYY-MM-DD --end YYYY-MM-DD] [--delete-cancelled]
    python -m martlet audit  --landing DIR

``full`` builds every model from the landed files (dims overwritten,
incremental tables merged if present); ``weekly`` refreshes orders, lines and
the gold tables with the 7-day look-back; ``--start`` / ``--end`` back-fill a
window of order dates instead, reading only the ``dt`` folders in it.  The files
read are parsed once into ``<mart>/bronze``.  ``--as-of`` defaults to today (the
weekly window ends yesterday).  Master, parallelism and memory are those the job
was submitted with, and spark.checkpoint.dir must name a shared folder.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from martlet.operators import audit as audit_ops
from martlet.plans import refresh
from martlet.session import build_session
from martlet.sources import bronze


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="martlet")
    ap.add_argument("mode", choices=["full", "weekly", "audit"])
    ap.add_argument("--landing", required=True, help="root of the landed NDJSON files")
    ap.add_argument("--mart", help="root folder of the mart tables")
    ap.add_argument("--as-of", default=None, help="run date, YYYY-MM-DD (default: today)")
    ap.add_argument("--plain-keys", action="store_true", help="merge with = instead of null-safe <=>")
    ap.add_argument("--gold-scope", choices=["all", "touched"], default="touched",
                    help="weekly: recompute gold for the dates silver touched (default) or for all")
    ap.add_argument("--start", help="back-fill: first order date, YYYY-MM-DD")
    ap.add_argument("--end", help="back-fill: last order date, YYYY-MM-DD")
    ap.add_argument("--delete-cancelled", action="store_true", help="remove stored orders landed as cancelled")
    ap.add_argument("--master", default=None, help="Spark master for a local run, e.g. local[8]")
    a = ap.parse_args(argv)
    as_of = dt.date.today() if a.as_of is None else audit_ops.parse_window(a.as_of, a.as_of)[0]
    if (a.start is None) != (a.end is None):
        ap.error("--start and --end go together")
    window = audit_ops.parse_window(a.start, a.end) if a.start else None
    spark = build_session(master=a.master)
    if a.mode == "audit":
        raw = bronze.read_landed(spark, f"{a.landing.rstrip('/')}/{bronze.SALES_DIR}", bronze.S.RAW_SALES)
        for r in bronze.run_audit(raw).orderBy("dt").collect():
            print(json.dumps(r.asDict(), default=str))
        return 0
    if not a.mart:
        ap.error("--mart is required for full and weekly")
    folder = f"{a.mart.rstrip('/')}/bronze"
    if a.mode == "full":
        raw, landed = bronze.ingest_audited(spark, a.landing, folder)
        refresh.refresh_full(spark, a.mart, raw, as_of, null_safe=not a.plain_keys)
    else:
        dates = window or (refresh.first_needed(spark, a.mart, as_of), None)
        raw, landed = bronze.ingest_audited(spark, a.landing, folder, dates, only_sales=True)
        refresh.refresh_weekly(spark, a.mart, raw, as_of, null_safe=not a.plain_keys, gold_scope=a.gold_scope,
                               window=window, delete_cancelled=a.delete_cancelled)
    for r in landed.where("not count_matches").orderBy("dt").collect():  # days whose files do not add up
        print(json.dumps({"audit": r.asDict()}, default=str), file=sys.stderr)
    start, end = window or audit_ops.weekly_window(as_of)
    print(json.dumps({"mode": a.mode, "as_of": str(as_of), "window": [str(start), str(end)], "mart": a.mart}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
