"""Command line: one refresh cycle, the continuous refresh, a ledger, one report, or health from the run log.

  python -m comptoir cycle  --replica PATH --out PATH [--settings PATH] [--registry PATH] [--cycle-no N]
                            [--parallel-reports N] [--check-contract]
  python -m comptoir stream --changes PATH --replica PATH --out PATH [--settings PATH] [--interval "60 seconds"]
                            [--available-now] [--registry PATH] [--checkpoint PATH]
  python -m comptoir ledger --replica PATH --out PATH [--buckets N] [--period yyyy-MM]
  python -m comptoir report NAME --replica PATH [--rows N]
  python -m comptoir land   --table NAME --delivery PATH --replica PATH --landing N [--complete]
  python -m comptoir health --out PATH [--rows N]

Paths may be any Hadoop file system URI. The settings table (tenant_id, module_key, is_enabled) is
parquet; without it every report is on for every tenant. ``ledger`` stores a replica so that lines meet their headers without a
shuffle; ``cycle``, ``stream`` and ``report`` read it with ``--ledger``. ``land`` merges a delivery (parquet) of one table into a
replica that is kept by key; ``cycle``, ``stream``, ``report`` and ``ledger`` read that with ``--landed``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F


def _settings(spark, path):
    from comptoir.schemas import SETTINGS_SCHEMA

    if path:
        return spark.read.schema(SETTINGS_SCHEMA).parquet(path)
    return spark.createDataFrame([], SETTINGS_SCHEMA)


def _load(a):
    """What reads ``--replica``: a ledger's tables, landed ones or a plain replica's."""
    from comptoir.sources.landing import open_landed
    from comptoir.sources.ledger import open_ledger
    from comptoir.sources.replica import load_replica

    return open_landed if a.landed else open_ledger if getattr(a, "ledger", False) else load_replica


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="comptoir")
    sub = p.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("cycle")
    c.add_argument("--replica", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--settings")
    c.add_argument("--registry")
    c.add_argument("--cycle-no", type=int, help="default: the time")
    c.add_argument("--parallel-reports", type=int, default=4)
    c.add_argument("--check-contract", action="store_true", help="fail the cycle on duplicate replica keys")
    c.add_argument("--published", action="store_true", help="all reports become visible at once, by a marker")
    s = sub.add_parser("stream")
    s.add_argument("--changes", required=True)
    s.add_argument("--replica", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--settings")
    s.add_argument("--registry")
    s.add_argument("--interval", default="60 seconds")
    s.add_argument("--checkpoint", help="default: a folder below spark.checkpoint.dir that belongs to --out")
    s.add_argument("--available-now", action="store_true")
    r = sub.add_parser("report")
    r.add_argument("name")
    r.add_argument("--replica", required=True)
    r.add_argument("--rows", type=int, default=20)
    h = sub.add_parser("health")
    h.add_argument("--out", required=True)
    h.add_argument("--rows", type=int, default=20)
    for x in (c, s, r):
        x.add_argument("--ledger", action="store_true", help="the replica is stored as a ledger (python -m comptoir ledger)")
    w = sub.add_parser("ledger")
    w.add_argument("--replica", required=True)
    w.add_argument("--out", required=True)
    w.add_argument("--buckets", type=int)
    w.add_argument("--period", default="yyyy-MM")
    for x in (c, s, r, w):
        x.add_argument("--landed", action="store_true", help="the replica is kept by landings (python -m comptoir land)")
    d = sub.add_parser("land")
    d.add_argument("--table", required=True)
    d.add_argument("--delivery", required=True)
    d.add_argument("--replica", required=True)
    d.add_argument("--landing", type=int, required=True, help="its number: higher than those before, the same when repeated")
    d.add_argument("--complete", action="store_true", help="the delivery is the whole table of its tenants, not change rows")
    a = p.parse_args(argv)

    from comptoir.session import build_session

    spark = build_session()
    if a.cmd == "cycle":
        from comptoir.plans.cycle import refresh_cycle

        res = refresh_cycle(spark, lambda: _load(a)(spark, a.replica), a.out, a.cycle_no,
                            lambda: _settings(spark, a.settings),
                            registry_path=a.registry, parallel_reports=a.parallel_reports,
                            check_contract=a.check_contract, published=a.published)
        for key, _, err, ms in res.outcomes:
            print(f"{key:20s} {ms:7d} ms  {'ok' if err is None else err}")
        print(f"cycle {res.cycle_no}: {res.duration_ms} ms" + (f", failed: {res.cycle_error}" if res.cycle_error else ""))
        return 1 if res.cycle_error else 0
    if a.cmd == "stream":
        from comptoir.streaming.refresh import refresh_stream

        q = refresh_stream(spark, a.changes, a.replica, a.out, lambda: _settings(spark, a.settings),
                           interval=a.interval, available_now=a.available_now, registry_path=a.registry,
                           checkpoint=a.checkpoint, load=_load(a))
        q.awaitTermination()
        return 0
    if a.cmd == "report":
        from comptoir.operators.reports import helper_columns, report
        from comptoir.plans.base import Base
        from comptoir.plans.latest import LATEST, latest_report

        base = Base(_load(a)(spark, a.replica))
        if a.ledger and a.name in LATEST:  # the latest documents are found without the history
            found = latest_report(a.name, base)
            found.drop(*helper_columns(found)).show(a.rows, truncate=False)
        else:
            report(a.name, base).show(a.rows, truncate=False)
        return 0
    if a.cmd == "ledger":
        from comptoir.sources.ledger import write_ledger

        write_ledger(_load(a)(spark, a.replica), a.out, a.buckets, a.period)
        return 0
    if a.cmd == "land":
        from comptoir.sources.landing import land

        land(spark, spark.read.parquet(a.delivery), a.table, a.replica, a.landing, a.complete)
        return 0
    if a.cmd == "health":
        from comptoir.operators.health import retry_schedule, sync_health
        from comptoir.plans.cycle import read_run_log

        log, cycles = read_run_log(spark, a.out)
        h = sync_health(log, cycles)
        sched = retry_schedule(h).select("tenant_id", "run_id", "streak", "wait_s")
        (h.join(sched, ["tenant_id", "run_id"]).orderBy(F.col("reported_at").desc(), "tenant_id")
         .show(a.rows, truncate=60))
        return 0
    return 2


if __name__ == "__main__":
    sys.exit(main())
