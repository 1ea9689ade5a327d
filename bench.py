"""Benchmark: one full refresh cycle, the fifteen reports one by one, and the health operators.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_SHUFFLE_PARTITIONS (default 2 x cpus).
Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.

``value`` is one refresh cycle over all tenants, the unit of work the source
system repeats every 60 s: data read from storage, shared
intermediates materialized, all fifteen reports computed and written
as rows and JSON payload snapshots, run log appended. The data is stored as a
ledger (documents and lines in buckets); ``cycle_replica`` is the same cycle
over the plain tenant-partitioned replica. Storing either is landing, done before and not timed
(``stored`` has its seconds). ``queries`` also holds
each registered query run on its own (build from the test parquet, run,
collect; but for those that repeat a cycle or another query's setup) and ``reports_sum``, their sum over the fifteen reports, comparable
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(2 * cpus)))
    scratch = tempfile.mkdtemp(prefix="comptoir-bench-")

    from comptoir.api import QUERIES
    from comptoir.operators.reports import REPORTS
    from comptoir.plans.cycle import refresh_cycle
    from comptoir.session import build_session, ensure_checkpoint_dir
    from comptoir.sources.fixtures import replica_from_testdata, settings_fixture
    from comptoir.sources.ledger import open_ledger, write_ledger
    from comptoir.sources.replica import load_replica, write_replica

    spark = build_session(f"local[{cpus}]", parts, app_name="comptoir-bench",
                          extra={"spark.driver.memory": "16g"})
    ensure_checkpoint_dir(spark, f"{scratch}/ckpt")

    # Warm-up (JIT, file listing caches): one small report, not timed.
    QUERIES["mode_reglement"](spark, sf_dir).collect()

    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name, fn in QUERIES.items():
        if name in ("refresh_cycle", "maintained_clients"):
            continue
        t0 = time.perf_counter()
        n = len(fn(spark, sf_dir).collect())
        times[name] = round(time.perf_counter() - t0, 3)
        rows[name] = n

    # Full refresh cycles over the stored data.
    stored: dict[str, float] = {}
    source = replica_from_testdata(spark, sf_dir)
    for kind, write in (("ledger", lambda p: write_ledger(source, p, period="yyyy")), ("replica", lambda p: write_replica(source, p))):
        t0 = time.perf_counter()
        write(f"{scratch}/{kind}")
        stored[kind] = round(time.perf_counter() - t0, 3)
    failed = []
    for label, kind, load in (("cycle", "ledger", open_ledger), ("cycle_repeat", "ledger", open_ledger),
                              ("cycle_replica", "replica", load_replica)):
        t0 = time.perf_counter()
        res = refresh_cycle(spark, load(spark, f"{scratch}/{kind}"), f"{scratch}/out-{kind}", None, settings_fixture(spark))
        times[label] = round(time.perf_counter() - t0, 3)
        failed += [o[0] for o in res.outcomes if o[2]] + ([res.cycle_error] if res.cycle_error else [])

    times["reports_sum"] = round(sum(times[k] for k in REPORTS), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "refresh cycle: 15 reports for all tenants, rows and JSON snapshots written",
        "value": times["cycle"],
        "unit": "sec",
        "queries": times,
        "rows": rows,
        "cycle_failed_reports": failed,
        "stored": stored,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "shuffle_partitions": parts,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
