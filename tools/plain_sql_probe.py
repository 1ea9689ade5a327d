"""Same-machine reference point: the fifteen reports as plain Spark SQL over the fixture views.

(run by Spark SQL over temp views, one run each, collect included) on the machine at hand, so that the engine's
numbers can be compared on equal hardware. Not engine code.

Usage: python tools/plain_sql_probe.py [sf_dir] [cpus]
"""

from __future__ import annotations

import json
import re
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

REPORTS = ["sales", "achats", "caisse", "stock", "top_articles", "top_clients", "evolution_ca", "rotation",
           "mode_reglement", "marge_brute", "mouvements", "dernieres_transac", "ca_famille", "impayees",
           "solde_client"]


def to_spark_sql(sql: str) -> str:
    """The oracle's DuckDB report text in Spark's dialect (date formats, type names)."""
    sql = re.sub(r"strftime\(([^,]+), '%d/%m/%Y'\)", r"date_format(\1, 'dd/MM/yyyy')", sql)
    sql = re.sub(r"strftime\(([^,]+), '%Y-%m-%d'\)", r"date_format(\1, 'yyyy-MM-dd')", sql)
    return sql.replace("AS VARCHAR", "AS STRING")


def report_text(key: str) -> str:
    import comptoir_oracle as oracle

    return to_spark_sql(f"WITH {oracle.shared_sql()}\n{oracle.report_sql(key)}")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    cpus = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    from comptoir.session import build_session
    from comptoir.sources.fixtures import replica_from_testdata

    spark = build_session(f"local[{cpus}]", 2 * cpus, app_name="plain-sql-probe")
    for name, df in replica_from_testdata(spark, sf_dir).items():
        df.createOrReplaceTempView(name)
    spark.sql(report_text("mode_reglement")).collect()  # warm-up
    times = {}
    for key in REPORTS:
        sql = report_text(key)
        t0 = time.perf_counter()
        spark.sql(sql).collect()
        times[key] = round(time.perf_counter() - t0, 3)
    print(json.dumps({"metric": "plain Spark SQL probe, sum of 15", "value": round(sum(times.values()), 3),
                      "queries": times, "sf_dir": sf_dir, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
