"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each builds its inputs from the test parquet in ``sf_dir`` (fixture views of
``comptoir.sources.fixtures``) and runs one operator over all of it. Reports
are returned in their published form (decimals as exact text, as in the
snapshot JSON); ``comptoir.operators.reports.report`` gives the typed form.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.functions.publish import published
from comptoir.operators.gate import module_gate
from comptoir.operators.health import merge_heartbeat, retry_schedule, sync_health
from comptoir.operators.registry import upsert_registry
from comptoir.operators.reports import REPORTS, helper_columns, ordered_report, report
from comptoir.plans.base import Base
from comptoir.plans.cycle import read_run_log, refresh_cycle
from comptoir.plans.incremental import MaintainedSums
from comptoir.plans.latest import latest_report
from comptoir.session import scratch_path
from comptoir.sinks.publication import read_published
from comptoir.sinks.snapshot import replace_snapshot, snapshot_payload
from comptoir.sources import fixtures as fx
from comptoir.sources.keyed import KeyedTable
from comptoir.sources.landing import land, rejected
from comptoir.sources.ledger import open_ledger, write_ledger
from comptoir.sources.replica import check_keys, conform


def _report_query(key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(report(key, Base(fx.replica_from_testdata(spark, sf_dir))))


def _health(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fx.run_log_from_testdata(spark, sf_dir)
    cycles = fx.cycles_from_run_log(log)
    return sync_health(fx.reported(log, cycles), cycles)


def q_snapshot_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3 on the sales report: one JSON array per tenant, in report order."""
    base = Base(fx.replica_from_testdata(spark, sf_dir))
    return snapshot_payload(ordered_report("sales", base), REPORTS["sales"]).select("tenant_id", "part", "data")


def q_snapshot_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3 on an unbounded report (stock): ordered parts of 500 rows per tenant."""
    base = Base(fx.replica_from_testdata(spark, sf_dir))
    return snapshot_payload(ordered_report("stock", base), REPORTS["stock"], part_rows=500).drop("updated_at")


def q_snapshot_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O4: the sales rows of every tenant, then the purchases of all tenants but T1, which keeps its sales."""
    base = Base(fx.replica_from_testdata(spark, sf_dir))
    path = scratch_path(spark, "queries", "snapshot_replace")
    columns = ["tenant_id", "NumFacture", "DateFacture", "MONTANT_TTC", "TypeDoc"]
    first, second = (published(report(key, base)).select(*columns) for key in ("sales", "achats"))
    replace_snapshot(first, path)
    replace_snapshot(second.where("tenant_id <> 'T1'"), path)
    return spark.read.schema(first.schema).parquet(path).select(*columns)


def q_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: landed payments cast to the replica's schema; rejected rows carry the columns that don't fit."""
    good, rejected = conform(fx.landed_payments(fx.replica_from_testdata(spark, sf_dir)), "F_CREGLEMENT")
    key = ["tenant_id", "RG_No"]
    return published(good.select(*key, "RG_Montant", F.lit(None).cast("string").alias("rejected_columns"))).unionByName(
        rejected.select("tenant_id", F.col("RG_No").try_cast("bigint").alias("RG_No"),
                        F.lit(None).cast("string").alias("RG_Montant"), "rejected_columns"))


def q_check_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: keys that a second delivery made occur twice."""
    return check_keys(fx.landed_twice(fx.replica_from_testdata(spark, sf_dir)))


def q_row_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1, O4: payments kept from three waves of change rows: new, altered, deleted, repeated and late ones."""
    table = KeyedTable.of_replica(spark, scratch_path(spark, "queries", "keyed"), "F_CREGLEMENT", slot_rows=20_000)
    for wave in fx.payment_waves(fx.replica_from_testdata(spark, sf_dir)):
        table.apply(wave)
    return published(table.rows())


def q_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: two complete deliveries of payments landed: the rows stored after them, and the rows that each rejected."""
    root = scratch_path(spark, "queries", "landed")
    for i, delivered in enumerate(fx.payment_deliveries(fx.replica_from_testdata(spark, sf_dir)), start=1):
        land(spark, delivered, "F_CREGLEMENT", root, i, complete=True, slot_rows=20_000)
    stored = published(KeyedTable.of_replica(spark, root, "F_CREGLEMENT").rows())
    bad = rejected(spark, root, "F_CREGLEMENT")
    columns = ["tenant_id", "RG_No", "RG_Libelle", "RG_Montant", "rejected_columns", "landing"]
    return stored.withColumns({"rejected_columns": F.lit(None).cast("string"), "landing": F.lit(None).cast("int")}).select(*columns).unionByName(
        bad.select(*(F.col(c).cast("bigint").alias(c) if c == "RG_No" else F.col(c) for c in columns)))


_LEDGERS: dict[tuple[str, str], str] = {}


def _ledger(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The test tables as a ledger, stored once an application and folder, by years as they are small."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _LEDGERS:
        path = scratch_path(spark, "queries", "ledger")
        write_ledger(fx.replica_from_testdata(spark, sf_dir), path, period="yyyy")
        _LEDGERS[key] = path
    return open_ledger(spark, _LEDGERS[key])


def q_ledger_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1, header-line join over buckets: documents, lines and amounts by tenant, type and day."""
    sums = Base(_ledger(spark, sf_dir)).doc_sums()
    return published(sums.groupBy("tenant_id", "DO_Type", F.to_date("DO_Date").alias("day")).agg(
        F.count(F.lit(1)).alias("n_documents"), F.sum("n_lines").alias("n_lines"),
        F.sum("amount").cast("decimal(38,6)").alias("amount")))


def _latest_query(key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report of latest documents over the ledger, without reading the history of lines."""
    df = latest_report(key, Base(_ledger(spark, sf_dir)))
    return published(df.drop(*helper_columns(df)))


_MAINTAINED: dict[tuple[str, str], str] = {}


def _maintained(spark: SparkSession, sf_dir: str) -> tuple[MaintainedSums, dict[str, DataFrame]]:
    """The state after three waves, built once an application and folder, and the replica as the last wave left it."""
    deliveries = fx.waves(fx.replica_from_testdata(spark, sf_dir))
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _MAINTAINED:
        path = scratch_path(spark, "queries", "maintained")
        for wave, (replica, changed) in enumerate(deliveries):
            MaintainedSums(spark, path, slots=8).apply(replica, changed, wave)
        _MAINTAINED[key] = path
    return MaintainedSums(spark, _MAINTAINED[key], slots=8), deliveries[-1][0]


def q_maintained_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O5: item sums kept up to date through two waves of new, altered and deleted documents."""
    sums, _ = _maintained(spark, sf_dir)
    return published(sums.item_sales().withColumns({c: F.col(c).cast("decimal(38,2)") for c in ("qty", "price_sum")}
                                                   | {"amount": F.col("amount").cast("decimal(38,6)")}))


def q_maintained_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O5: the report of the best customers from document sums kept up to date through the same waves."""
    sums, replica = _maintained(spark, sf_dir)
    return published(report("top_clients", sums.base(replica)))


def q_maintained_top_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O5: the same report from the ranking kept through the waves: only the best customers' sums are read."""
    sums, replica = _maintained(spark, sf_dir)
    return published(report("top_clients", sums.top_base(replica, "top_clients")))


def q_refresh_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O5: two cycles over the ledger, the first without tenant T2; rows of every snapshot by tenant and report, and how many cycles the log has."""
    out, settings = scratch_path(spark, "queries", "cycle"), fx.settings_fixture(spark)
    replica = _ledger(spark, sf_dir)
    some = fx.tenants_of(replica).where("tenant_id <> 'T2'")
    refresh_cycle(spark, {n: df.join(some, "tenant_id", "left_semi") for n, df in replica.items()}, out, None, settings)
    result = refresh_cycle(spark, replica, out, None, settings)
    if result.cycle_error or any(error for _, _, error, _ in result.outcomes):
        raise RuntimeError(f"{result.cycle_error} {result.outcomes}")
    _, cycles = read_run_log(spark, out)
    runs = cycles.groupBy("tenant_id").agg(F.count(F.lit(1)).alias("n_cycles"))
    rows = [spark.read.schema("tenant_id string").parquet(f"{out}/{spec.table}/rows").select(
        "tenant_id", F.lit(key).alias("module_key")) for key, spec in REPORTS.items()]
    return (reduce(DataFrame.unionByName, rows).groupBy("tenant_id", "module_key").agg(F.count(F.lit(1)).alias("n_rows"))
            .join(runs, "tenant_id"))


def q_published_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O4: a published cycle over the ledger, then one of two reports without T1; rows of every snapshot that readers see."""
    out, settings = scratch_path(spark, "queries", "published"), fx.settings_fixture(spark)
    replica = _ledger(spark, sf_dir)
    fewer = {n: df.where("tenant_id <> 'T1'") for n, df in replica.items()}
    for some, modules in ((replica, list(REPORTS)), (fewer, ["stock", "achats"])):
        result = refresh_cycle(spark, some, out, None, settings, modules=modules, published=True)
        if result.cycle_error or any(error for _, _, error, _ in result.outcomes):
            raise RuntimeError(f"{result.cycle_error} {result.outcomes}")
    rows = [read_published(spark, out, key).select("tenant_id", F.lit(key).alias("module_key")) for key in REPORTS]
    return reduce(DataFrame.unionByName, rows).groupBy("tenant_id", "module_key").agg(F.count(F.lit(1)).alias("n_rows"))


def q_module_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    replica = fx.replica_from_testdata(spark, sf_dir)
    return module_gate(fx.tenants_of(replica), fx.settings_fixture(spark))


def q_sync_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _health(spark, sf_dir)


def q_retry_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retry_schedule(_health(spark, sf_dir))


def q_heartbeat_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    replica = fx.replica_from_testdata(spark, sf_dir)
    return merge_heartbeat(fx.registry_from_replica(replica), _health(spark, sf_dir))


def q_registry_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    replica = fx.replica_from_testdata(spark, sf_dir)
    return upsert_registry(fx.registry_from_replica(replica), fx.activations_from_replica(replica))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **{key: partial(_report_query, key) for key in REPORTS},
    "snapshot_payload": q_snapshot_payload,
    "snapshot_parts": q_snapshot_parts,
    "snapshot_replace": q_snapshot_replace,
    "conform": q_conform,
    "check_keys": q_check_keys,
    "row_changes": q_row_changes,
    "land": q_land,
    "ledger_sums": q_ledger_sums,
    **{f"latest_{key}": partial(_latest_query, key) for key in ("sales", "mouvements", "impayees")},
    "maintained_items": q_maintained_items,
    "maintained_clients": q_maintained_clients,
    "maintained_top_clients": q_maintained_top_clients,
    "refresh_cycle": q_refresh_cycle,
    "published_cycle": q_published_cycle,
    "module_gate": q_module_gate,
    "sync_health": q_sync_health,
    "retry_schedule": q_retry_schedule,
    "heartbeat_merge": q_heartbeat_merge,
    "registry_upsert": q_registry_upsert,
}
